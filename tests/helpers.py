def rows(df, *columns):
    """Rows of a frame as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def values(spark, data, column):
    """Values of a column expression over a one-column frame of texts, in input order."""
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "i int, c string")
    return [r["out"] for r in frame.select("i", column.alias("out")).orderBy("i").collect()]
