"""Type text: Hive to Spark DDL, comparison form, table-format JSON types, transforms."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .paths import col

# SQL type of each primitive in a table-format schema.
PRIMITIVE_SQL_TYPES = {
    "boolean": "BOOLEAN",
    "int": "INT",
    "long": "BIGINT",
    "float": "FLOAT",
    "double": "DOUBLE",
    "date": "DATE",
    "time": "STRING",
    "timestamp": "TIMESTAMP",
    "timestamptz": "TIMESTAMP",
    "string": "STRING",
    "binary": "BINARY",
    "uuid": "STRING",
}


def hive_type_to_ddl(c) -> Column:
    """``struct<a:int>`` to ``struct<a int>`` at any depth."""
    return F.regexp_replace(col(c), r"(?<=\w):(?=\w)", " ")


def comparable_type(c) -> Column:
    """Type text for comparison: char/varchar read as string, tinyint/smallint as int, nested too.

    A name followed by a colon is a struct field, not a type, and is left alone.
    """
    text = F.lower(F.trim(F.coalesce(col(c), F.lit(""))))
    text = F.regexp_replace(text, r"\b(varchar|char)\s*\(\s*\d+\s*\)", "string")
    text = F.regexp_replace(text, r"\b(varchar|char)\b(?!\s*[:(])", "string")
    return F.regexp_replace(text, r"\b(tinyint|smallint)\b(?!\s*[:(])", "int")


def partition_transform(c) -> Column:
    """``bucket[16]`` to struct(transform='bucket', param=16); no parameter gives NULL."""
    c = col(c)
    return F.struct(
        F.substring_index(c, "[", 1).alias("transform"),
        F.regexp_extract(c, r"\[(\d+)\]", 1).try_cast("int").alias("param"),
    )


def sql_type_of(json_type: str) -> str:
    """SQL text of one table-format type given as JSON text (a bare word is a primitive)."""
    text = (json_type or "").strip()
    try:
        node = json.loads(text)
    except ValueError:
        node = text
    return _sql_type(node)


def _sql_type(node) -> str:
    if isinstance(node, dict):
        builders = {
            "struct": lambda n: ",".join(f"{f['name']}:{_sql_type(f['type'])}" for f in n.get("fields", [])),
            "list": lambda n: _sql_type(n.get("element", "string")),
            "map": lambda n: f"{_sql_type(n.get('key', 'string'))},{_sql_type(n.get('value', 'string'))}",
        }
        kind = str(node.get("type", "")).lower()
        outer = {"struct": "STRUCT", "list": "ARRAY", "map": "MAP"}.get(kind)
        return f"{outer}<{builders[kind](node)}>" if outer else "STRING"
    word = str(node).lower()
    if word.startswith("decimal"):
        return word.upper()
    if word.startswith("fixed"):
        return "BINARY"
    return PRIMITIVE_SQL_TYPES.get(word, "STRING")


def with_sql_type(df: DataFrame, json_type: str, out: str) -> DataFrame:
    """Add the SQL type of a JSON type column; each distinct type is converted once, and joined back
    by broadcast as long as there are few."""
    @F.pandas_udf(T.StringType())
    def convert(values: pd.Series) -> pd.Series:
        return values.map(sql_type_of)

    types = df.select(json_type).distinct().withColumn(out, convert(F.col(json_type)))
    return df.join(types, json_type, "left")
