"""Manifest rows: normalising cells, validating, grouping, and resolving table tokens.

A token is a table name or a glob over table names of one database.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import drop_trailing_slash, folder_target, object_store_uri
from ..functions.text import bad_boolean_word, blank_to_null, boolean_word, glob_regex, list_cell
from ..session import materialize
from . import ordered

# Name endings of backups and staging copies, the lead of an exclusion cell, the ending of a
# converted database.
LEFTOVER_ENDINGS = ("_backup_", "__backup__", "__ice_staging")
EXCLUDE_LEAD = "exclude:"
CONVERTED_ENDING = "_iceberg"
MOVE_KEYS = ("src_db", "source_prefix", "dest_prefix")
GROUP_KEYS = ("src_db", "dest_db", "bucket", "endpoint", "partition_filter")


def normalise_manifest(rows: DataFrame, default_bucket: str) -> DataFrame:
    """Table-copy sheet rows with defaults filled; rows without a database are dropped.

    A blank table cell means ``*``, a blank destination the source database, a blank bucket the default.
    """
    src = blank_to_null("database")
    bucket = blank_to_null("bucket")
    return rows.select(
        "row_index",
        src.alias("src_db"),
        F.coalesce(blank_to_null("dest_database"), src).alias("dest_db"),
        F.when(bucket.isNull(), F.lit(default_bucket)).otherwise(object_store_uri(bucket)).alias("bucket"),
        F.coalesce(blank_to_null("endpoint"), F.lit("")).alias("endpoint"),
        blank_to_null("partition_filter").alias("partition_filter"),
        F.coalesce(blank_to_null("table"), F.lit("*")).alias("table_cell"),
    ).where(F.col("src_db").isNotNull())


def group_manifest(manifest: DataFrame, keys=GROUP_KEYS) -> DataFrame:
    """One row per (group, role, token): each distinct token once, with the place it was first seen.

    ``role`` is include or exclude. A group that names ``*``, or only exclusions, includes just
    ``*``. ``first_seen`` orders a group's tokens; the list stays in rows, so a group may be any size.
    """
    keys = list(keys)
    cell = F.col("table_cell")
    excluding = F.lower(cell).startswith(EXCLUDE_LEAD)
    body = F.when(excluding, F.substring(cell, len(EXCLUDE_LEAD) + 1, 1_000_000_000)).otherwise(cell)
    cells = manifest.select(
        *[_null_safe(k) for k in keys], "row_index",
        F.when(excluding, F.lit("exclude")).otherwise(F.lit("include")).alias("role"),
        F.posexplode(F.transform(F.split(body, ","), lambda x: F.trim(x))).alias("_pos", "token"),
    ).where(F.col("token") != "")
    seen = cells.groupBy(*keys, "role", "token").agg(F.min(F.struct("row_index", "_pos")).alias("first_seen"))
    star = (F.col("role") == "include") & (F.col("token") == "*")
    groups = seen.groupBy(*keys).agg(
        F.max(star).alias("_star"), F.max(F.col("role") == "include").alias("_named"),
        F.min("first_seen").alias("_first"))
    named = seen.join(groups.where(F.col("_star")), keys, "left_anti").where(F.col("role") == "include")
    everything = groups.where(F.col("_star") | ~F.col("_named")).select(
        *keys, F.lit("include").alias("role"), F.lit("*").alias("token"), F.col("_first").alias("first_seen"))
    return named.unionByName(everything).unionByName(seen.where(F.col("role") == "exclude")).select(
        *keys, "role", "token", F.col("first_seen.row_index").alias("first_row"),
        F.col("first_seen._pos").alias("first_pos"))


def _null_safe(key: str) -> Column:
    return F.coalesce(F.col(key), F.lit("")).alias(key)


def registration_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Registration sheet as (valid, rejected with a reason). Of a table named twice the first row stands."""
    cells = rows.select("row_index", blank_to_null("database").alias("database"),
                        blank_to_null("table").alias("table"),
                        blank_to_null("s3_location").alias("s3_location"))
    identifier = r"^[A-Za-z0-9_]+$"
    problem = (
        F.when(F.col("database").isNull() | F.col("table").isNull() | F.col("s3_location").isNull(),
               F.lit("missing required cell"))
        .when(~F.col("database").rlike(identifier) | ~F.col("table").rlike(identifier), F.lit("invalid identifier"))
        .when(F.col("s3_location").contains("'"), F.lit("location contains a quote"))
    )
    judged = cells.withColumn("reason", problem)
    good = judged.where(F.col("reason").isNull()).drop("reason")
    good = good.withColumn("_db", F.lower("database")).withColumn("_tbl", F.lower("table"))
    first = ordered.earliest(good, ["_db", "_tbl"], [F.col("row_index")])
    repeated = good.join(first.select("row_index"), "row_index", "left_anti")
    valid = first.drop("_db", "_tbl").withColumn(
        "s3_location", drop_trailing_slash(object_store_uri("s3_location")))
    rejected = judged.where(F.col("reason").isNotNull()).unionByName(
        repeated.drop("_db", "_tbl").withColumn("reason", F.lit("duplicate table")))
    return valid, rejected


def conversion_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversion sheet as (valid, rejected with a reason).

    A blank flag means not in place; the destination defaults to the source database in place, else to
    the source database with an ending.
    """
    src, in_place = blank_to_null("database"), boolean_word("inplace_migration", default=False)
    judged = rows.select(
        "row_index", src.alias("src_db"), F.coalesce(blank_to_null("table"), F.lit("*")).alias("table_cell"),
        in_place.alias("in_place"),
        F.coalesce(blank_to_null("destination_iceberg_database"),
                   F.when(in_place, src).otherwise(F.concat(src, F.lit(CONVERTED_ENDING)))).alias("dest_db"),
        F.when(src.isNull(), F.lit("missing database"))
        .when(bad_boolean_word("inplace_migration"), F.lit("invalid in-place flag")).alias("reason"))
    return judged.where(F.col("reason").isNull()).drop("reason"), judged.where(F.col("reason").isNotNull())


def catalog_move_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Catalog-move sheet as (valid, rejected with a reason).

    A blank source prefix means the data already lies under the destination prefix. The valid rows can be
    grouped with ``group_manifest(valid, keys=MOVE_KEYS)``.
    """
    def prefix(name: str) -> Column:
        return drop_trailing_slash(object_store_uri(blank_to_null(name)))

    src, dest = blank_to_null("database"), prefix("dest_s3_prefix")
    judged = rows.select(
        "row_index", src.alias("src_db"), F.coalesce(prefix("source_s3_prefix"), dest).alias("source_prefix"),
        dest.alias("dest_prefix"), F.coalesce(blank_to_null("table"), F.lit("*")).alias("table_cell"),
        F.when(src.isNull(), F.lit("missing database")).when(dest.isNull(), F.lit("missing dest_s3_prefix")).alias("reason"))
    return judged.where(F.col("reason").isNull()).drop("reason"), judged.where(F.col("reason").isNotNull())


def folder_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Folder-copy sheet as (valid, rejected with a reason), buckets and folders cleaned.

    ``split_subfolders`` stays NULL when blank, so that a general setting can decide.
    """
    path, bucket = blank_to_null("source_path"), blank_to_null("target_bucket")
    target = folder_target("source_path", "target_bucket", blank_to_null("dest_folder"))
    split = F.when(blank_to_null("split_subfolders").isNotNull(), F.coalesce(boolean_word("split_subfolders"), F.lit(False)))
    judged = rows.select(
        "row_index", path.alias("source_path"), target["dest_bucket"].alias("dest_bucket"),
        target["dest_folder"].alias("dest_folder"), F.coalesce(blank_to_null("endpoint"), F.lit("")).alias("endpoint"),
        split.alias("split_subfolders"),
        F.when(path.isNull(), F.lit("missing source_path")).when(bucket.isNull(), F.lit("missing target_bucket")).alias("reason"))
    return judged.where(F.col("reason").isNull()).drop("reason"), judged.where(F.col("reason").isNotNull())


def is_leftover(name) -> Column:
    """Names of backups and staging copies."""
    text = F.lower(F.trim(F.col(name) if isinstance(name, str) else name))
    return text.rlike("(" + "|".join(LEFTOVER_ENDINGS) + ")$")


def without_leftover_ending(name) -> Column:
    """Table name a backup was made from."""
    text = F.trim(F.col(name) if isinstance(name, str) else name)
    return F.regexp_replace(text, "(?i)(" + "|".join(LEFTOVER_ENDINGS[:2]) + ")$", "")


def match_tokens(tokens: DataFrame, catalog: DataFrame) -> DataFrame:
    """(db, token, tbl) for every token and the tables it names, letter case aside."""
    names = catalog.select("db", "tbl", F.lower("tbl").alias("_name")).distinct()
    toks = tokens.select("db", "token", F.lower("token").alias("_tok")).distinct()
    wild = F.col("_tok").rlike(r"[*?]")
    plain = toks.where(~wild).withColumnRenamed("_tok", "_name").join(names, ["db", "_name"])
    globbed = match_globs(toks.where(wild), names)
    return plain.select("db", "token", "tbl").unionByName(globbed.select("db", "token", "tbl"))


#: Bits of the filter of anchors, and rows of one piece of a hot anchor.
_FILTER_BITS = 1 << 16
_PIECE = 50_000


def match_globs(globs: DataFrame, names: DataFrame) -> DataFrame:
    """Globs (db, _tok, ...) with the names (db, _name, ...) they match.

    Anchors are three-character pieces of the literals of a glob (shorter ones where it has none so long), with marks for
    the name's start and end. Names are taken apart into the anchors that globs use, those are counted, and each glob
    meets the names under its rarest one. An anchor that many names have is cut into pieces. Globs made of wildcards
    alone meet a database's names directly; they reduce to a few length conditions.
    """
    whole = F.concat(F.lit("^"), F.col("_tok"), F.lit("$"))
    literals = F.filter(F.split(whole, r"[*?]+"), lambda x: ~x.isin("", "^", "$"))
    longest = F.least(F.lit(3), F.coalesce(F.array_max(F.transform(literals, F.length)), F.lit(0)))
    asked = globs.select("*", literals.alias("_literals"), longest.alias("_long"))
    anchored = asked.where("_long > 0").withColumn("_anchors", F.expr("""array_distinct(flatten(transform(
        filter(_literals, x -> length(x) >= _long),
        x -> transform(sequence(1, length(x) - _long + 1), i -> substring(x, i, _long)))))"""))
    anchored = materialize(anchored.drop("_literals"), "globs")  # a row per glob
    free = asked.where("_long = 0").drop("_literals", "_long")
    candidates = anchored.select("db", "_tok", "_long", F.explode("_anchors").alias("_anchor"))
    used = candidates.select("_long", _slot("db", "_anchor").alias("slot")).groupBy(
        "_long", F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 AS INT))")).alias("bits")).collect()  # 3 x 1024 rows at most
    met = names.withColumn("_anchor", F.explode(_used_anchors("_name", used)))
    met = materialize(met.select(*names.columns, "_anchor"), "anchors")
    counts = materialize(met.groupBy("db", "_anchor").agg(F.count("*").alias("_n")), "anchor-counts")
    rarest = candidates.join(counts, ["db", "_anchor"]).groupBy("db", "_tok").agg(
        F.min(F.struct("_n", "_anchor")).alias("_rare"))
    pieces = F.ceil(F.col("_rare._n") / F.lit(_PIECE))
    chosen = anchored.drop("_anchors", "_long").join(rarest, ["db", "_tok"]).withColumn("_anchor", F.col("_rare._anchor")).withColumn(
        "_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), pieces - 1))).drop("_rare")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot = counts.where((F.col("_n") > _PIECE) & (F.col("_n") * 1000 > total))  # fewer than a thousand
    hot = hot.select("db", "_anchor", F.ceil(F.col("_n") / F.lit(_PIECE)).alias("_pieces"))
    met = met.join(F.broadcast(hot), ["db", "_anchor"], "left").withColumn(
        "_piece", F.when(F.col("_pieces").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("_name"), "_pieces")))
    cold = chosen.join(F.broadcast(hot.select("db", "_anchor")), ["db", "_anchor"], "left_anti").drop("_piece").distinct().withColumn(
        "_piece", F.lit(0).cast("bigint"))
    split = chosen.join(F.broadcast(hot.select("db", "_anchor")), ["db", "_anchor"], "left_semi")
    met = met.drop("_pieces").withColumn("_piece", F.col("_piece").cast("bigint"))
    hits = cold.unionByName(split).join(met, ["db", "_anchor", "_piece"]).drop("_anchor", "_piece")
    every = ordered.salted_join(names, free, ["db"]).select(*hits.columns)
    return hits.unionByName(every).where(F.rlike("_name", glob_regex("_tok")))


def _slot(db: str, anchor: str) -> Column:
    return F.xxhash64(db, anchor).bitwiseAND(F.lit(_FILTER_BITS - 1))


def _used_anchors(name: str, used: list) -> Column:
    """The anchors of a name that some glob may use, by a filter of fixed size for each length of anchors."""
    found = F.array().cast("array<string>")
    for length in sorted({r["_long"] for r in used}):
        words = [0] * (_FILTER_BITS // 64)
        for r in used:
            if r["_long"] == length:
                words[r["word"]] = r["bits"]
        marked, last = f"concat('^', {name}, '$')", f"length({name}) + {3 - length}"
        pieces = F.expr(f"transform(sequence(1, greatest({last}, 1)), i -> substring({marked}, i, {length}))")
        found = F.concat(found, F.filter(pieces, _in_filter(F.lit(words).cast("array<bigint>"))))
    return F.array_distinct(found)


def _in_filter(table: Column):
    def asked(piece: Column) -> Column:
        slot = F.xxhash64("db", piece).bitwiseAND(F.lit(_FILTER_BITS - 1))
        word = F.element_at(table, (F.shiftright(slot, 6) + 1).cast("int"))
        return F.call_function("getbit", word, slot.bitwiseAND(F.lit(63)).cast("int")) == 1

    return asked


def resolve_tables(manifest: DataFrame, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(resolved, missing) of grouped tokens against a catalog (db, tbl).

    ``manifest`` has db, role and token. Excluded tables are taken out whichever token named them;
    a plain include that names no table, and is not excluded itself, is missing, and so is every
    include of an unknown database.

    Plain tokens and tables meet in one aggregate by name; only globs are joined.
    """
    toks = manifest.select("db", "role", "token", F.lower("token").alias("_tok")).distinct()
    wild = F.col("_tok").rlike(r"[*?]")
    nothing = F.lit(None).cast("string")
    plain = toks.where(~wild).select("db", F.col("_tok").alias("_name"), nothing.alias("tbl"),
                                     F.when(F.col("role") == "include", F.col("token")).alias("token"), "role")
    tables = catalog.select("db", F.lower("tbl").alias("_name"), "tbl", nothing.alias("token"), nothing.alias("role"))
    named = plain.unionByName(tables)
    globs = toks.where(wild).select("db", "role", "_tok").distinct()
    hits = match_globs(globs, named.where(F.col("_name") != "").select("db", "_name").distinct())
    rows = named.unionByName(hits.select("db", "_name", nothing.alias("tbl"), nothing.alias("token"), "role"))
    judged = rows.groupBy("db", "_name").agg(
        F.max("tbl").alias("tbl"), F.max("token").alias("token"),
        F.coalesce(F.max(F.col("role") == "include"), F.lit(False)).alias("_in"),
        F.coalesce(F.max(F.col("role") == "exclude"), F.lit(False)).alias("_out"))
    resolved = judged.where(F.col("tbl").isNotNull() & F.col("_in") & ~F.col("_out")).select("db", "tbl")
    absent = judged.where(F.col("tbl").isNull() & F.col("token").isNotNull() & ~F.col("_out")).select("db", "token")
    databases = catalog.select("db").distinct()
    missing = absent.join(databases, "db", "left_semi").withColumn("error_type", F.lit("TABLE_NOT_FOUND")).unionByName(
        toks.where(F.col("role") == "include").join(databases, "db", "left_anti").select(
            "db", "token", F.lit("DATABASE_NOT_FOUND").alias("error_type")).distinct())
    return resolved, missing


def unmatched_tokens(tokens: DataFrame, catalog: DataFrame) -> DataFrame:
    """Tokens that name no table, to be reported."""
    hits = match_tokens(tokens, catalog).select("db", "token").distinct()
    return tokens.select("db", "token").distinct().join(hits, ["db", "token"], "left_anti")
