"""Location arithmetic on string columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# URI schemes of the same object store.
OBJECT_STORE_SCHEMES = ("s3a", "s3", "s3n")
CANONICAL_SCHEME = "s3a://"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind_once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, however often ``use`` mentions it.

    The optimizer copies a column's expression into every mention when it moves a filter below a
    projection; a lambda variable is not copied.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def drop_trailing_slash(c: Column | str) -> Column:
    return F.regexp_replace(col(c), "/+$", "")


def object_store_uri(c: Column | str) -> Column:
    """Spell the scheme as s3a, adding it when missing. Case-sensitive; blank stays blank."""
    c = col(c)
    return (
        F.when(c.isNull() | (c == ""), c)
        .when(c.startswith(CANONICAL_SCHEME), c)
        .otherwise(F.concat(F.lit(CANONICAL_SCHEME), F.regexp_replace(c, "^s3n?://", "")))
    )


def plain_path(c: Column | str) -> Column:
    """Path without scheme and authority, single slashes, no trailing slash; '' for a bare root."""
    no_scheme = F.regexp_replace(F.trim(F.coalesce(col(c), F.lit(""))),
                                 r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?(?=/|$)", "")
    body = F.regexp_replace(F.regexp_replace(no_scheme, "/+", "/"), "^/|/$", "")
    return F.when(body == "", F.lit("")).otherwise(F.concat(F.lit("/"), body))


def local_path(c: Column | str) -> Column:
    """A location spelled one way: no ``file:``, one slash after other schemes without an authority, none at the end."""
    spelled = F.regexp_replace(col(c), r"^([A-Za-z][A-Za-z0-9+.-]*):/(?=//|[^/]|$)(//)?", "$1:/")
    return drop_trailing_slash(F.regexp_replace(spelled, r"^file:(?=/)", ""))


def location_parts(c: Column | str) -> Column:
    """struct(scheme, authority, path) of a location; scheme in lower case."""
    pattern = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/]*))?(.*)$"
    text = F.trim(F.coalesce(col(c), F.lit("")))
    text = F.when(text.rlike("^/+$"), F.lit("/")).otherwise(drop_trailing_slash(text))
    path = F.regexp_replace(F.regexp_extract(text, pattern, 3), "/+", "/")
    return F.struct(
        F.lower(F.regexp_extract(text, pattern, 1)).alias("scheme"),
        F.regexp_extract(text, pattern, 2).alias("authority"),
        path.alias("path"),
    )


def is_inside(path: Column | str, root: Column | str) -> Column:
    """True when ``path`` is ``root`` or below it.

    A scheme or authority missing on one side is taken as equal; an empty path is never inside.
    """
    def under(both: Column) -> Column:
        p, r = both["p"], both["r"]

        def differs(field: str) -> Column:
            return (p[field] != "") & (r[field] != "") & (p[field] != r[field])

        below = p["path"].startswith(F.concat(drop_trailing_slash(r["path"]), F.lit("/")))
        inside = (p["path"] == r["path"]) | below
        return (p["path"] != "") & (r["path"] != "") & ~differs("scheme") & ~differs("authority") & inside

    return bind_once(F.struct(location_parts(path).alias("p"), location_parts(root).alias("r")), under)


def destination_path(location, database, table, bucket, source_prefix, dest_prefix) -> Column:
    """Swap the source prefix for the destination one, else place under bucket/database/table."""
    location, source_prefix, dest_prefix = col(location), col(source_prefix), col(dest_prefix)
    has_both = (F.coalesce(source_prefix, F.lit("")) != "") & (F.coalesce(dest_prefix, F.lit("")) != "")
    rest = F.substring(location, F.length(source_prefix) + 1, F.length(location))
    swapped = F.concat(drop_trailing_slash(dest_prefix), F.lit("/"), F.regexp_replace(rest, "^/+", ""))
    default = F.concat_ws("/", drop_trailing_slash(bucket), col(database), col(table))
    return F.when(has_both & location.startswith(source_prefix), swapped).otherwise(default)


def rebase(path, from_prefix, to_prefix) -> Column:
    """Replace a leading prefix; NULL when the path does not start with it."""
    path = col(path)
    base = drop_trailing_slash(from_prefix)
    rest = F.substring(path, F.length(base) + 1, F.length(path))
    return F.when(path.startswith(base), F.concat(drop_trailing_slash(to_prefix), rest))


def rebase_problem(path, from_prefix) -> Column:
    """Reason text for a path that cannot be rebased, else NULL."""
    path, base = col(path), drop_trailing_slash(from_prefix)
    return F.when(~path.startswith(base), F.concat(path, F.lit(" is not under "), base))


def sibling_target(location) -> Column:
    """``<location>_iceberg`` for object-store locations in any case, else NULL."""
    loc = F.trim(F.coalesce(col(location), F.lit("")))
    pattern = "(?i)^(" + "|".join(OBJECT_STORE_SCHEMES) + ")://"
    body = drop_trailing_slash(F.regexp_replace(loc, pattern, ""))
    return F.when(loc.rlike(pattern), F.concat(F.lit(CANONICAL_SCHEME), body, F.lit("_iceberg")))


def base_name(c) -> Column:
    return F.substring_index(drop_trailing_slash(c), "/", -1)


def bucket_uri(c) -> Column:
    """Bucket cell as a clean URI: a bare ``s3:`` lead is dropped, slashes collapsed."""
    text = F.regexp_replace(F.trim(col(c)), "(?i)^s3:(?!//)", "")
    uri = object_store_uri(F.trim(text))
    scheme = F.substring_index(uri, "://", 1)
    body = F.regexp_replace(F.substring(uri, F.length(scheme) + 4, F.length(uri)), "/+", "/")
    return F.concat(scheme, F.lit("://"), F.regexp_replace(body, "^/|/$", ""))


def folder_target(source_path, bucket, folder) -> Column:
    """struct(dest_bucket, dest_folder): folder defaults to the source's last segment and is
    not repeated when the bucket already ends with it."""
    cleaned = F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(col(folder), F.lit(""))), "/+", "/"),
                               "^/|/$", "")
    name = F.when(cleaned == "", base_name(source_path)).otherwise(cleaned)
    uri = bucket_uri(bucket)
    repeated = (name != "") & uri.endswith(F.concat(F.lit("/"), name))
    shorter = drop_trailing_slash(F.substring(uri, F.lit(1), F.length(uri) - F.length(name) - 1))
    return F.struct(F.when(repeated, shorter).otherwise(uri).alias("dest_bucket"), name.alias("dest_folder"))


def ancestors(path, include_self: bool = False) -> Column:
    """All proper ancestors of a path as an array, nearest last; optionally the path itself.

    ``s3a://b/x/y`` gives ``s3a://b`` and ``s3a://b/x``; scheme slashes do not count as a level.
    """
    path = col(path)
    lead = F.regexp_extract(path, r"^([A-Za-z][A-Za-z0-9+.-]*://)?", 0)
    pieces = F.split(F.substring(path, F.length(lead) + 1, F.length(path)), "/")
    last = F.size(pieces) if include_self else F.size(pieces) - 1
    levels = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    joined = F.transform(levels, lambda n: F.concat(lead, F.array_join(F.slice(pieces, F.lit(1), n), "/")))
    return F.filter(joined, lambda x: x != "")
