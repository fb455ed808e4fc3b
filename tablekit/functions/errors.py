"""Error text to a reason code. The first code whose phrase occurs wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .paths import bind_once, col

# Reason codes with the phrases (lower case) that mean them, in the order they are tried.
NO_DATABASE = ("nosuchdatabaseexception", "schema_not_found", "database not found", "unknown database")
NO_TABLE = ("table or view not found", "nosuchtableexception", "table_or_view_not_found", "cannot find table")
NO_ACCESS = ("access denied", "accessdenied", "permission denied", "not authorized",
             "status code: 403", "forbidden")
MIGRATION_CODES = (
    ("SOURCE_NOT_V1_TABLE", ("non-v1 table",)),
    ("DATABASE_NOT_FOUND", NO_DATABASE),
    ("TABLE_NOT_FOUND", NO_TABLE),
    ("PERMISSION_DENIED", NO_ACCESS),
    ("DATA_PATH_MISSING", ("path does not exist", "filenotfoundexception", "no such file or directory",
                           "nosuchkey", "status code: 404")),
    ("DESTINATION_EXISTS", ("already exists", "tablealreadyexists")),
    ("UNSUPPORTED_SOURCE_FORMAT", ("lazysimpleserde", "unsupported file format", "is not a parquet file",
                                   "not an orc file", "malformed orc", "unsupported format")),
    ("SOURCE_DATA_UNREADABLE", ("parquetdecodingexception", "can not read value at",
                                "could not read footer", "corruptrecordexception",
                                "org.apache.hadoop.hive.ql.io.parquet.convert")),
    ("UNSUPPORTED_DATA_TYPE", ("unsupported data type", "unsupported type", "cannot convert",
                               "cannot be cast", "cannot up cast")),
    ("RESOURCE_ERROR", ("outofmemory", "java heap space", "container killed", "no space left",
                        "gc overhead limit", "executor lost")),
    ("CONCURRENT_COMMIT_CONFLICT", ("commitfailedexception", "cannot commit", "metadata location has changed",
                                    "found conflicting files", "found conflicting deleted files",
                                    "found new conflicting delete files")),
)
METADATA_CODES = (
    ("DATABASE_NOT_FOUND", NO_DATABASE),
    ("TABLE_NOT_FOUND", NO_TABLE + ("table not found",)),
    ("PERMISSION_DENIED", NO_ACCESS),
)
METADATA_SKIPPED = ("DATABASE_NOT_FOUND", "TABLE_NOT_FOUND")
CORRUPT_SCHEMA = ("could not read schema from the hive metastore because it is corrupted",)
DISCOVERY_NO_ACCESS = ("permission denied", "accesscontrolexception", "access denied", "not authorized")
PERMANENT_MARKERS = (
    "corrupt parquet", "corruptrecordexception", "parquet.io.parquetdecodingexception", "footer is missing",
    "invalid parquet file", "not a parquet file", "could not read footer", "table_or_view_not_found",
    "cannot be found. verify the spelling",
)
# Short labels of the reason codes in reports.
REASON_LABELS = {
    "TABLE_NOT_FOUND": "Table not found in metastore",
    "DATABASE_NOT_FOUND": "Database not found in metastore",
    "NO_TABLES_MATCHED_PATTERN": "No tables matched the pattern of the sheet",
    "SOURCE_IS_VIEW": "Source object is a view, not a table",
    "ALREADY_ICEBERG": "Table is already Iceberg",
    "SOURCE_NOT_V1_TABLE": "Source is not a Hive V1 table",
    "TEXT_FORMAT_INPLACE_UNSUPPORTED": "Text-format table (in-place unsupported)",
    "MANAGED_TEXT_INPLACE_UNSUPPORTED": "Managed text table (in-place copy unsupported)",
    "INPLACE_CTAS_VERIFY_FAILED": "In-place copy failed verification",
    "INPLACE_CTAS_BACKUP_CONFLICT": "Backup table name already in use",
    "INPLACE_CTAS_SWAP_INCOMPLETE": "Previous in-place copy left the table unregistered",
    "FORMAT_UNDETECTED_INPLACE": "Storage format could not be determined",
    "UNSUPPORTED_SOURCE_FORMAT": "Unsupported source file format",
    "UNSUPPORTED_DATA_TYPE": "Unsupported column data type",
    "SOURCE_DATA_UNREADABLE": "Source data files could not be read",
    "METADATA_READ_ERROR": "Table metadata could not be read",
    "PERMISSION_DENIED": "Permission denied on table or storage path",
    "DATA_PATH_MISSING": "Data location missing in storage",
    "DESTINATION_EXISTS": "Destination table already exists",
    "RESOURCE_ERROR": "Spark ran out of resources",
    "CONCURRENT_COMMIT_CONFLICT": "Concurrent Iceberg commit conflict",
    "TASK_DID_NOT_PROCESS": "Table was never processed by the migration task",
    "MIGRATION_ERROR": "Migration error",
    "VALIDATION_ERROR": "Validation error",
}
UNLABELLED = "Reason not classified"
NO_REASON = "No reason recorded"


def mentions(text: Column, phrases) -> Column:
    """True when the text holds one of the phrases, letter case aside."""
    return bind_once(F.lower(F.coalesce(text, F.lit(""))), lambda low: _holds_one(low, phrases))


def _holds_one(low: Column, phrases) -> Column:
    hit = F.lit(False)
    for phrase in phrases:
        hit = hit | low.contains(phrase)
    return hit


def first_code(text, codes, default: str) -> Column:
    def choose(low: Column) -> Column:
        out = None
        for code, phrases in codes:
            test = _holds_one(low, phrases)
            out = F.when(test, F.lit(code)) if out is None else out.when(test, F.lit(code))
        return out.otherwise(F.lit(default))

    return bind_once(F.lower(F.coalesce(col(text), F.lit(""))), choose)


def migration_code(text) -> Column:
    return first_code(text, MIGRATION_CODES, "MIGRATION_ERROR")


def metadata_code(text, database=None) -> Column:
    """Code of a failed table description; also reads "database '<name>' not found"."""
    code = first_code(text, METADATA_CODES, "METADATA_READ_ERROR")
    if database is None:
        return code
    named = F.concat(F.lit("database '"), F.lower(col(database)), F.lit("' not found"))
    return F.when(F.lower(F.coalesce(col(text), F.lit(""))).contains(named), F.lit("DATABASE_NOT_FOUND")).otherwise(code)


def metadata_status(code: Column) -> Column:
    return F.when(code.isin(*METADATA_SKIPPED), F.lit("SKIPPED")).otherwise(F.lit("FAILED"))


def discovery_status(text, path_exists) -> Column:
    """TABLE_CORRUPTED, SOURCE_PATH_NOT_FOUND (root known to be gone) or FAILED (all else, or unknown)."""
    text, exists = col(text), col(path_exists)
    gone = F.coalesce(~exists, F.lit(False)) & ~mentions(text, DISCOVERY_NO_ACCESS)
    return (
        F.when(mentions(text, CORRUPT_SCHEMA), F.lit("TABLE_CORRUPTED"))
        .when(gone, F.lit("SOURCE_PATH_NOT_FOUND"))
        .otherwise(F.lit("FAILED"))
    )


def is_permanent(text, markers=PERMANENT_MARKERS) -> Column:
    return mentions(col(text), markers)


def reason_label(code: Column) -> Column:
    """Report label of a code; an unknown code is shown as words."""
    def label(c: Column) -> Column:
        known = F.create_map(*[F.lit(x) for pair in REASON_LABELS.items() for x in pair])
        words = F.lower(F.replace(c, F.lit("_"), F.lit(" ")))
        spelled = F.concat(F.upper(F.substring(words, 1, 1)), F.substring(words, 2, 1000))
        return F.coalesce(F.try_element_at(known, c), spelled)

    return bind_once(code, label)
