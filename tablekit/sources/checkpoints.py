"""Per-item checkpoint records as a JSON dataset, one folder per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..operators.state import check_run_id

CHECKPOINT_DDL = (
    "run_id string, checkpoint_key string, source_database string, source_table string, dest_database string, "
    "partition_filter string, attempt int, status string, bytes_copied bigint, files_copied bigint, error string"
)


def write_checkpoints(records: DataFrame, path: str) -> None:
    """Append all records in one write."""
    records.write.mode("append").partitionBy("run_id").json(path)


def read_checkpoints(spark: SparkSession, path: str, run_id: str | None = None,
                     ddl: str = CHECKPOINT_DDL) -> DataFrame:
    """Records of all runs or one run; no rows when nothing was written yet."""
    try:
        found = spark.read.schema(ddl).json(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err):
            return spark.createDataFrame([], ddl)
        raise
    return found.where(F.col("run_id") == check_run_id(run_id)) if run_id else found


def drop_run(spark: SparkSession, path: str, run_id: str) -> bool:
    """Delete one run's checkpoints through the catalog's file system; refuses anything but a run id."""
    folder = f"{path.rstrip('/')}/run_id={check_run_id(run_id)}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(system.delete(hadoop, True))
