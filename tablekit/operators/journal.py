"""What has been done to a table, on shared storage, so that a rerun knows where an earlier run stopped."""

from __future__ import annotations

from pyspark.sql import Row, SparkSession
from pyspark.sql.utils import AnalysisException

from ..session import shared_dir

NOTE_DDL = ("seq bigint, step string, source string, place string, format string, keys string, row_count bigint, "
            "checksum decimal(38,0)")


class Journal:
    """Steps of the conversions of one table, oldest first. A conversion begins with a START note.

    Each note is one committed write, so it is there as a whole or not at all.
    """

    def __init__(self, spark: SparkSession, db: str, tbl: str, root: str | None = None):
        self.spark = spark
        self.path = f"{(root or shared_dir(spark) + '/conversions').rstrip('/')}/{db}/{tbl}"
        self.notes = self._read()

    def _read(self) -> list[Row]:
        """A handful of notes per conversion of this table."""
        try:
            found = self.spark.read.schema(NOTE_DDL).json(self.path)
        except AnalysisException as err:
            if "PATH_NOT_FOUND" in str(err):
                return []
            raise
        return found.orderBy("seq").collect()

    @property
    def current(self) -> list[Row]:
        """Notes of the newest conversion."""
        starts = [i for i, n in enumerate(self.notes) if n["step"] == "START"]
        return self.notes[starts[-1]:] if starts else []

    def knows(self, step: str) -> Row | None:
        """The note of a step of the newest conversion."""
        return next((n for n in reversed(self.current) if n["step"] == step), None)

    def note(self, step: str, **facts) -> None:
        start = self.current[0].asDict() if self.current and step != "START" else {}
        names = [f.split(" ")[0] for f in NOTE_DDL.split(", ")]
        row = {**{k: start.get(k) for k in names}, "row_count": None, "checksum": None, **facts,
               "seq": len(self.notes), "step": step}
        made = self.spark.createDataFrame([tuple(row[k] for k in names)], NOTE_DDL)
        made.coalesce(1).write.mode("append").json(self.path)
        self.notes.append(Row(**row))
