"""Conversions that are interrupted, and what the next run makes of them."""

import pytest

from helpers import rows
from tablekit.operators import lifecycle as life
from tablekit.operators.journal import Journal


class Stop(Exception):
    pass


@pytest.fixture
def table(spark, db, tmp_path):
    path = str(tmp_path / "src")
    spark.createDataFrame([(i, f"s{i}", "xy"[i % 2]) for i in range(6)], "id int, s string, p string").write.orc(path)
    spark.sql(f"CREATE TABLE {db}.t USING orc LOCATION '{path}'")
    return db


def convert(spark, db, tmp_path, stop=None, fmt="parquet", keys=("p",), **more):
    def stopping(step):
        if step == stop:
            raise Stop

    return life.convert_in_place(spark, db, "t", fmt, list(keys), journals=str(tmp_path / "j"), on_step=stopping, **more).first()


def names(spark, db):
    return sorted(t.name for t in spark.catalog.listTables(db))


@pytest.mark.parametrize("stop,state", [("START", "READY"), ("COPIED", "READY"), ("STAGED", "RESUMED"), ("BACKED_UP", "ROLLED_FORWARD"),
                                        ("SWAPPED", "ALREADY_MIGRATED"), ("DONE", "ALREADY_MIGRATED")])
def test_next_run_completes(spark, table, tmp_path, stop, state):
    before = rows(spark.table(f"{table}.t"), "id", "s", "p")
    with pytest.raises(Stop):
        convert(spark, table, tmp_path, stop)
    copies = []
    plain = life.convert_verified
    life.convert_verified = lambda *a, **k: copies.append(1) or plain(*a, **k)
    try:
        done = convert(spark, table, tmp_path)
    finally:
        life.convert_verified = plain
    assert (done["status"], done["state"], done["source_rows"], done["dest_rows"]) == ("COMPLETED", state, 6, 6)
    assert len(copies) == (state == "READY")
    assert rows(spark.table(f"{table}.t"), "id", "s", "p") == before
    assert names(spark, table) == ["t", "t_backup_"]
    assert convert(spark, table, tmp_path)["state"] == "ALREADY_MIGRATED"


def test_a_changed_source_is_copied_again(spark, table, tmp_path):
    with pytest.raises(Stop):
        convert(spark, table, tmp_path, "STAGED")
    spark.sql(f"INSERT INTO {table}.t VALUES (99, 'new', 'z')")
    done = convert(spark, table, tmp_path)
    assert (done["status"], done["state"], done["dest_rows"]) == ("COMPLETED", "STAGING_CLEARED", 7)
    assert spark.table(f"{table}.t").where("p = 'z'").count() == 1


def test_second_conversion_is_refused_before_any_copy(spark, table, tmp_path):
    assert convert(spark, table, tmp_path)["status"] == "COMPLETED"
    before = rows(spark.table(f"{table}.t"), "id", "s", "p")
    done = convert(spark, table, tmp_path, fmt="json")
    assert (done["status"], done["state"], done["code"]) == ("SKIPPED", "BACKUP_CONFLICT", "INPLACE_CTAS_BACKUP_CONFLICT")
    assert names(spark, table) == ["t", "t_backup_"] and rows(spark.table(f"{table}.t"), "id", "s", "p") == before
    assert [n["step"] for n in Journal(spark, table, "t", str(tmp_path / "j")).notes] == ["START", "COPIED", "STAGED", "DONE"]


def test_lost_staging_is_rolled_back_and_foreign_backups_stay(spark, table, tmp_path):
    with pytest.raises(Stop):
        convert(spark, table, tmp_path, "BACKED_UP")
    spark.sql(f"DROP TABLE {table}.t__ice_staging")
    assert convert(spark, table, tmp_path)["state"] == "ROLLED_BACK"
    spark.sql(f"DROP TABLE {table}.t")
    spark.sql(f"DROP TABLE {table}.t_backup_")
    spark.sql(f"CREATE TABLE {table}.t_backup_ (id INT) USING orc LOCATION '{tmp_path}/other'")
    done = convert(spark, table, tmp_path)
    assert (done["status"], done["state"], done["code"]) == ("FAILED", "ROLLBACK_BLOCKED", "INPLACE_CTAS_SWAP_INCOMPLETE")
    spark.sql(f"DROP TABLE {table}.t_backup_")
    assert convert(spark, table, tmp_path)["state"] == "UNRECOVERABLE"


def test_without_backup(spark, table, tmp_path):
    assert convert(spark, table, tmp_path, keep_backup=False)["status"] == "COMPLETED"
    assert names(spark, table) == ["t"]
    done = convert(spark, table, tmp_path, fmt="orc")  # the next conversion starts a journal entry of its own
    assert (done["status"], done["state"]) == ("COMPLETED", "READY")


def test_views_and_tables_of_older_conversions(spark, table, tmp_path):
    spark.sql(f"CREATE TABLE {table}.t_backup_ (id INT) USING orc LOCATION '{tmp_path}/other'")
    assert convert(spark, table, tmp_path)["state"] == "BACKUP_CONFLICT"
    spark.sql(f"DROP TABLE {table}.t_backup_")
    spark.sql(f"DROP TABLE {table}.t")
    spark.sql(f"CREATE VIEW {table}.t AS SELECT 1 AS id, 'a' AS p")
    assert convert(spark, table, tmp_path)["code"] == "SOURCE_IS_VIEW"
