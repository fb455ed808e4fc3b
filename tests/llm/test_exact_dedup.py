"""The stateful stream against a dictionary of texts."""

import hashlib

from conftest import make, odd_rows
from pyspark.sql import functions as F

from tablekit.llm import exact_dedup


def plain(rows):
    """(id, digest, keep_id, group_size) of every row, sorted."""
    groups = {}
    for i, text, _ in rows:
        groups.setdefault(text or "", []).append(i)
    top = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, hashlib.sha256((t or "").encode()).hexdigest(), top[t or ""], len(groups[t or ""])) for i, t, _ in rows),
                  key=repr)


def write(spark, rows, folder, mode="overwrite"):
    make(spark, rows).repartition(3).write.mode(mode).parquet(folder)
    return folder


def check(done, rows):
    got = done.collect()
    assert sorted(((r["id"], bytes(r["digest"]).hex(), r["keep_id"], r["group_size"]) for r in got), key=repr) == plain(rows)
    kept = [r for r in got if r["kept"]]
    assert all(r["id"] == r["keep_id"] for r in kept)
    assert len(kept) == len({t or "" for _, t, _ in rows})  # one of each text, also among rows with the same id


def test_odd_rows(spark, tmp_path):
    rows = odd_rows() + [(None, "", "a"), (None, "without id", "a"), (None, "without id", "b"), (7000, "without id", "c")]
    rows += [(8000 + i, "a hot text", "h") for i in range(60)]
    check(exact_dedup.dedup_exact(spark, write(spark, rows, f"{tmp_path}/docs")), rows)


def test_one_file(spark, tmp_path):
    rows = [(1, "a", "x"), (2, "a", "x"), (3, None, "x"), (4, "", "x")]
    make(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/docs")
    (path,) = tmp_path.glob("docs/part-*.parquet")
    check(exact_dedup.dedup_exact(spark, str(path)), rows)


def test_empty_table(spark, tmp_path):
    assert exact_dedup.dedup_exact(spark, write(spark, [], f"{tmp_path}/docs")).collect() == []


def test_weak_digests_are_told_apart_by_their_bytes(spark, tmp_path):
    rows = [(i, f"text {i % 23}", "a") for i in range(200)] + [(500, None, "a"), (501, "", "a")]
    weak = lambda text: F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 1))
    got = exact_dedup.dedup_exact(spark, write(spark, rows, f"{tmp_path}/docs"), digest=weak).collect()
    assert len({bytes(r["digest"]) for r in got}) < 16
    assert sorted((r["id"], r["keep_id"], r["group_size"]) for r in got) == sorted((i, k, n) for i, _, k, n in plain(rows))
    assert sum(r["kept"] for r in got) == 24


def test_state_goes_on_with_new_files(spark, tmp_path):
    first = [(i, f"text {i % 10}", "a") for i in range(30)]
    second = [(100 + i, f"text {i % 15}", "b") for i in range(15)] + [(5, "text 3", "b")]
    folder, state = f"{tmp_path}/docs", f"{tmp_path}/state"
    check(exact_dedup.dedup_exact(spark, write(spark, first, folder), state), first)
    write(spark, second, folder, "append")
    read = {r["digest"]: r["size"] for r in exact_dedup.ingest(spark, folder, state).collect()}
    assert sum(read.values()) == len(first) + len(second)  # the files of the first call were not counted again
    check(exact_dedup.dedup_exact(spark, folder, state), first + second)
