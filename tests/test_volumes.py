"""Volumes of tables: distinct paths by value, no copies of rows, a bounded number of lines in a task."""

from datetime import datetime

from tablekit.plans import copying


def test_paths_are_counted_without_copies_of_rows(spark, tmp_path, monkeypatch):
    at = [None, datetime(1995, 3, 1), datetime(1995, 3, 1, 7), datetime(1995, 3, 2), datetime(1995, 4, 1)]
    rows = [(s, t, float(q), f) for s in (1, 2, None) for i, t in enumerate(at) for q, f in ((50, "A"), (5 + 3 * i, "A"), (49, "N"))]
    rows += [(1, at[3], None, None), (3, at[1], 60.0, "A"), (3, at[1], 60.0, "A"), (2, at[4], 7.0, "R")]
    spark.createDataFrame(rows, "l_suppkey bigint, l_shipdate timestamp, l_quantity double, l_returnflag string").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(copying, "LINES_A_TASK", 10)
    found = copying.table_volumes(spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and f", {len(rows) // 10 + 1})" in plan
    got = {(r["db"], r["tbl"]): r for r in found.collect()}
    groups: dict = {}
    for s, t, q, f in rows:
        groups.setdefault((None if s is None else f"sup_{s}", t and t.strftime("%Y-%m")), []).append((t, q, f))
    assert set(got) == set(groups)
    for key, own in groups.items():
        chosen = [(t, q) for t, q, f in own if f == "A"]
        r = got[key]
        assert (r["file_count"], r["filtered_files"]) == (len(own), len(chosen))
        assert r["size_bytes"] == sum(int(q) for _, q, _ in own if q is not None) * 104_857_600
        assert r["filtered_bytes"] == sum(int(q) for _, q in chosen) * 104_857_600
        assert r["selected_paths"] == len({t for t, _ in chosen if t})
        assert r["nonempty_paths"] == len({t for t, q in chosen if t and q > 10})
        assert r["filter_active"] == any(f == "N" for _, _, f in own)
        assert r["failed"] == (min(q for _, q, _ in own if q is not None) >= 49)
