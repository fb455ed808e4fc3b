import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tablekit.operators import partitions as p

DAYS = ["dt=2024-01-01", "dt=2024-01-02", "dt=2024-01-03"]
MONTHS = ["year=2023/month=11", "year=2023/month=12", "year=2024/month=01"]


def pick(spark, specs, expression, **options):
    frame = spark.createDataFrame([("d", "t", s) for s in specs], "db string, tbl string, spec string")
    found = {r["spec"] for r in p.select_partitions(frame, expression, **options).collect()}
    return [s for s in specs if s in found]


@pytest.mark.parametrize("specs, expression, expected", [
    (DAYS, "", DAYS),
    (DAYS, None, DAYS),
    (DAYS, "last_n_partitions=2", DAYS[1:]),
    (DAYS, "LAST_N_PARTITIONS = 9", DAYS),
    (MONTHS, "year=2023/*", MONTHS[:2]),
    (MONTHS, "year=????/month=1?", MONTHS[:2]),
    (["region=us/dt=1", "region=us-east/dt=2", "region=eu/dt=1"], "region=us*", ["region=us/dt=1", "region=us-east/dt=2"]),
    (DAYS, "dt>='2024-01-02'", DAYS[1:]),
    (MONTHS, "year=2023 AND month=12", [MONTHS[1]]),
    (MONTHS, "year=2024 OR month=11", [MONTHS[0], MONTHS[2]]),
    (MONTHS, "year=2024/month=1", [MONTHS[2]]),
    (MONTHS, "month=1", [MONTHS[2]]),
    (["partition_id=5", "partition_id=10", "partition_id=15"], "partition_id>=10", ["partition_id=10", "partition_id=15"]),
    (["p=1e1", "p=10", "p=x"], "p=10", ["p=1e1", "p=10"]),
    (["p=1d", "p=1"], "p=1", ["p=1"]),
    (DAYS, "dt=2024-01-01, last_n_partitions=1", [DAYS[0], DAYS[2]]),
    (DAYS[::-1], "dt=2024-01-01, dt=2024-01-03", ["dt=2024-01-03", "dt=2024-01-01"]),
    (DAYS, "nope=1", []),
    (["c=a%20b", "c=a+b", "c=50%"], "c='a b'", ["c=a%20b"]),
    (["c=a%20b", "c=a+b", "c=50%"], "c='a+b', c='50%'", ["c=a+b", "c=50%"]),
    (["c=2024%2F01", "c=2"], "c='2024/01'", ["c=2024%2F01"]),
    (MONTHS, "(year!=2023)", [MONTHS[2]]),
])
def test_filter(spark, specs, expression, expected):
    assert pick(spark, specs, expression) == expected


@pytest.mark.parametrize("expression", ["year=2023/* AND month=1", "dt IN (1,2)", "nonsense", "a=1 AND"])
def test_unreadable_terms(spark, expression):
    with pytest.raises(p.FilterError):
        p.parse_filter(expression)


def test_unreadable_terms_select_nothing_when_not_strict(spark):
    assert pick(spark, DAYS, "nonsense", strict=False) == []
    assert pick(spark, DAYS, "nonsense, dt=2024-01-02", strict=False) == [DAYS[1]]


def test_last_n_counts_per_table(spark):
    frame = spark.createDataFrame([("d", t, f"k={i:04d}") for t, n in (("hot", 500), ("cold", 3)) for i in range(n)],
                                  "db string, tbl string, spec string")
    got = rows(p.select_partitions(frame, "last_n_partitions=5").groupBy("tbl").agg(F.count("*"), F.min("spec")))
    assert got == [("cold", 3, "k=0000"), ("hot", 5, "k=0495")]


def test_spec_map_and_value(spark):
    frame = spark.createDataFrame([("a=1/junk/b=x%3Dy/a='2'",)], "spec string")
    row = frame.select(p.spec_map("spec").alias("m"), p.spec_value("spec", "b").alias("b"),
                       p.spec_value("spec", "z").alias("z")).first()
    assert row["m"] == {"a": "2", "b": "x=y"} and row["b"] == "x=y" and row["z"] is None


def test_restrict(spark):
    data = spark.createDataFrame([(2023, "01", 1), (2023, "1", 2), (2024, "01", 3)], "year int, month string, v int")
    chosen = spark.createDataFrame([("year=2023/month=01",), ("year=2023/month=01",)], "spec string")
    assert rows(p.restrict(data, chosen, ["year", "month"]), "v") == [(1,)]
    assert rows(p.restrict(data, chosen.limit(0), ["year", "month"])) == []


def test_specs_predicate(spark):
    data = spark.createDataFrame([("2023", "01"), ("2024", "01")], "year string, month string")
    assert rows(data.where(p.specs_predicate(["year=2024/month=01"]))) == [("2024", "01")]
    assert rows(data.where(p.specs_predicate([]))) == []


def test_compare_partitions(spark):
    ddl = "db string, tbl string, spec string"
    left = spark.createDataFrame([("d", "t", s) for s in ("m=1", "m=02", "m=3", "m=9")], ddl)
    right = spark.createDataFrame([("d", "t", s) for s in ("m=01", "m=02", "m=4", "m=9")], ddl)
    got = rows(p.compare_partitions(left, right), "spec", "state", "padded_as")
    assert got == [("m=01", "PADDING", "m=1"), ("m=02", "MATCH", None), ("m=1", "PADDING", "m=01"),
                   ("m=3", "EMPTY", None), ("m=4", "UNREGISTERED", None), ("m=9", "MATCH", None)]


def brute(kv, expression):
    """A plain evaluation of OR-of-AND comparisons."""
    import operator as o

    tests = {"=": o.eq, "!=": o.ne, ">": o.gt, ">=": o.ge, "<": o.lt, "<=": o.le}

    def one(clause):
        name, op, literal = clause
        actual = kv.get(name)
        if actual is None:
            return False
        try:
            return tests[op](float(actual), float(literal))
        except ValueError:
            return tests[op](actual, literal)

    return any(all(one(c) for c in choice) for choice in expression)


def test_random_conditions_match_a_plain_evaluation(spark):
    rng = random.Random(11)
    words = ["1", "01", "2", "10", "9", "1e1", "a", "b", "-3", "2.5", "10x"]
    specs = sorted({f"k={rng.choice(words)}/m={rng.choice(words)}" for _ in range(80)})
    expressions = [
        [[(rng.choice("kmz"), rng.choice(["=", "!=", ">", ">=", "<", "<="]), rng.choice(words)) for _ in range(rng.randint(1, 3))]
         for _ in range(rng.randint(1, 3))] for _ in range(40)]
    texts = [" OR ".join(" AND ".join(f"{n}{op}'{v}'" for n, op, v in choice) for choice in e) for e in expressions]
    frame = spark.createDataFrame([(s,) for s in specs], "spec string")
    flags = [p.term_predicate(p.parse_filter(t)[0]).alias(f"f{i}") for i, t in enumerate(texts)]
    for row in frame.select("spec", *flags).collect():
        kv = dict(part.split("=", 1) for part in row["spec"].split("/"))
        assert [row[f"f{i}"] for i in range(len(texts))] == [brute(kv, e) for e in expressions], row["spec"]
