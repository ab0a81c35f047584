"""Verdicts and reasons."""

import countersign as cs
import fixtures as fx


def both(spark):
    keyed = cs.compare(*fx.keyed(spark), table_name="keyed", partition_column="pt")
    flat = cs.compare(*fx.flat(spark), table_name="flat")
    equal = cs.compare(*fx.equal(spark), table_name="equal", partition_column="pt")
    return keyed.unionByName(flat).unionByName(equal)


KEYED_1 = [
    "pt=20250101: `amount`.sum: Left=1349.0 vs Right=450.0",
    "pt=20250101: `amount`.max: Left=999.0 vs Right=200.0",
    "pt=20250101: `amount`.min: Left=150.0 vs Right=100.0",
]
KEYED_2 = [
    "pt=20250102: `*`.count: Left=4 vs Right=3",
    "pt=20250102: `id`.sum: Left=22 vs Right=15",
    "pt=20250102: `id`.max: Left=7 vs Right=6",
    "pt=20250102: `amount`.sum: Left=1130.0 vs Right=730.0",
    "pt=20250102: `amount`.max: Left=400.0 vs Right=300.0",
    "pt=20250102: `score`.sum: Left=345 vs Right=253",
]


def test_table_status_and_totals(spark):
    tables = cs.table_status(both(spark))
    rows = {r.table_name: (r.status, r.partitions_compared, r.n_diffs, r.partitioned) for r in tables.collect()}
    assert rows == {
        "keyed": ("FAIL", 2, 9, True), "flat": ("FAIL", 0, 6, False), "equal": ("PASS", 2, 0, True)}
    assert tuple(cs.run_totals(tables).first()) == (3, 2)
    assert [(r.number, r.table_name) for r in cs.failing_tables(tables).orderBy("number").collect()] == [
        (1, "flat"), (2, "keyed")]


def test_totals_of_nothing(spark):
    assert tuple(cs.run_totals(cs.table_status(both(spark)).limit(0)).first()) == (0, 0)


def test_reasons_in_partition_and_metric_order(spark):
    reasons = {(r.table_name, r.pt): r for r in cs.partition_reasons(both(spark)).collect()}
    assert set(reasons) == {("keyed", "20250101"), ("keyed", "20250102"), ("flat", None)}
    assert reasons["keyed", "20250101"].reason == "; ".join(KEYED_1)
    assert reasons["keyed", "20250102"].reason == "; ".join(KEYED_2)
    assert reasons["flat", None].reason.startswith("`*`.count: Left=6 vs Right=5; `id`.sum: Left=21 vs Right=15; ")


def test_reasons_have_one_shape_at_any_size(spark):
    for n in (10_000, 10_001):
        keys = spark.range(n).selectExpr("CAST(id AS STRING) AS pt", "'x' AS name")
        reasons = cs.partition_reasons(cs.compare(keys, keys.limit(0), table_name="t", partition_column="pt"))
        assert reasons.columns == ["table_name", "partitioned", "pt", "n_diffs", "reason"]
        assert reasons.count() == n and reasons.filter("reason IS NULL OR n_diffs <> 1").isEmpty()


def test_labels(spark):
    reason = cs.partition_reasons(both(spark), labels=("Old", "New")).filter("table_name = 'flat'").first().reason
    assert reason.startswith("`*`.count: Old=6 vs New=5; ")
