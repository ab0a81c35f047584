"""The known pairs of tables and the differences expected between their copies."""

import pytest

import countersign as cs
import fixtures as fx


def close(expected):
    return {k: (pytest.approx(a), pytest.approx(b)) for k, (a, b) in expected.items()}


def test_flat(spark):
    left, right = fx.flat(spark)
    assert fx.diffs_of(cs.compare(left, right, table_name="t")) == {None: close(fx.FLAT_DIFFS)}


def test_keyed(spark):
    left, right = fx.keyed(spark)
    metrics = cs.compare(left, right, table_name="t", partition_column="pt")
    assert fx.diffs_of(metrics) == {pt: close(d) for pt, d in fx.KEYED_DIFFS.items()}


def test_equal(spark):
    left, right = fx.equal(spark)
    metrics = cs.compare(left, right, table_name="t", partition_column="pt")
    assert fx.diffs_of(metrics) == {}
    assert metrics.count() == 2 * 10


@pytest.mark.parametrize("n_rows,counts", [(8, [3, 3, 2]), (5, [3, 2])])
def test_count_only(spark, n_rows, counts):
    left, right = fx.texts(spark, n_rows)
    metrics = cs.compare(left, right, table_name="t", partition_column="pt")
    status = cs.partition_status(metrics).orderBy("pt").collect()
    assert [r.right_count for r in status] == counts
    assert [r.left_count for r in status] == [counts[0], counts[1] + 1, *counts[2:]]
    assert [r.status for r in status] == ["PASS", "FAIL", "PASS"][: len(counts)]
    assert set(fx.diffs_of(metrics)) == {"20250102"}
    assert metrics.count() == len(counts)


def test_count_only_whole(spark):
    left = right = spark.createDataFrame([r[:3] for r in fx.TEXT_ROWS[:5]], "name string, city string, status string")
    rows = cs.compare(left, right, table_name="t").collect()
    assert [(r.column, r.metric, r.left_value, r.match) for r in rows] == [("*", "count", "5", True)]


def test_suite(spark):
    """All 93 tables in one run: 74 fail, 19 pass, each with its expected differences."""
    specs = fx.suite(spark)
    manifest = spark.createDataFrame([(n,) for n in specs], "table_name string")
    result = cs.run(spark, manifest, specs, workers=8)
    totals = result.runs.first()
    assert (totals.n_tables, totals.n_failed) == (93, 74)
    assert result.tables.filter("status = 'PASS'").count() == 19
    assert result.tables.filter("error IS NOT NULL").count() == 0

    found = {}
    for row in result.metrics.filter("diff").collect():
        found.setdefault(row.table_name, {}).setdefault(row.pt, {})[(row.column, row.metric)] = (
            float(row.left_value), float(row.right_value)
        )
    for i in range(1, 31):
        unchanged = i % 5 == 0
        flat = {} if unchanged else {None: close(fx.FLAT_FAMILY_DIFFS[i % 3])}
        keyed = {} if unchanged else {p: close(d) for p, d in fx.KEYED_FAMILY_DIFFS[i % 3].items()}
        other = {} if unchanged else {None: close(fx.other_family_diffs(i))}
        assert found.get(f"w.d.flat_{i:03d}", {}) == flat
        assert found.get(f"w.d.keyed_{i:03d}", {}) == keyed
        assert found.get(f"w.d.other_{i:03d}", {}) == other
