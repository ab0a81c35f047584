"""Places in an order against sorting by hand."""

import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

import countersign as cs

ROOT = Path(__file__).resolve().parents[1]


def test_places_follow_the_order_without_gaps(spark):
    df = spark.range(20_000, numPartitions=7).selectExpr("(id * 7919) % 4001 AS a", "id % 3 AS b", "id AS place_", "id AS tie")
    rows = cs.numbered(df, "a", F.col("b").desc()).collect()
    assert sorted(r.place for r in rows) == list(range(20_000))
    rows.sort(key=lambda r: r.place)
    assert [(r.a, -r.b) for r in rows] == sorted((r.a, -r.b) for r in rows)
    assert {r.place_ for r in rows} == set(range(20_000)) == {r.tie for r in rows}


def test_places_of_hot_null_and_no_rows(spark):
    hot = spark.range(9_000).selectExpr("if(id % 3 = 0, NULL, if(id % 3 = 1, 5, id)) AS k", "'x' AS `odd name`")
    rows = sorted(cs.numbered(hot, F.col("k").asc_nulls_first(), place="n").collect(), key=lambda r: r.n)
    assert [r.n for r in rows] == list(range(9_000))
    assert all(r.k is None for r in rows[:3_000]) and [r.k for r in rows[3_000:]] == sorted(r.k for r in rows[3_000:])
    assert cs.numbered(hot.limit(0), "k").count() == 0


def test_hot_rows_are_spread_over_ranges(spark):
    same = spark.range(0, 40_000, numPartitions=8).selectExpr("1 AS k")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cs.numbered(same, "k")
        folder = max(Path(spark.conf.get("spark.checkpoint.dir")).glob("numbered-*"), key=lambda p: p.stat().st_mtime)
        files = spark.read.parquet(str(folder)).groupBy(F.input_file_name()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(files) == 8 and max(f["count"] for f in files) < 10_000


def test_only_the_ranges_meet_in_one_task(spark):
    """The one exchange to a single task carries a row a range: sums of counts, no row of the table."""
    plan = cs.numbered(spark.range(100).selectExpr("id AS k", "uuid() AS filler"), "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1 and "BroadcastHashJoin" in plan
    below = plan[plan.index("SinglePartition"):]
    assert "HashAggregate" in below.split("FileScan")[0] and "filler" not in below.split("FileScan")[1].split("\n")[0]


def test_other_queries_live_without_an_optional_package():
    """One missing package of the optional operators leaves the rest registered."""
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') for n in q))"
    shown = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120).stdout.split()
    assert int(shown[-2]) >= 39 and shown[-1] == "False"
