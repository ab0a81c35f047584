"""Runs over many tables: isolation, limits, results, report."""

import time

from pyspark.sql import functions as F

import countersign as cs
import fixtures as fx
from countersign.plans.report import in_report_order
from countersign.sources.storage import drop_table, write_table


def names(spark, listed):
    return spark.createDataFrame(list(enumerate(listed)), "line_no bigint, table_name string")


def slow(spark, seconds):
    """A table whose scan sleeps."""
    def wait(batches):
        for batch in batches:
            time.sleep(seconds)
            yield batch

    return spark.range(2, numPartitions=2).mapInPandas(wait, "id bigint")


def test_errors_stay_with_their_table(spark, tmp_path):
    left, right = fx.keyed(spark)
    overflow = spark.createDataFrame([(2**63 - 1,), (1,)], "a bigint")
    specs = {
        "w.d.good": cs.TableSpec("w.d.good", left, right, "pt"),
        "w.d.same": cs.TableSpec("w.d.same", right, right, "pt"),
        "w.d.lacks": cs.TableSpec("w.d.lacks", left, right.drop("score"), "pt"),
        "w.d.overflow": cs.TableSpec("w.d.overflow", overflow, overflow),
        "w.d.nowhere": cs.TableSpec("w.d.nowhere", "no.such.table", right),
        "w.d.nopath": cs.TableSpec("w.d.nopath", cs.Stored(str(tmp_path / "none")), right),
        "w.d.none": cs.TableSpec("w.d.none", left.limit(0), right.limit(0), "pt"),
    }
    listed = [*specs, "w.d.unknown", "w.d.same"]
    out = str(tmp_path / "out")
    result = cs.run(spark, names(spark, listed), specs, workers=3, out=out)
    rows = result.tables.orderBy("line_no").collect()
    assert [r.table_name for r in rows] == listed
    assert [r.status for r in rows] == [
        "FAIL", "PASS", "ERROR", "PASS", "ERROR", "ERROR", "PASS", "ERROR", "PASS"]
    assert rows[0].n_diffs == 9 and rows[0].partitions_compared == 2
    assert rows[6].branch == "no_partitions" and rows[6].partitions_compared == 0
    assert rows[7].error == "no location known for w.d.unknown"
    sums = result.metrics.filter("table_name = 'w.d.overflow' AND metric = 'sum'").first()
    assert (sums.left_value, sums.right_value) == (str(2**63), str(2**63))
    totals = result.runs.first()
    assert (totals.n_tables, totals.n_failed) == (9, 5) and totals.elapsed_s > 0

    # The result tables stay, and a second run adds to them.
    cs.run(spark, names(spark, ["w.d.same"]), specs, out=out)
    assert spark.read.parquet(f"{out}/tables").count() == 10
    assert spark.read.parquet(f"{out}/runs").select("run_id").distinct().count() == 2
    assert spark.read.parquet(f"{out}/metrics").filter("table_name = 'w.d.same'").count() == 3 * 20


def test_range_applies_to_partitioned_tables(spark):
    left, right = fx.keyed(spark)
    specs = {"a": cs.TableSpec("a", left, right, "pt"), "b": cs.TableSpec("b", *fx.flat(spark))}
    result = cs.run(spark, names(spark, specs), specs, start="20250102", end="20250102")
    assert [r.pt for r in result.partitions.filter("table_name = 'a'").collect()] == ["20250102"]
    assert result.tables.filter("table_name = 'b'").first().n_diffs == 6
    assert (result.runs.first().pt_start, result.runs.first().pt_end) == ("20250102", "20250102")


def test_time_limit_stops_the_jobs_of_that_table_only(spark):
    specs = {
        "slow": cs.TableSpec("slow", slow(spark, 60), slow(spark, 60)),
        "quick": cs.TableSpec("quick", *fx.flat(spark)),
    }
    began = time.time()
    result = cs.run(spark, names(spark, ["slow", "quick", "quick"]), specs, workers=2, timeout_s=8)
    assert time.time() - began < 45
    rows = result.tables.orderBy("line_no").collect()
    assert [r.status for r in rows] == ["ERROR", "FAIL", "FAIL"]
    assert rows[0].error == "timed out after 8 s" and rows[0].elapsed_s >= 8
    assert spark.range(5).count() == 5  # nothing lingers on this session


def test_several_late_tables_are_stopped_each_and_others_finish(spark):
    """Tags must not leak between workers: every slow table ends at its own limit."""
    specs = {f"slow{i}": cs.TableSpec(f"slow{i}", slow(spark, 40), slow(spark, 40)) for i in range(2)}
    specs |= {f"quick{i}": cs.TableSpec(f"quick{i}", *fx.flat(spark)) for i in range(6)}
    listed = ["slow0", "quick0", "quick1", "quick2", "slow1", "quick3", "quick4", "quick5"]
    result = cs.run(spark, names(spark, listed), specs, workers=3, timeout_s=8)
    rows = {r.table_name: r for r in result.tables.collect()}
    assert {n for n, r in rows.items() if r.status == "ERROR"} == {"slow0", "slow1"}
    assert all(8 <= rows[n].elapsed_s < 20 for n in ("slow0", "slow1"))
    assert all(rows[n].n_diffs == 6 for n in rows if n.startswith("quick"))


def test_an_interrupted_run_leaves_no_jobs_behind(spark):
    import _thread
    import threading

    import pytest

    specs = {f"slow{i}": cs.TableSpec(f"slow{i}", slow(spark, 60), slow(spark, 60)) for i in range(3)}
    manifest = names(spark, specs)
    began = time.time()
    timer = threading.Timer(5, _thread.interrupt_main)
    timer.start()
    with pytest.raises(KeyboardInterrupt):
        cs.run(spark, manifest, specs, workers=2)
    assert time.time() - began < 30
    deadline = time.time() + 10
    while spark.sparkContext.statusTracker().getActiveJobsIds() and time.time() < deadline:
        time.sleep(0.2)
    assert spark.sparkContext.statusTracker().getActiveJobsIds() == []


def test_empty_manifest(spark):
    result = cs.run(spark, names(spark, ["x"]).limit(0), {})
    assert result.tables.count() == 0 and tuple(result.runs.first())[:2] == (0, 0)


def test_copies_looked_up(spark, tmp_path):
    """Left copy by location, right copy by name; only pt makes it a partitioned comparison."""
    left, right = fx.keyed(spark)
    for name, key in (("run_keyed", "pt"), ("run_by_name", "name")):
        drop_table(spark, name)
        write_table(right, name, key)
        left.write.mode("overwrite").partitionBy(key).parquet(str(tmp_path / name))

    def lookup(session, name):
        if name == "run_gone":
            raise RuntimeError("404")
        return str(tmp_path / name), ["pt" if name == "run_keyed" else "name"]

    manifest = names(spark, ["run_keyed", "run_by_name", "run_gone"])
    rows = cs.run(spark, manifest, lookup=lookup).tables.orderBy("line_no").collect()
    assert [(r.branch, r.status, r.n_diffs) for r in rows] == [
        ("numeric_by_partition", "FAIL", 9), ("numeric_global", "FAIL", rows[1].n_diffs), ("error", "ERROR", 0)]
    assert rows[1].n_diffs > 0
    assert rows[2].error == "metadata lookup failed: 404"
    for name in ("run_keyed", "run_by_name"):
        drop_table(spark, name)


def text_of(result):
    return [r.line for r in in_report_order(cs.report_lines(result)).collect()]


def test_report(spark, tmp_path):
    left, right = fx.keyed(spark)
    flat_left, flat_right = fx.flat(spark)
    counted_left, counted_right = fx.texts(spark, 5)
    specs = {
        "w.keyed": cs.TableSpec("w.keyed", left, right, "pt"),
        "w.flat": cs.TableSpec("w.flat", flat_left, flat_right),
        "w.counted": cs.TableSpec("w.counted", counted_left, counted_right, "pt"),
        "w.whole": cs.TableSpec("w.whole", counted_left.drop("pt"), counted_right.drop("pt")),
        "w.none": cs.TableSpec("w.none", left.limit(0), right.limit(0), "pt"),
    }
    result = cs.run(spark, names(spark, [*specs, "w.unknown"]), specs, workers=3)
    lines = text_of(result)
    text = "\n".join(lines)
    assert lines[0] == "# Table Comparison Report"
    assert "Tables with differences: **5** / 6" in lines
    summary = [line for line in lines if line.startswith(("| 1 ", "| 2 ", "| 3 ", "| 4 ", "| 5 "))]
    assert [s.split(" | ")[1] for s in summary] == [
        "w.counted", "w.flat", "w.keyed", "w.keyed", "w.unknown", "w.whole"]  # a row per failing partition
    assert summary[0].endswith("| FAIL | pt=20250102: `*`.count: Left=3 vs Right=2 |")
    assert summary[4].endswith("| FAIL | ERROR: no location known for w.unknown |")

    def section(name):
        begin = lines.index(f"## Table: `{name}`")
        rest = lines[begin:]
        return rest[: rest.index("---")]

    keyed = section("w.keyed")
    assert keyed[1:3] == ["- Partitioned: Yes (pt)", "- Partition range: from 20250101 through 20250102"]
    at = keyed.index("#### Partition pt=20250101 — **FAIL**")
    assert keyed[at:at + 19] == [
        "#### Partition pt=20250101 — **FAIL**", "",
        "| Column | Type | Metric | Left | Right | Match |",
        "|--------|------|--------|-------|---------|-------|",
        "| * | - | count | 3 | 3 | Y |",
        "| id | int | sum | 6 | 6 | Y |", "| id | int | max | 3 | 3 | Y |", "| id | int | min | 1 | 1 | Y |",
        "| amount | double | sum | 1349.0 | 450.0 | N |", "| amount | double | max | 999.0 | 200.0 | N |",
        "| amount | double | min | 150.0 | 100.0 | N |", "| score | int | sum | 255 | 255 | Y |",
        "| score | int | max | 90 | 90 | Y |", "| score | int | min | 80 | 80 | Y |",
        "", "Differences:", "- `amount`.sum: Left=1349.0, Right=450.0",
        "- `amount`.max: Left=999.0, Right=200.0", "- `amount`.min: Left=150.0, Right=100.0",
    ]
    flat = section("w.flat")
    assert "### w.flat — Aggregate Check: **FAIL**" in flat and "- Partitioned: No" in flat
    at = flat.index("**Conclusion: FAIL**")
    assert flat[at + 1:at + 4] == ["", "Differences:", "- `*`.count: Left=6, Right=5"]
    counted = section("w.counted")
    at = counted.index("| pt | Left Count | Right Count | Match |")
    assert counted[at + 2:at + 6] == ["| 20250101 | 3 | 3 | Y |", "| 20250102 | 3 | 2 | N |", "", "> **FAIL**"]
    whole = section("w.whole")
    assert whole[whole.index("| Side | Count |") + 2:][:2] == ["| Left | 6 |", "| Right | 5 |"]
    assert "### w.none — No partitions found" in section("w.none")
    assert "### ERROR for `w.unknown`" in section("w.unknown")
    assert "## Execution Summary" in lines and "- Total tables: 6" in lines

    path = str(tmp_path / "report")
    cs.write_report(result, path)
    import glob

    written = "".join(open(f).read() for f in sorted(glob.glob(f"{path}/part-*")))
    assert written == text + "\n"


def test_report_when_all_pass(spark):
    specs = {"w.equal": cs.TableSpec("w.equal", *fx.equal(spark), "pt")}
    result = cs.run(spark, names(spark, specs), specs, start="20250101", end="20250102")
    lines = text_of(result)
    assert "All tables PASS - no differences found." in lines
    assert "- Partition filter: from 20250101 through 20250102" in lines
    assert "- Partition range: from 20250101 through 20250102" in lines
    assert "| # | Table | Status | Difference Reason |" not in lines
    assert "**Conclusion: PASS**" in lines


def test_reasons_take_a_line_each(spark):
    from countersign.plans.report import summary_lines

    left, right = fx.keyed(spark)
    result = cs.run(spark, names(spark, ["t"]), {"t": cs.TableSpec("t", left, right, "pt")})
    lines = [r.line for r in in_report_order(summary_lines(result.tables, result.reasons)).collect()]
    assert [line[:40] for line in lines if line.startswith("| 1 ")] == [
        "| 1 | t | FAIL | pt=20250101: `amount`.s", "| 1 | t | FAIL | pt=20250102: `*`.count:"[:40]]


def test_job(tmp_path):
    """The command line in a session of its own: a table is never compared with itself, results and report are written."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    repo = Path(__file__).resolve().parents[1]
    (tmp_path / "tables.csv").write_text("table_name\ndefault.jobs_orders\ndefault.jobs_gone\n")
    # Tables are made in the same process, since the default catalog lives in memory.
    script = f"""
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.warehouse.dir", "{tmp_path}/warehouse").getOrCreate())
spark.createDataFrame([(1, 2.5, "20250101"), (2, 3.5, "20250102")], "id int, price double, pt string"
    ).write.partitionBy("pt").saveAsTable("jobs_orders")
from countersign.__main__ import main
sys.argv = ["countersign", "--manifest", "{tmp_path}/tables.csv", "--output", "{tmp_path}/out",
            "--left-catalog", "spark_catalog", "--workers", "2", "--pt-start", "20250101", "--pt-end", "20250101"]
main()
"""
    done = subprocess.run(
        [sys.executable, "-c", script], capture_output=True, text=True, timeout=180, cwd=tmp_path,
        env={**os.environ, "PYTHONPATH": str(repo)})
    assert done.returncode == 0, done.stderr[-2000:]
    report = "".join(f.read_text() for f in sorted((tmp_path / "out" / "report").glob("part-*")))
    assert "Tables with differences: **2** / 2" in report
    assert "- Partition filter: from 20250101 through 20250101" in report
    # Asked of the right copies' own catalog, a location is that of the right copy itself.
    assert "both copies of default.jobs_orders are the same folder" in report
    assert "### ERROR for `default.jobs_gone`" in report
    assert "default.jobs_orders" in done.stdout
