"""A run that is taken up again: finished lines are kept, others compared, one row a line."""

import pytest

import countersign as cs
import fixtures as fx
from test_run import names, slow


def broken(spark):
    """A table whose comparison fails, so that a line that passes was not compared again."""
    left, right = fx.flat(spark)
    return left, right.drop(right.columns[0])


def result_rows(result):
    return [(r.line_no, r.table_name, r.status, r.n_diffs) for r in result.tables.orderBy("line_no").collect()]


def test_only_unfinished_lines_are_compared_again(spark, tmp_path):
    left, right = fx.keyed(spark)
    specs = {
        "keyed": cs.TableSpec("keyed", left, right, "pt"),
        "same": cs.TableSpec("same", right, right, "pt"),
        "late": cs.TableSpec("late", *broken(spark)),
    }
    listed = ["keyed", "late", "same", "unknown", "same"]
    out = str(tmp_path / "out")
    first = cs.run(spark, names(spark, listed), specs, out=out, run_id="nightly.1")
    before = result_rows(first)
    assert [row[2] for row in before] == ["FAIL", "ERROR", "PASS", "ERROR", "PASS"]
    started = {r.line_no: r.started for r in first.tables.collect()}

    again = {name: cs.TableSpec(name, *broken(spark)) for name in ("keyed", "same")}
    again |= {name: cs.TableSpec(name, *fx.flat(spark)) for name in ("late", "unknown")}
    second = cs.run(spark, names(spark, listed), again, out=out, run_id="nightly.1")
    rows = result_rows(second)
    assert [row[2] for row in rows] == ["FAIL", "FAIL", "PASS", "FAIL", "PASS"]
    assert (rows[0], rows[2], rows[4]) == (before[0], before[2], before[4])
    kept = {r.line_no: r.started for r in second.tables.collect()}
    assert [kept[n] == started[n] for n in (1, 2, 3, 4, 5)] == [True, False, True, False, True]
    # Result tables hold one row a line, although two attempts wrote them.
    assert spark.read.parquet(f"{out}/tables").count() == 5
    assert spark.read.parquet(f"{out}/runs").count() == 1
    assert second.metrics.filter("line_no = 1").count() == 20
    assert second.runs.first().n_failed == 3

    third = cs.run(spark, names(spark, listed), {}, out=out, run_id="nightly.1")
    assert result_rows(third) == rows


def test_an_interrupted_run_goes_on(spark, tmp_path):
    import _thread
    import threading
    import time

    quick = cs.TableSpec("quick", *fx.flat(spark))
    specs = {"quick": quick, "slow": cs.TableSpec("slow", slow(spark, 60), slow(spark, 60))}
    out = str(tmp_path / "out")
    marks = tmp_path / "out" / "marks" / "run_id=r" / "line=1" / "_SUCCESS"

    def interrupt():
        for _ in range(600):
            if marks.exists():
                break
            time.sleep(0.1)
        _thread.interrupt_main()

    threading.Thread(target=interrupt).start()
    with pytest.raises(KeyboardInterrupt):
        cs.run(spark, names(spark, ["quick", "slow"]), specs, workers=2, out=out, run_id="r")
    specs = {"quick": cs.TableSpec("quick", *broken(spark)), "slow": cs.TableSpec("slow", *fx.flat(spark))}
    rows = result_rows(cs.run(spark, names(spark, ["quick", "slow"]), specs, out=out, run_id="r"))
    assert rows == [(1, "quick", "FAIL", 6), (2, "slow", "FAIL", 6)]


def test_what_cannot_be_resumed(spark, tmp_path):
    specs = {"flat": cs.TableSpec("flat", *fx.flat(spark))}
    out = str(tmp_path / "out")
    cs.run(spark, names(spark, ["flat"]), specs, out=out, run_id="r")
    with pytest.raises(ValueError, match="the manifest differs"):
        cs.run(spark, names(spark, ["other"]), specs, out=out, run_id="r")
    with pytest.raises(ValueError, match="the manifest differs"):
        cs.run(spark, names(spark, ["flat"]).limit(0), specs, out=out, run_id="r")
    with pytest.raises(ValueError, match="was started with"):
        cs.run(spark, names(spark, ["flat"]), specs, out=out, run_id="r", start="20250101")
    for wrong in ({"run_id": "r"}, {"run_id": "a/b", "out": out}, {"run_id": "", "out": out}):
        with pytest.raises(ValueError, match="needs out"):
            cs.run(spark, names(spark, ["flat"]), specs, **wrong)
    assert cs.run(spark, names(spark, ["flat"]), specs, out=out, run_id="other").tables.count() == 1
