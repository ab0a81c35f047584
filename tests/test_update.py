"""Updates of stored tables."""

import uuid
from pathlib import Path

import pytest

import countersign as cs
from countersign.sources.storage import drop_table, update_table, write_table


def stored(spark, tmp_path, partitioned=True):
    name = f"t_{uuid.uuid4().hex}"
    df = spark.range(60).selectExpr("id", "id * 2 AS v", "if(id % 6 = 0, NULL, concat('p', id % 6)) AS pt")
    write_table(df, name, "pt" if partitioned else None, str(tmp_path / name))
    return name, tmp_path / name


def files(folder: Path) -> dict:
    return {str(p): (p.stat().st_mtime_ns, p.stat().st_size) for p in folder.rglob("*.parquet")}


def rows(spark, name):
    return sorted(tuple(r) for r in spark.table(name).selectExpr("id", "v", "coalesce(pt, '-')").collect())


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    name, folder = stored(spark, tmp_path)
    before, old = files(folder), rows(spark, name)
    update_table(spark, name, {"v": "v + id"}, "id IN (7, 13, 6) AND v < 1000", "pt")
    after = files(folder)
    assert rows(spark, name) == [(i, v + i if i in (7, 13, 6) else v, p) for i, v, p in old]
    same = {p for p in before if before[p] == after.get(p)}
    assert {Path(p).parent.name for p in same} == {"pt=p2", "pt=p3", "pt=p4", "pt=p5"}
    assert {Path(p).parent.name for p in after if p not in same} == {"pt=p1", "pt=__HIVE_DEFAULT_PARTITION__"}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    drop_table(spark, name)


def test_updates_that_meet_nothing_or_a_null(spark, tmp_path):
    name, folder = stored(spark, tmp_path)
    before = files(folder)
    update_table(spark, name, {"v": "0"}, "id > 1000", "pt")
    update_table(spark, name, {"v": "0"}, "pt = 'p9' OR v > NULL", "pt")
    assert files(folder) == before
    with pytest.raises(ValueError, match="does not move"):
        update_table(spark, name, {"PT": "'x'"}, "true", "pt")
    drop_table(spark, name)


def test_a_table_without_partitions(spark, tmp_path):
    name, _ = stored(spark, tmp_path, partitioned=False)
    old = rows(spark, name)
    update_table(spark, name, {"v": "-1", "id": "id + 100"}, "id = 59")
    assert rows(spark, name) == sorted((159, -1, p) if i == 59 else (i, v, p) for i, v, p in old)
    drop_table(spark, name)


def test_keys_from_the_catalog(spark, tmp_path):
    odd = ["a b", "x+y", "50%", "k=v", "q/r", "ü", "20240101", None]
    names = []
    for values in (odd[:5], odd[3:]):
        names.append(f"t_{uuid.uuid4().hex}")
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, pt string")
        write_table(df, names[-1], "pt", str(tmp_path / names[-1]))
    keys = cs.stored_partition_keys(spark, *names)
    assert sorted(keys.collect(), key=str) == sorted(cs.partition_keys(*map(spark.table, names)).collect(), key=str)
    assert {r.pt for r in keys.collect()} == set(odd)
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "BatchScan" not in plan
    for name in names:
        drop_table(spark, name)
