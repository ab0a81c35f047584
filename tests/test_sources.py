"""Opening copies, manifests, metadata, writing."""

import pytest
from pyspark.sql import functions as F

import countersign as cs
import fixtures as fx
from countersign.sources.storage import (
    create_namespace, drop_table, insert_rows, update_rows, work_folder, write_table,
)
from countersign.sources.tables import open_side


def test_manifest(spark, tmp_path):
    file = tmp_path / "tables.csv"
    file.write_bytes(
        b"table_name\r\nw.d.b\r\n\n   \t\n  w.d.a \t\ntable_names_too\nw.d.b\n\"w.d.q\",x\nw.d.table_name\n")
    rows = cs.read_manifest(spark, str(file)).orderBy("line_no").collect()
    assert [r.table_name for r in rows] == ["w.d.b", "w.d.a", "w.d.b", '"w.d.q",x', "w.d.table_name"]
    assert len({r.line_no for r in rows}) == 5


def test_directory_keys_stay_text(spark, tmp_path):
    df = spark.createDataFrame([(1, "0101"), (2, "0102")], "v int, pt string")
    path = str(tmp_path / "t")
    df.write.partitionBy("pt").parquet(path)
    assert dict(spark.read.parquet(path).dtypes)["pt"] == "int"
    opened = open_side(spark, cs.Stored(path))
    assert dict(opened.dtypes)["pt"] == "string"
    assert sorted(r.pt for r in opened.collect()) == ["0101", "0102"]
    given = open_side(spark, cs.Stored(path, schema="v int, pt string"))
    assert sorted(r.pt for r in given.collect()) == ["0101", "0102"]


def test_directory_keys_keep_null_and_odd_characters(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, None), (2, "01"), (3, "2025-01-01 00:00:00")]
    spark.createDataFrame(rows, "v int, pt string").write.partitionBy("pt").parquet(path)
    opened = open_side(spark, cs.Stored(path))
    assert sorted((tuple(r) for r in opened.collect()), key=str) == rows
    numbers = str(tmp_path / "n")
    spark.createDataFrame([(1, None), (2, "01")], "v int, pt string").write.partitionBy("pt").parquet(numbers)
    opened = open_side(spark, cs.Stored(numbers))
    assert sorted((tuple(r) for r in opened.collect()), key=str) == [(1, None), (2, "01")]


def test_all_directory_keys_stay_text_with_and_without_inference(spark, tmp_path):
    """Also those the comparison does not group by: they would count as numbers."""
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "07", "eu", "2025-01-01")], "v int, dt string, `re gion` string, day string")
    df.write.partitionBy("dt", "re gion", "day").parquet(path)
    setting = "spark.sql.sources.partitionColumnTypeInference.enabled"
    for inference in ("true", "false"):
        spark.conf.set(setting, inference)
        try:
            opened = open_side(spark, cs.Stored(path))
            assert cs.numeric_columns(opened) == [("v", "int")]
            assert tuple(opened.select("v", "dt", "re gion", "day").first()) == (1, "07", "eu", "2025-01-01")
        finally:
            spark.conf.unset(setting)


def test_a_key_inside_the_files_keeps_its_type(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 20250101)], "v int, pt int").write.parquet(path)
    opened = open_side(spark, cs.Stored(path))
    assert [tuple(r) for r in opened.collect()] == [(1, 20250101)]


@pytest.mark.parametrize("format", ["parquet", "orc", "json"])
def test_copies_by_path_and_by_name(spark, tmp_path, format):
    create_namespace(spark, "sources_test")
    left, right = fx.keyed(spark)
    path, name = str(tmp_path / "left"), f"sources_test.keyed_{format}"
    left.write.format(format).partitionBy("pt").save(path)
    drop_table(spark, name)
    write_table(right.filter("id < 6"), name, "pt")
    insert_rows(right.filter("id = 6"), name)
    assert spark.table(name).count() == 6

    (meta,) = cs.prefetch_metadata(spark, [name]).collect()
    assert meta.partition_cols == ["pt"] and meta.location and meta.error is None
    spec = cs.TableSpec(name, cs.Stored(path, format), name, "pt")
    metrics = cs.compare(
        open_side(spark, spec.left), open_side(spark, spec.right),
        table_name=name, partition_column="pt")
    assert {pt: set(d) for pt, d in fx.diffs_of(metrics).items()} == {
        pt: set(d) for pt, d in fx.KEYED_DIFFS.items()}
    drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_location_of_a_table_with_a_column_of_that_name(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("here", 1, "a", "b")], "Location string, v int, pt string, dt string")
    df.write.mode("overwrite").partitionBy("pt", "dt").option("path", path).saveAsTable("located")
    location, partition_cols = cs.table_metadata(spark, "located")
    assert location.endswith(path) and partition_cols == ["pt", "dt"]
    drop_table(spark, "located")


def test_metadata_failures_stay_with_their_table(spark):
    def lookup(session, name):
        if name == "bad":
            raise RuntimeError("no such thing")
        return f"/data/{name}", ["pt", "dt"]

    metadata = cs.prefetch_metadata(spark, ["a", "bad", "a"], lookup)
    assert metadata.count() == 2
    manifest = spark.createDataFrame([(1, "a"), (2, "bad"), (3, "new"), (4, "a")], "line_no bigint, table_name string")
    rows = cs.attach_metadata(manifest, metadata).orderBy("line_no").collect()
    assert [(r.table_name, r.location, r.partition_cols, r.error) for r in rows] == [
        ("a", "/data/a", ["pt", "dt"], None), ("bad", "", [], "no such thing"), ("new", "", [], None),
        ("a", "/data/a", ["pt", "dt"], None)]


def test_update_sees_the_old_row_and_skips_null_conditions(spark):
    df = spark.createDataFrame([(1, 2), (None, 5), (3, 4)], "a int, `b.c` int")
    updated = update_rows(df, {"a": "`b.c`", "b.c": "a * 10"}, "a = 1")
    assert [tuple(r) for r in updated.collect()] == [(2, 10), (None, 5), (3, 4)]
    assert updated.dtypes == df.dtypes


def test_work_folder_lies_in_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first.startswith(shared) and first != second


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace

    def session(master, setting=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(
            sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: setting or default))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(session("yarn"), "run")
    assert work_folder(session("yarn", "hdfs://shared/"), "run").startswith("hdfs://shared/run-")


def test_check_sql_runs_and_agrees_with_the_profile(spark):
    left, _ = fx.keyed(spark)
    left.createOrReplaceTempView("keyed_left")
    names = [n for n, _ in cs.numeric_columns(left)]
    whole = cs.check_sql("keyed_left", names)
    assert spark.sql(whole).collect() == cs.profile(left).collect()
    ranged = cs.check_sql("keyed_left", names, "pt", "20250102", "20250102")
    assert "WHERE `pt` >= '20250102' AND `pt` < '20250103'\nGROUP BY `pt`\nORDER BY `pt`" in ranged
    expected = cs.profile(cs.partition_range(left, "pt", "20250102", "20250102"), by="pt", ordered=True)
    assert spark.sql(ranged).collect() == expected.collect()
    counts = cs.check_sql("keyed_left", [], "pt")
    assert spark.sql(counts).collect() == cs.row_counts(left, "pt").orderBy(F.col("pt")).collect()


def test_keys_are_those_below_the_path(spark, tmp_path):
    """No key from above the root, none lost where no file holds a row, leading zeros kept."""
    root = tmp_path / "env=5" / "t"
    rows = spark.createDataFrame([(1, 7, "0012"), (2, 8, "0013")], "id int, env int, pt string")
    rows.write.partitionBy("pt").parquet(str(root))
    opened = open_side(spark, cs.Stored(str(root)))
    assert dict(opened.dtypes) == {"id": "int", "env": "int", "pt": "string"}
    assert sorted(map(tuple, opened.collect())) == [(1, 7, "0012"), (2, 8, "0013")]
    for day in ("20250101", "20250102"):
        rows.limit(0).drop("pt").write.parquet(str(tmp_path / "empty" / f"pt={day}"))
    empty = open_side(spark, cs.Stored(str(tmp_path / "empty")))
    assert dict(empty.dtypes)["pt"] == "string" and empty.isEmpty()
    metrics = cs.compare(empty, rows, table_name="t", partition_column="pt")
    assert cs.partition_status(metrics).filter("presence = 'RIGHT_ONLY'").count() == 2


def test_partitioned_write_has_few_files(spark, tmp_path):
    rows = spark.range(20_000, numPartitions=16).selectExpr("id", "concat('k', id % 5) AS pt")
    write_table(rows, "few_files", "pt", str(tmp_path / "few"))
    drop_table(spark, "few_files")
    assert len(list((tmp_path / "few").glob("pt=*/*.parquet"))) == 5


def test_manifest_lines_do_not_meet_in_one_task(spark, tmp_path):
    """Files of several blocks: numbers follow the lines, and one row a block meets in one task."""
    (tmp_path / "list").mkdir()
    for name, rows in (("b.txt", 900), ("a.txt", 1), ("c.txt", 2000)):
        (tmp_path / "list" / name).write_text("".join(f"{name}.{i}\n" if i % 3 else "\n" for i in range(1, rows + 1)))
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        read = cs.read_manifest(spark, str(tmp_path / "list"))
        plan = read._jdf.queryExecution().executedPlan().toString()
        rows = {r.line_no: r.table_name for r in read.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    listed = ["a.txt.1"] + [f"b.txt.{i}" for i in range(1, 901)] + [f"c.txt.{i}" for i in range(1, 2001)]
    assert rows == {n: name for n, name in enumerate(listed, 1) if int(name.rpartition(".")[2]) % 3}
    assert plan.count("SinglePartition") == 1
    assert "table_name" not in plan[plan.index("SinglePartition"):].split("FileScan")[1].split("\n")[0]


def test_manifest_order_over_several_files(spark, tmp_path):
    (tmp_path / "list").mkdir()
    (tmp_path / "list" / "a.txt").write_text("a1\n")
    (tmp_path / "list" / "b.txt").write_text("\n".join(f"b{i}" for i in range(50)))
    read = cs.read_manifest(spark, str(tmp_path / "list")).orderBy("line_no").collect()
    assert [r.table_name for r in read] == ["a1", *[f"b{i}" for i in range(50)]]
