"""One query per operator group, over whole test tables."""

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import countersign as cs
from checks.pairs import (
    DOCUMENTS, DOCUMENTS_BY_PT, EVENTS, EVENTS_HOURLY, EVENTS_NULL_KEY, LINEITEM, MIXED, ORDERS,
    ORDERS_BY_PT, ORDERS_CHANGED, SUITE, TABLES, Pair, day,
)
from countersign.functions.metrics import metric_alias
from countersign.functions.names import quoted
from countersign.plans.report import metric_lines
from countersign.plans.report import report_lines as all_lines
from countersign.sources.storage import drop_table, update_rows, update_table, work_folder, write_table
from countersign.sources.tables import open_side


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sides(spark: SparkSession, sf_dir: str, pair: Pair) -> tuple[DataFrame, DataFrame]:
    both = pair.left + pair.right
    used = {name: table(spark, sf_dir, name) for name in TABLES if "{" + name + "}" in both}
    return spark.sql(pair.left, **used), spark.sql(pair.right, **used)


def compared(spark: SparkSession, sf_dir: str, pair: Pair, **options) -> DataFrame:
    left, right = sides(spark, sf_dir, pair)
    return cs.compare(
        left, right, table_name=pair.table_name, partition_column=pair.key, **options
    )


def all_compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(DataFrame.unionByName, (compared(spark, sf_dir, pair) for pair in SUITE))


def decimals_as_doubles(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def comparison(pair: Pair, **options) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: compared(spark, sf_dir, pair, **options)


def numeric_columns(spark, sf_dir):
    """Every table's profile in long form, from one scan each."""
    def long(name: str, df: DataFrame) -> DataFrame:
        values = [F.struct(F.lit("*"), F.lit("-"), F.lit("count"), F.col("total_count").cast("double"))]
        for column, label in cs.numeric_columns(df):
            for metric in ("sum", "max", "min"):
                value = F.col(quoted(metric_alias(column, metric))).cast("double")
                values.append(F.struct(F.lit(column), F.lit(label), F.lit(metric), value))
        row = F.explode(F.array(*values).cast("array<struct<column:string,type:string,metric:string,value:double>>"))
        return cs.profile(df).select(F.lit(name).alias("table_name"), row.alias("row")).select("table_name", "row.*")

    return reduce(DataFrame.unionByName, (long(name, table(spark, sf_dir, name)) for name in TABLES))


def exact_sums(spark, sf_dir):
    """Monthly sums of 64-bit keys, far beyond 64 bits."""
    keys = table(spark, sf_dir, "lineitem").selectExpr(
        f"{day('l_shipdate')} AS pt", "(l_orderkey % 100000) * 70368744177664 AS big"
    )
    return cs.profile(keys, by="pt").select("pt", "total_count", F.col("big_sum").cast("string").alias("big_sum"), "big_max")


def double_sums(spark, sf_dir):
    """Monthly sums of doubles, of tiny ones too, that are the doubles nearest to the exact sums."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        f"{day('l_shipdate')} AS pt", "l_extendedprice AS price", "l_discount", "l_tax * pow(2D, -50) AS tiny",
    )
    return cs.profile(lines, by="pt").select("pt", "total_count", "price_sum", "l_discount_sum", "tiny_sum", "tiny_max")


def compare_reshuffled(spark, sf_dir):
    """A table and the same rows in another layout: doubles agree without any tolerance."""
    key = F.expr(day("l_shipdate"))
    left = table(spark, sf_dir, "lineitem").withColumn("pt", key)
    right = table(spark, sf_dir, "lineitem").repartition(7, "l_suppkey").withColumn("pt", key)
    metrics = cs.compare(left, right, table_name="lineitem", partition_column="pt")
    return metrics.select("pt", "column", "metric", "match", "diff")


def profile_global(spark, sf_dir):
    return decimals_as_doubles(cs.profile(sides(spark, sf_dir, ORDERS)[0]))


def profile_empty(spark, sf_dir):
    return decimals_as_doubles(
        cs.profile(sides(spark, sf_dir, ORDERS)[0].filter("o_totalprice < 0"))
    )


def profile_by_pt(spark, sf_dir):
    chosen = cs.partition_range(sides(spark, sf_dir, LINEITEM)[0], "pt", "199603", "199912")
    return decimals_as_doubles(cs.profile(chosen, by="pt", ordered=True))


def count_global(spark, sf_dir):
    return cs.row_counts(sides(spark, sf_dir, DOCUMENTS)[0])


def count_by_pt(spark, sf_dir):
    return cs.row_counts(sides(spark, sf_dir, DOCUMENTS)[0], by="pt")


def partition_keys(spark, sf_dir):
    return cs.partition_keys(*sides(spark, sf_dir, EVENTS))


def partition_bounds(spark, sf_dir):
    return cs.partition_bounds(*sides(spark, sf_dir, EVENTS), end="20240120")


def compare_rel_tol(spark, sf_dir):
    left = table(spark, sf_dir, "lineitem")
    # The right copy is laid out differently, so its double sums add up in another order.
    right = (
        table(spark, sf_dir, "lineitem").repartition("l_suppkey")
        .withColumn("l_discount", F.expr("l_discount + CASE WHEN l_linenumber = 7 THEN 0.01D ELSE 0D END"))
    )
    metrics = cs.compare(left, right, table_name="lineitem", rel_tol=1e-9)
    return metrics.select("column", "metric", "match")


def diffs_only(spark, sf_dir):
    return cs.differences(compared(spark, sf_dir, LINEITEM))


def missing_partitions(spark, sf_dir):
    status = cs.partition_status(compared(spark, sf_dir, EVENTS))
    return status.filter("presence <> 'BOTH'").select("pt", "presence")


def partition_status(spark, sf_dir):
    return cs.partition_status(compared(spark, sf_dir, LINEITEM))


def table_status(spark, sf_dir):
    return cs.table_status(all_compared(spark, sf_dir))


def failing_tables(spark, sf_dir):
    failing = cs.failing_tables(cs.table_status(all_compared(spark, sf_dir)))
    return failing.select("table_name", "status", "number")


def reasons(spark, sf_dir):
    return cs.partition_reasons(all_compared(spark, sf_dir)).drop("partitioned")


def run_summary(spark, sf_dir):
    return cs.run_totals(cs.table_status(all_compared(spark, sf_dir)))


def sql_text(counts_only: bool = False, *options: str) -> Callable[[SparkSession, str], DataFrame]:
    """The text of a check on lineitem, run as it stands."""
    def result(spark: SparkSession, sf_dir: str) -> DataFrame:
        view = f"lineitem_{uuid.uuid4().hex}"
        left = sides(spark, sf_dir, LINEITEM)[0]
        left.createOrReplaceTempView(view)
        columns = [] if counts_only else [name for name, _ in cs.numeric_columns(left)]
        result = spark.sql(cs.check_sql(view, columns, *options))
        spark.catalog.dropTempView(view)
        return decimals_as_doubles(result)

    return result


#: About so many parts has a file of the manifest.
PARTS_A_FILE = 100_000


def manifest(spark, sf_dir):
    """Table names made of part names, in several files, with padding and blank and header lines between."""
    name = "concat('  shop.', p_type, '.', replace(p_name, ' ', '_'), ' ')"
    lines = f"array('table_name', '', {name}, 'table_name,comment')"
    path = work_folder(spark, "manifest")
    parts = table(spark, sf_dir, "part")
    files = 4 + parts.count() // PARTS_A_FILE
    parts = parts.repartitionByRange(files, "p_partkey").sortWithinPartitions("p_partkey")
    parts.selectExpr(f"explode({lines}) AS value").write.text(path)
    return cs.read_manifest(spark, path)


def metadata_join(spark, sf_dir):
    """Catalog tables written from the test tables, looked up and joined to a manifest."""
    folder, tag = work_folder(spark, "tables"), uuid.uuid4().hex
    names = {n: f"{n}_{tag}" for n in ("events_by_day", "orders_whole", "not_there")}
    days = table(spark, sf_dir, "events").withColumn("pt", F.expr(day("ts")))
    write_table(days, names["events_by_day"], "pt", f"{folder}/events_by_day")
    write_table(table(spark, sf_dir, "orders"), names["orders_whole"], None, f"{folder}/orders_whole")
    listed = spark.createDataFrame(
        [(i, full) for i, full in enumerate(names.values())], "line_no bigint, table_name string"
    )
    metadata = cs.prefetch_metadata(spark, names.values())
    joined = cs.attach_metadata(listed, metadata)
    for name in names.values():
        drop_table(spark, name)  # their files stay
    def one(entry) -> DataFrame:
        """A manifest line's metadata, and the rows at the location that was found."""
        found = entry.location != ""
        rows = open_side(spark, cs.Stored(entry.location)) if found else spark.range(0)
        return cs.row_counts(rows).select(
            F.lit(entry.table_name.removesuffix(f"_{tag}")).alias("name"),
            F.lit(cs.is_partitioned(entry.partition_cols)).alias("partitioned"),
            F.lit(found).alias("resolved"), F.lit(entry.error is not None).alias("has_error"),
            F.col("total_count").alias("n_rows"),
        )

    return reduce(DataFrame.unionByName, map(one, joined.collect()))  # one row a manifest line


def scan_roundtrip(spark, sf_dir):
    """Both copies written partitioned, one opened by path, one by catalog name, then compared."""
    folder, name = work_folder(spark, "roundtrip"), f"orders_{uuid.uuid4().hex}"
    left = sides(spark, sf_dir, ORDERS_BY_PT)[0]
    drop_table(spark, name)
    changed = update_rows(left, {"o_totalprice": ORDERS_CHANGED}, "o_totalprice > 499000")
    write_table(changed, name, "pt", f"{folder}/right")
    left.write.partitionBy("pt").parquet(f"{folder}/left")
    spec = cs.TableSpec("orders_by_pt", cs.Stored(f"{folder}/left"), name, "pt")
    return cs.compare(
        open_side(spark, spec.left), open_side(spark, spec.right),
        table_name=spec.table_name, partition_column="pt",
    )


def update_stored(spark, sf_dir):
    """A stored table after an update of some of its partitions, by partition."""
    folder, name = work_folder(spark, "updated"), f"orders_{uuid.uuid4().hex}"
    write_table(sides(spark, sf_dir, ORDERS_BY_PT)[0], name, "pt", f"{folder}/orders")
    update_table(
        spark, name, {"o_totalprice": "o_totalprice + 1", "o_orderpriority": "'CHANGED'"},
        "o_totalprice > 490000 AND o_orderstatus <> 'P'", "pt",
    )
    drop_table(spark, name)  # its files stay
    return open_side(spark, cs.Stored(f"{folder}/orders")).groupBy("pt").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").cast("double").alias("price"),
        F.count_if(F.col("o_orderpriority") == "CHANGED").alias("changed"),
    )


def stored_keys(spark, sf_dir):
    """Keys of two stored tables from the catalog, without a look at their rows."""
    folder, names = work_folder(spark, "keys"), []
    for side in sides(spark, sf_dir, EVENTS_NULL_KEY):
        names.append(f"events_{uuid.uuid4().hex}")
        write_table(side, names[-1], "pt", f"{folder}/{names[-1]}")
    keys = cs.stored_partition_keys(spark, *names)
    keys.write.parquet(f"{folder}/found")
    for name in names:
        drop_table(spark, name)
    return spark.read.parquet(f"{folder}/found")


def specs_of(spark, sf_dir, pairs) -> dict[str, cs.TableSpec]:
    return {
        pair.table_name: cs.TableSpec(pair.table_name, *sides(spark, sf_dir, pair), pair.key)
        for pair in pairs
    }


def multi_table_run(spark, sf_dir):
    specs = specs_of(spark, sf_dir, SUITE)
    left, right = sides(spark, sf_dir, ORDERS)
    specs["broken"] = cs.TableSpec("broken", left, right.drop("o_totalprice"))
    listed = spark.createDataFrame([(n,) for n in [*specs, "unknown"]], "table_name string")
    result = cs.run(spark, listed, specs, workers=8)
    return result.tables.select(
        "table_name", "status", "match", "partitions_compared", "n_diffs",
        F.col("error").isNotNull().alias("has_error"),
    )


def resumed_run(spark, sf_dir):
    """A run of which some lines ended as errors, taken up again: the others are not compared a second time, which
    would now fail."""
    specs = specs_of(spark, sf_dir, SUITE)
    left, right = sides(spark, sf_dir, ORDERS)
    broken = {name: cs.TableSpec(name, left, right.drop("o_totalprice")) for name in specs}
    late = {pair.table_name for pair in SUITE[::2]}
    out = work_folder(spark, "resumed")
    listed = spark.createDataFrame(list(enumerate(specs)), "line_no bigint, table_name string")
    cs.run(spark, listed, {**specs, **{name: broken[name] for name in late}}, workers=8, out=out, run_id="once")
    result = cs.run(spark, listed, {**broken, **{name: specs[name] for name in late}}, workers=8, out=out, run_id="once")
    return result.tables.select("line_no", "table_name", "status", "partitions_compared", "n_diffs")


def footer_counts(spark, sf_dir):
    """Rows of both stored copies of a count-only table by directory key, which only their files' footers tell."""
    folder = work_folder(spark, "counted")
    copies = dict(zip(("left", "right"), sides(spark, sf_dir, DOCUMENTS_BY_PT)))
    for (name, copy), format in zip(copies.items(), ("parquet", "orc")):
        copy.write.format(format).partitionBy("pt").save(f"{folder}/{name}")
    opened = [
        cs.open_for_counts(spark, cs.Stored(f"{folder}/{name}", format))
        for name, format in zip(copies, ("parquet", "orc"))
    ]
    return cs.compare(*opened, table_name=DOCUMENTS_BY_PT.table_name, partition_column="pt")


def report_file(spark, sf_dir):
    """The written report of a run over a range, read back, with times masked; texts of SQL and blank lines are left out."""
    specs = specs_of(spark, sf_dir, [EVENTS])
    listed = spark.createDataFrame([(n,) for n in specs], "table_name string")
    path = work_folder(spark, "report")
    cs.write_report(cs.run(spark, listed, specs, workers=4, start="20240104", end="20240111"), path)
    masked = F.regexp_replace("value", r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$|\d+\.\ds$", "TIME")
    lines = spark.read.text(path).filter(r"value RLIKE '^(#|- |\\| |> |\\*\\*|Tables |Differences)'")
    return lines.select(masked.alias("line"))


def report_lines(spark, sf_dir):
    specs = specs_of(spark, sf_dir, [EVENTS])
    listed = spark.createDataFrame([(n,) for n in specs], "table_name string")
    result = cs.run(spark, listed, specs)
    return metric_lines(result.metrics, result.tables, ("Left", "Right")).select("pt", "line")


def lookup_run(spark, sf_dir):
    """Left copies found by their location, right ones by name, compared and summed up."""
    folder, tag = work_folder(spark, "copies"), uuid.uuid4().hex
    pairs = (ORDERS_BY_PT, ORDERS)
    names = [f"{pair.table_name}_{tag}" for pair in pairs]
    for pair, name in zip(pairs, names):
        for side, df in zip(("old", "new"), sides(spark, sf_dir, pair)):
            write_table(df, f"{name}_{side}", pair.key, f"{folder}/{name}_{side}")
    for name in names:  # the right copies carry the manifest's names
        columns = "pt" if name == names[0] else None
        write_table(spark.table(f"{name}_new"), name, columns, f"{folder}/{name}")
    path = f"{folder}/manifest"
    spark.createDataFrame([(n,) for n in ["table_name", *names]], "value string").coalesce(1).write.text(path)
    result = cs.run(
        spark, cs.read_manifest(spark, path), lookup=lambda s, n: cs.table_metadata(s, f"{n}_old"), workers=2,
        out=f"{folder}/results",
    )
    for name in [f"{n}{side}" for n in names for side in ("", "_old", "_new")]:
        drop_table(spark, name)  # their files stay
    return result.tables.select(
        F.regexp_replace("table_name", f"_{tag}$", "").alias("table_name"), "partitioned", "status",
        "partitions_compared", "n_diffs",
    )


def report_sections(spark, sf_dir):
    """Summary, headings, counts and verdicts of a report over the suite and two tables that end as errors,
    and the same of a run over a range without partitions.

    Lines that carry a time, the texts of SQL and of Spark's errors, and metric rows are left out.
    """
    def lines_of(result, *starts: str) -> DataFrame:
        lines = all_lines(result)
        chosen = reduce(lambda a, b: a | b, [F.startswith("line", F.lit(start)) for start in starts])
        counts = F.col("line").rlike(r"^\| \w+ \| \d+ (\| \d+ \| [YN] )?\|$")
        return lines.filter(chosen | counts).select("section", "line")

    specs = specs_of(spark, sf_dir, [*SUITE, DOCUMENTS_BY_PT])
    left, right = sides(spark, sf_dir, ORDERS)
    specs["broken"] = cs.TableSpec("broken", left, right.drop("o_totalprice"))
    listed = spark.createDataFrame([(n,) for n in [*specs, "unknown"]], "table_name string")
    whole = lines_of(
        cs.run(spark, listed, specs, workers=8), "Tables with", "## Table", "- Partition", "### ", "#### ", "**Concl", "> **", "| 1 ",
        "| 2 ", "| 3 ", "| 4 ", "| 5 ", "| 6 ", "| 7 ",
    )
    whole = whole.withColumn("line", F.regexp_replace("line", r"ERROR: \[.*", "ERROR |"))
    nothing = cs.run(spark, listed.filter("table_name = 'events'"), specs, start="20300101", end="20300102")
    return whole.unionByName(lines_of(nothing, "All tables", "- Partition filter", "### "))


def listed_in_order(spark, sf_dir):
    """Metrics of the events pair with their place in the ordered listing, which has a few rows a partition."""
    return cs.places_in_order(compared(spark, sf_dir, EVENTS)).select("pt", "metric", "column", "place")


def partition_counts(spark, sf_dir):
    days = table(spark, sf_dir, "events").withColumn("pt", F.expr(day("ts")))
    return cs.row_counts(days, by="pt")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "numeric_columns": numeric_columns,
        "profile_global": profile_global,
        "profile_empty": profile_empty,
        "profile_by_pt": profile_by_pt,
        "count_global": count_global,
        "count_by_pt": count_by_pt,
        "partition_keys": partition_keys,
        "stored_keys": stored_keys,
        "partition_bounds": partition_bounds,
        "compare_global": comparison(ORDERS),
        "compare_by_pt": comparison(LINEITEM),
        "compare_range": comparison(EVENTS, start="20240104", end="20240111"),
        "compare_hourly_range": comparison(EVENTS_HOURLY, start="20240104", end="20240111"),
        "compare_mixed_types": comparison(MIXED),
        "compare_rel_tol": compare_rel_tol,
        "diffs_only": diffs_only,
        "missing_partitions": missing_partitions,
        "null_partition": comparison(EVENTS_NULL_KEY),
        "compare_count_only": comparison(DOCUMENTS),
        "compare_count_only_by_pt": comparison(DOCUMENTS_BY_PT),
        "partition_status": partition_status,
        "table_status": table_status,
        "failing_tables": failing_tables,
        "reasons": reasons,
        "exact_sums": exact_sums,
        "double_sums": double_sums,
        "compare_reshuffled": compare_reshuffled,
        "lookup_run": lookup_run,
        "run_summary": run_summary,
        "sql_text_roundtrip": sql_text(False, "pt", "199603", "199912"),
        "sql_text_all_keys": sql_text(False, "pt"),
        "sql_text_whole": sql_text(),
        "sql_text_counts": sql_text(True, "pt"),
        "sql_text_count": sql_text(True),
        "manifest": manifest,
        "metadata_join": metadata_join,
        "scan_roundtrip": scan_roundtrip,
        "update_stored": update_stored,
        "multi_table_run": multi_table_run,
        "resumed_run": resumed_run,
        "footer_counts": footer_counts,
        "report_file": report_file,
        "report_lines": report_lines,
        "report_sections": report_sections,
        "listed_in_order": listed_in_order,
        "partition_counts": partition_counts,
    }
