"""The findings of a run as readable text, projected from its result tables."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countersign.functions.text import difference_text, shown, status_label, yes_no
from countersign.operators.rollup import LABELS, failing_tables, run_totals
from countersign.plans.run import RunResult

# Where a line stands: section, table, block of the table, partition, part of the block, line.
POSITION = ("section", "line_no", "block", "pt", "part", "ord")

HEADER, SUMMARY, TABLES, EXECUTION = range(4)
PREAMBLE, HEADING, BODY, CONCLUSION, CLOSING = range(5)
TOP, ROWS, DIFFERENCES = range(3)

# The wording of the report. {} stands for a value.
TITLE = "# Table Comparison Report"
GENERATED = "- Generated: {}"
N_TABLES = "- Tables: {}"
N_WORKERS = "- Workers: {}"
FILTERED = "- Partition filter: from {} through {}"
PREFETCH = "- Metadata pre-fetch: {}s"
SUMMARY_TITLE = "## Difference Summary"
SUMMARY_COUNT = "Tables with differences: **{}** / {}"
SUMMARY_HEAD = "| # | Table | Status | Difference Reason |"
SUMMARY_RULE = "|---|-------|--------|-------------------|"
SUMMARY_ROW = "| {} | {} | FAIL | {} |"
ALL_PASS = "All tables PASS - no differences found."
SEPARATOR = "---"
TABLE_TITLE = "## Table: `{}`"
PARTITIONED_BY = "- Partitioned: Yes ({})"
NOT_PARTITIONED = "- Partitioned: No"
TABLE_RANGE = "- Partition range: from {} through {}"
STARTED = "- Started: {}"
WHOLE_TITLE = "### {} — Aggregate Check: **{}**"
BY_PARTITION_TITLE = "### {} — Partitioned Aggregate Check: **{}**"
COUNT_TITLE = "### {} — Count Only (no numeric columns)"
EMPTY_TITLE = "### {} — No partitions found"
ERROR_TITLE = "### ERROR for `{}`"
PARTITION_TITLE = "#### Partition pt={} — **{}**"
SQL_TITLE = "**SQL:**"
RESULTS_TITLE = "**Results:**"
METRIC_HEAD = "| Column | Type | Metric | {} | {} | Match |"
METRIC_RULE = "|--------|------|--------|-------|---------|-------|"
METRIC_ROW = "| {} | {} | {} | {} | {} | {} |"
COUNT_HEAD = "| pt | {} Count | {} Count | Match |"
COUNT_RULE = "|----|-------------|---------------|-------|"
COUNT_ROW = "| {} | {} | {} | {} |"
SIDE_HEAD = "| Side | Count |"
SIDE_RULE = "|------|-------|"
SIDE_ROW = "| {} | {} |"
CONCLUDED = "**Conclusion: {}**"
COUNT_CONCLUDED = "> **{}**"
DIFFERENCES_TITLE = "Differences:"
DIFFERENCE_ITEM = "- {}"
COMPLETED = "> Completed in {}s"
FAILED = "> Failed after {}s"
EXECUTION_TITLE = "## Execution Summary"
EXECUTION_TABLES = "- Total tables: {}"
EXECUTION_TIME = "- Comparison time: {}s"

STAMP = "yyyy-MM-dd HH:mm:ss"


def _text(template: str, *values: Column | str) -> Column:
    """The template filled in; NULL where a value is NULL."""
    fixed = [F.lit(part) for part in template.split("{}")]
    parts = [fixed[0]]
    for value, after in zip(values, fixed[1:], strict=True):
        parts += [(F.lit(value) if isinstance(value, str) else value).cast("string"), after]
    return F.concat(*parts)


def _seconds(column: str) -> Column:
    return F.format_string("%.1f", column)


def _placed(df: DataFrame, section, line_no, block, pt, part, order, line) -> DataFrame:
    values = (section, line_no, block, pt, part, order, line)
    names = (*POSITION, "line")
    types = ("int", "bigint", "int", "string", "int", "int", "string")
    return df.select(
        *[
            (v if isinstance(v, Column) else F.lit(v)).cast(t).alias(n)
            for v, n, t in zip(values, names, types)
        ]
    )


def _paragraph(df: DataFrame, section, line_no, block, pt, part, lines: list[Column]) -> DataFrame:
    """Several lines per row; lines that are NULL are left out."""
    listed = F.array_compact(F.array(*lines))
    exploded = df.select("*", F.posexplode(listed).alias("at", "text"))
    return _placed(exploded, section, line_no, block, pt, part, F.col("at"), F.col("text"))


def _metric_head(labels: tuple[str, str]) -> list[Column]:
    return [_text(METRIC_HEAD, *labels), F.lit(METRIC_RULE)]


def _if(condition: Column, lines: list[Column | str]) -> list[Column]:
    return [F.when(condition, F.lit(line) if isinstance(line, str) else line) for line in lines]


def header_lines(runs: DataFrame) -> DataFrame:
    given = F.col("pt_start").isNotNull() | F.col("pt_end").isNotNull()
    bounds = _text(
        FILTERED, F.coalesce("pt_start", F.lit("first")), F.coalesce("pt_end", F.lit("last"))
    )
    return _paragraph(runs, HEADER, 0, 0, None, 0, [
        F.lit(TITLE), F.lit(""),
        _text(GENERATED, F.date_format("started", STAMP)),
        _text(N_TABLES, F.col("n_tables")), _text(N_WORKERS, F.col("workers")),
        F.when(given, bounds), _text(PREFETCH, _seconds("prefetch_s")), F.lit(""),
    ])


def summary_lines(tables: DataFrame, reasons: DataFrame) -> DataFrame:
    """Failing tables with their reasons, a row per failing partition, and their errors."""
    some = F.col("n_failed") > 0
    total = _text(SUMMARY_COUNT, F.col("n_failed"), F.col("n_tables"))
    top = _paragraph(
        run_totals(tables), SUMMARY, 0, 0, None, TOP,
        [F.lit(SUMMARY_TITLE), F.lit("")]
        + _if(some, [total, "", SUMMARY_HEAD, SUMMARY_RULE])
        + _if(~some, [ALL_PASS]),
    )
    failing = failing_tables(tables, ("table_name", "line_no"))
    rows = failing.join(reasons.select("line_no", "pt", "reason"), "line_no", "left")
    error = F.concat(F.lit("ERROR: "), F.col("error"))
    reason = F.translate(F.coalesce(error, F.col("reason")), "\r\n", "  ")
    # Rows are placed by their number, which takes the place of the manifest line here.
    return top.unionByName(_placed(
        rows, SUMMARY, F.col("number"), 0, F.col("pt"), ROWS, 0,
        _text(SUMMARY_ROW, F.col("number"), F.col("table_name"), F.coalesce(reason, F.lit("Unknown"))),
    ))


def table_lines(tables: DataFrame, labels: tuple[str, str]) -> DataFrame:
    """What surrounds the values of each table: preamble, heading, SQL, conclusion, time."""
    name, branch = F.col("table_name"), F.col("branch")
    verdict, failed = status_label(F.col("match")), branch == "error"
    by_partition, whole = branch == "numeric_by_partition", branch == "numeric_global"
    counts, counts_by_partition = branch == "count_only_global", branch == "count_only_by_partition"
    numeric, counted = by_partition | whole, counts | counts_by_partition

    def part(block: int, lines: list[Column]) -> DataFrame:
        return _paragraph(tables, TABLES, F.col("line_no"), block, None, TOP, lines)

    preamble = part(PREAMBLE, [
        F.lit(""), F.lit(SEPARATOR), _text(TABLE_TITLE, name),
        F.coalesce(_text(PARTITIONED_BY, F.col("partition_column")), F.lit(NOT_PARTITIONED)),
        _text(TABLE_RANGE, F.col("pt_start"), F.col("pt_end")),
        _text(STARTED, F.date_format("started", STAMP)), F.lit(""),
    ])
    title = (
        F.when(whole, _text(WHOLE_TITLE, name, verdict))
        .when(by_partition, _text(BY_PARTITION_TITLE, name, verdict))
        .when(counted, _text(COUNT_TITLE, name))
        .when(failed, _text(ERROR_TITLE, name))
        .otherwise(_text(EMPTY_TITLE, name))
    )
    heading = part(
        HEADING,
        [title, F.lit("")]
        + _if(numeric | counted, [SQL_TITLE, "```sql", F.col("sql"), "```", ""])
        + _if(whole, [RESULTS_TITLE, "", *_metric_head(labels)])
        + _if(counts_by_partition, [_text(COUNT_HEAD, *labels), COUNT_RULE])
        + _if(counts, [SIDE_HEAD, SIDE_RULE])
        + _if(failed, ["```", F.col("error"), "```"]),
    )
    conclusion = part(
        CONCLUSION,
        _if(numeric, ["", _text(CONCLUDED, verdict)])
        + _if(counted, ["", _text(COUNT_CONCLUDED, verdict)])
        + _if(whole & ~F.col("match"), ["", DIFFERENCES_TITLE]),
    )
    ending = F.when(failed, _text(FAILED, _seconds("elapsed_s"))).otherwise(
        _text(COMPLETED, _seconds("elapsed_s"))
    )
    closing = part(CLOSING, [F.lit(""), ending])
    return preamble.unionByName(heading).unionByName(conclusion).unionByName(closing)


def partition_lines(
    partitions: DataFrame, tables: DataFrame, labels: tuple[str, str]
) -> DataFrame:
    """Partition headings of numeric tables, and the counts of the others."""
    rows = partitions.join(tables.select("line_no", "branch"), "line_no")
    line_no, pt = F.col("line_no"), F.col("pt")
    left, right = F.col("left_count"), F.col("right_count")
    numeric = rows.filter("branch = 'numeric_by_partition'")
    heading = _paragraph(numeric, TABLES, line_no, BODY, pt, TOP, [
        F.lit(""), _text(PARTITION_TITLE, shown(pt), F.col("status")), F.lit(""),
        *_metric_head(labels),
    ])
    listed = _paragraph(
        numeric.filter("n_diffs > 0"), TABLES, line_no, BODY, pt, DIFFERENCES,
        [F.lit(""), F.lit(DIFFERENCES_TITLE)],
    ).withColumn("ord", F.col("ord") - 2)  # ahead of the list, which starts at 0
    counts = _placed(
        rows.filter("branch = 'count_only_by_partition'"), TABLES, line_no, BODY, pt, ROWS, 0,
        _text(COUNT_ROW, shown(pt), left, right, yes_no(F.col("match"))),
    )
    sides = _paragraph(
        rows.filter("branch = 'count_only_global'"), TABLES, line_no, BODY, pt, ROWS,
        [_text(SIDE_ROW, labels[0], left), _text(SIDE_ROW, labels[1], right)],
    )
    return heading.unionByName(listed).unionByName(counts).unionByName(sides)


def metric_lines(metrics: DataFrame, tables: DataFrame, labels: tuple[str, str]) -> DataFrame:
    """One table row per metric, and one list item per difference."""
    numeric = metrics.join(
        tables.filter("branch LIKE 'numeric%'").select("line_no"), "line_no"
    )
    row = _text(
        METRIC_ROW, F.col("column"), F.col("type"), F.col("metric"), shown(F.col("left_value")),
        shown(F.col("right_value")), yes_no(F.col("match")),
    )
    item = _text(DIFFERENCE_ITEM, difference_text(", ", labels))
    line_no, pt, order = F.col("line_no"), F.col("pt"), F.col("ord")
    # Differences of a whole table are listed after its conclusion, those of a partition below it.
    block = F.when(F.col("partitioned"), BODY).otherwise(CONCLUSION)
    rows = _placed(
        numeric.filter("metric <> 'partition'"), TABLES, line_no, BODY, pt, ROWS, order, row
    )
    items = _placed(numeric.filter("diff"), TABLES, line_no, block, pt, DIFFERENCES, order, item)
    return rows.unionByName(items)


def execution_lines(runs: DataFrame) -> DataFrame:
    return _paragraph(runs, EXECUTION, 0, 0, None, 0, [
        F.lit(""), F.lit(SEPARATOR), F.lit(EXECUTION_TITLE), F.lit(""),
        _text(EXECUTION_TABLES, F.col("n_tables")), _text(EXECUTION_TIME, _seconds("elapsed_s")),
    ])


def report_lines(result: RunResult, labels: tuple[str, str] = LABELS) -> DataFrame:
    """Every line of the report with its position."""
    parts = [
        header_lines(result.runs),
        summary_lines(result.tables, result.reasons),
        table_lines(result.tables, labels),
        partition_lines(result.partitions, result.tables, labels),
        metric_lines(result.metrics, result.tables, labels),
        execution_lines(result.runs),
    ]
    return reduce(DataFrame.unionByName, parts)


def in_report_order(lines: DataFrame) -> DataFrame:
    order = [F.col(c).asc_nulls_first() if c == "pt" else F.col(c) for c in POSITION]
    return lines.orderBy(*order)


def write_report(result: RunResult, path: str, labels: tuple[str, str] = LABELS) -> None:
    """Write the report as text files whose names sort in reading order."""
    lines = in_report_order(report_lines(result, labels))
    lines.select("line").write.mode("overwrite").text(path)
