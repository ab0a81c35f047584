"""The queries' expected results as SQL for DuckDB, written apart from the engine."""

from checks.pairs import (
    DOCUMENTS, DOCUMENTS_BY_PT, EVENTS, EVENTS_HOURLY, EVENTS_NULL_KEY, LINEITEM, LINEITEM_COLUMNS, MIXED, ORDERS,
    ORDERS_BY_PT, SUITE, TABLES, Pair, day,
)


def source(sql: str) -> str:
    for table in TABLES:
        sql = sql.replace("{" + table + "}", table)
    return sql


def left(pair: Pair) -> str:
    return source(pair.left)


def right(pair: Pair) -> str:
    return source(pair.right)


def sum_of(column: str, label: str) -> str:
    return f"CAST(sum({column}) AS BIGINT)" if label in ("int", "bigint") else f"sum({column})"


def side(sql: str, columns, pair: Pair, where: str) -> str:
    key = "CAST(pt AS VARCHAR)" if pair.key else "CAST(NULL AS VARCHAR)"
    aggregates = "".join(
        f", {sum_of(c, t)} AS {c}_sum, max({c}) AS {c}_max, min({c}) AS {c}_min"
        for c, t in columns
    )
    group = "GROUP BY pt" if pair.key else ""
    return f"SELECT {key} AS pt, count(*) AS n{aggregates} FROM ({sql}) AS t WHERE {where} {group}"


def metrics(pair: Pair, where: str = "true") -> str:
    """All metrics of a pair in the engine's long form."""
    on = "l.pt IS NOT DISTINCT FROM r.pt"
    joined = f"""
        SELECT CASE WHEN l.n IS NULL THEN r.pt ELSE l.pt END AS pt,
               l.n AS l_n, r.n AS r_n
               {"".join(f", l.{c}_{m} AS l_{c}_{m}, r.{c}_{m} AS r_{c}_{m}"
                        for c, _ in pair.columns for m in ("sum", "max", "min"))}
        FROM l FULL JOIN r ON {on}"""
    both = "l_n IS NOT NULL AND r_n IS NOT NULL"
    listed_only = both if pair.key and pair.columns else "true"

    def row(order, column, label, metric, l, r, match, diff):
        return (
            f"SELECT '{pair.table_name}' AS table_name, {'true' if pair.key else 'false'} AS partitioned, "
            f"pt, {order} AS ord, '{column}' AS \"column\", '{label}' AS type, '{metric}' AS metric, "
            f"{l} AS left_value, {r} AS right_value, {match} AS match, {diff} AS diff FROM j"
        )

    count_match = "coalesce(l_n, 0) = coalesce(r_n, 0)"
    rows = [
        row(1, "*", "-", "count", "CAST(coalesce(l_n, 0) AS VARCHAR)",
            "CAST(coalesce(r_n, 0) AS VARCHAR)", count_match, f"NOT ({count_match}) AND {listed_only}")
    ]
    if pair.key and pair.columns:
        rows.append(
            row(0, "*", "-", "partition",
                "CASE WHEN l_n IS NULL THEN 'MISSING' ELSE 'EXISTS' END",
                "CASE WHEN r_n IS NULL THEN 'MISSING' ELSE 'EXISTS' END", "false", "true")
            + f" WHERE NOT ({both})"
        )
    order = 2
    for column, label in pair.columns:
        for metric in ("sum", "max", "min"):
            l, r = f"l_{column}_{metric}", f"r_{column}_{metric}"
            match = f"{l} IS NOT DISTINCT FROM {r}"
            rows.append(
                row(order, column, label, metric, f"CAST({l} AS VARCHAR)", f"CAST({r} AS VARCHAR)",
                    match, f"NOT ({match}) AND {listed_only}")
            )
            order += 1
    union = "\nUNION ALL ".join(rows)
    return (
        f"WITH l AS ({side(left(pair), pair.columns, pair, where)}), "
        f"r AS ({side(right(pair), pair.right_columns or pair.columns, pair, where)}), "
        f"j AS ({joined}) {union}"
    )


def all_metrics(pairs) -> str:
    return " UNION ALL ".join(f"SELECT * FROM ({metrics(pair)})" for pair in pairs)


PARTITIONS = """
    SELECT *, CASE WHEN match THEN 'PASS' ELSE 'FAIL' END AS status FROM (
      SELECT table_name, partitioned, pt,
             max(CASE WHEN metric = 'count' THEN CAST(left_value AS BIGINT) END) AS left_count,
             max(CASE WHEN metric = 'count' THEN CAST(right_value AS BIGINT) END) AS right_count,
             CASE WHEN partitioned AND max(CASE WHEN metric = 'count' THEN left_value END) = '0' THEN 'RIGHT_ONLY'
                  WHEN partitioned AND max(CASE WHEN metric = 'count' THEN right_value END) = '0' THEN 'LEFT_ONLY'
                  ELSE 'BOTH' END AS presence,
             count(*) FILTER (WHERE diff) AS n_diffs, NOT bool_or(diff) AS match
      FROM ({metrics}) AS m GROUP BY table_name, partitioned, pt) AS p"""

VERDICTS = """
    SELECT table_name, partitioned,
           count(*) FILTER (WHERE metric = 'count' AND partitioned) AS partitions_compared,
           min(pt) AS first_pt, max(pt) AS last_pt,
           count(*) FILTER (WHERE diff) AS n_diffs, NOT bool_or(diff) AS match,
           CASE WHEN bool_or(diff) THEN 'FAIL' ELSE 'PASS' END AS status
    FROM ({metrics}) AS m GROUP BY table_name, partitioned"""

DIFFERENCE = (
    "'`' || \"column\" || '`.' || metric || ': Left=' || coalesce(left_value, 'None') || "
    "'{separator}Right=' || coalesce(right_value, 'None')"
)

REASONS = """
    SELECT table_name, pt, count(*) AS n_diffs,
           string_agg(CASE WHEN partitioned THEN 'pt=' || coalesce(pt, 'None') || ': ' ELSE '' END
                      || {difference}, '; ' ORDER BY ord) AS reason
    FROM ({metrics}) AS m WHERE diff GROUP BY table_name, pt"""


def reasons(sql: str) -> str:
    return REASONS.format(metrics=sql, difference=DIFFERENCE.format(separator=" vs "))


def wide(sql: str, columns, key: str | None = None, where: str = "true") -> str:
    """A profile with the engine's column names; decimals as double on both sides."""
    parts = [f"{key} AS pt"] if key else []
    parts.append("count(*) AS total_count")
    for column, label in columns:
        for metric in ("sum", "max", "min"):
            value = sum_of(column, label) if metric == "sum" else f"{metric}({column})"
            if label.startswith("decimal") or metric == "sum":
                value = f"CAST({value} AS DOUBLE)"
            parts.append(f"{value} AS {column}_{metric}")
    group = f"GROUP BY {key}" if key else ""
    return f"SELECT {', '.join(parts)} FROM ({sql}) AS t WHERE {where} {group}"


def exact_sum(value: str, bits: int = 70) -> str:
    """The double nearest to the exact sum of doubles that are multiples of 2^-bits. As text the sum is rounded once."""
    return f"CAST(CAST(sum(CAST({value} * pow(2, {bits}) AS HUGEINT)) AS VARCHAR) AS DOUBLE) / pow(2, {bits})"


def long_profile(table: str, columns: list[tuple[str, str]]) -> str:
    """Count, sum, maximum and minimum of every numeric column."""
    row = "SELECT '{0}' AS table_name, '{1}' AS \"column\", '{2}' AS type, '{3}' AS metric, CAST({4} AS DOUBLE) AS value FROM {0}"
    rows = [row.format(table, "*", "-", "count", "count(*)")]
    for column, label in columns:
        for metric in ("sum", "max", "min"):
            exact = metric == "sum" and label == "double"
            rows.append(row.format(table, column, label, metric, exact_sum(column) if exact else f"{metric}({column})"))
    return " UNION ALL ".join(rows)


NUMERIC_COLUMNS = {
    "region": [("r_regionkey", "int")],
    "nation": [("n_nationkey", "int"), ("n_regionkey", "int")],
    "customer": [("c_custkey", "bigint"), ("c_nationkey", "int"), ("c_acctbal", "double")],
    "supplier": [("s_suppkey", "bigint"), ("s_nationkey", "int"), ("s_acctbal", "double")],
    "part": [("p_partkey", "bigint"), ("p_size", "int"), ("p_retailprice", "double")],
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_totalprice", "double")],
    "lineitem": [
        ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
        ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
        ("l_discount", "double"), ("l_tax", "double"),
    ],
    "events": [("event_id", "bigint"), ("user_id", "bigint"), ("value", "double")],
    "documents": [("doc_id", "bigint"), ("n_chars", "bigint")],
    "embeddings": [("vec_id", "bigint"), ("label", "int")],
    "pages": [("page_id", "bigint")],
    "benchmark": [("item_id", "bigint")],
    "labels": [("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")],
    "conversations": [("conv_id", "bigint"), ("turn", "bigint")],
}


def tolerant() -> str:
    """Sums of native doubles within 1e-9, one column changed by far more than that."""
    pairs = {column: column for column, _ in NUMERIC_COLUMNS["lineitem"]}
    pairs["l_discount"] = "l_discount + CASE WHEN l_linenumber = 7 THEN 0.01 ELSE 0 END"
    row = "SELECT '{0}' AS \"column\", '{1}' AS metric, {2} AS match FROM lineitem"
    rows = ["SELECT '*' AS \"column\", 'count' AS metric, count(*) = count(*) AS match FROM lineitem"]
    for column, changed in pairs.items():
        rows.append(row.format(
            column, "sum",
            f"abs(sum({column}) - sum({changed})) <= 1e-9 * greatest(abs(sum({column})), abs(sum({changed})))"))
        for metric in ("max", "min"):
            rows.append(row.format(column, metric, f"{metric}({column}) = {metric}({changed})"))
    return " UNION ALL ".join(rows)


def run_statuses() -> str:
    """Verdicts of a run over the suite, a table that lacks a column and one that is unknown."""
    verdicts = VERDICTS.format(metrics=all_metrics(SUITE))
    return f"""
        SELECT table_name, status, match, partitions_compared, n_diffs, false AS has_error
        FROM ({verdicts}) AS v
        UNION ALL SELECT 'broken', 'ERROR', false, 0, 0, count(*) > 0 FROM orders
        UNION ALL SELECT 'unknown', 'ERROR', false, 0, 0, count(*) > 0 FROM orders"""


def resumed_statuses() -> str:
    """Verdicts of the suite: those of a run that was taken up again are those of one run."""
    numbers = " ".join(f"WHEN '{pair.table_name}' THEN {n}" for n, pair in enumerate(SUITE, 1))
    return f"""
        SELECT CAST(CASE table_name {numbers} END AS BIGINT) AS line_no, table_name, status, partitions_compared, n_diffs
        FROM ({VERDICTS.format(metrics=all_metrics(SUITE))}) AS v"""


def report_file() -> str:
    """Every line of the report on a range of the events pair, apart from SQL and blank lines, with times masked."""
    found = metrics(EVENTS, "pt >= '20240104' AND pt <= '20240111'")
    item = DIFFERENCE.format(separator=", ")
    once = [
        "# Table Comparison Report", "- Generated: TIME", "- Tables: 1", "- Workers: 4",
        "- Partition filter: from 20240104 through 20240111", "- Metadata pre-fetch: TIME", "## Difference Summary",
        "## Table: `events`", "- Partitioned: Yes (pt)", "- Partition range: from 20240104 through 20240111",
        "- Started: TIME", "**SQL:**", "> Completed in TIME", "## Execution Summary", "- Total tables: 1",
        "- Comparison time: TIME",
    ]
    rows = [f"SELECT '{line}' FROM t" for line in once] + [
        "SELECT 'Tables with differences: **1** / 1' FROM t WHERE NOT match",
        "SELECT '| # | Table | Status | Difference Reason |' FROM t WHERE NOT match",
        "SELECT '| 1 | events | FAIL | ' || reason || ' |' FROM r",
        "SELECT 'All tables PASS - no differences found.' FROM t WHERE match",
        "SELECT '### events — Partitioned Aggregate Check: **' || status || '**' FROM t",
        "SELECT '**Conclusion: ' || status || '**' FROM t",
        "SELECT '#### Partition pt=' || pt || ' — **' || status || '**' FROM p",
        "SELECT '| Column | Type | Metric | Left | Right | Match |' FROM p",
        "SELECT 'Differences:' FROM p WHERE NOT match",
        """SELECT '| ' || "column" || ' | ' || type || ' | ' || metric || ' | ' || coalesce(left_value, 'None') || ' | '
             || coalesce(right_value, 'None') || ' | ' || CASE WHEN match THEN 'Y' ELSE 'N' END || ' |'
           FROM m WHERE metric <> 'partition'""",
        f"SELECT '- ' || {item} FROM m WHERE diff",
    ]
    return f"""
        WITH m AS ({found}), p AS ({PARTITIONS.format(metrics="SELECT * FROM m")}), r AS ({reasons("SELECT * FROM m")}),
        t AS ({VERDICTS.format(metrics="SELECT * FROM m")})
        SELECT line FROM ({" UNION ALL ".join(rows)}) AS lines(line)"""


def metric_report() -> str:
    """The table rows and difference items of the report on the events pair."""
    item = DIFFERENCE.format(separator=", ")
    return f"""
        SELECT pt, '| ' || "column" || ' | ' || type || ' | ' || metric || ' | '
               || coalesce(left_value, 'None') || ' | ' || coalesce(right_value, 'None') || ' | '
               || CASE WHEN match THEN 'Y' ELSE 'N' END || ' |' AS line
        FROM ({metrics(EVENTS)}) AS m WHERE metric <> 'partition'
        UNION ALL
        SELECT pt, '- ' || {item} AS line FROM ({metrics(EVENTS)}) AS m WHERE diff"""


def report_sections() -> str:
    """Lines of the report apart from metrics, times and the texts of SQL and errors."""
    pairs = (*SUITE, DOCUMENTS_BY_PT)
    suite = all_metrics(pairs)
    counted = "table_name IN ('documents', 'documents_by_pt')"
    rows = [
        "SELECT 2, '## Table: `' || table_name || '`' FROM t",
        "SELECT 2, '- Partitioned: ' || CASE WHEN partitioned THEN 'Yes (pt)' ELSE 'No' END FROM t",
        "SELECT 2, '- Partition range: from ' || first_pt || ' through ' || last_pt FROM t WHERE partitioned",
        f"""SELECT 2, CASE WHEN status = 'ERROR' THEN '### ERROR for `' || table_name || '`'
              WHEN {counted} THEN '### ' || table_name || ' — Count Only (no numeric columns)'
              WHEN partitioned THEN '### ' || table_name || ' — Partitioned Aggregate Check: **' || status || '**'
              ELSE '### ' || table_name || ' — Aggregate Check: **' || status || '**' END FROM t""",
        f"""SELECT 2, CASE WHEN {counted} THEN '> **' || status || '**'
              ELSE '**Conclusion: ' || status || '**' END FROM t WHERE status <> 'ERROR'""",
        f"""SELECT 2, '#### Partition pt=' || coalesce(pt, 'None') || ' — **' || status || '**'
            FROM p WHERE partitioned AND NOT {counted}""",
        f"""SELECT 2, '| ' || coalesce(pt, 'None') || ' | ' || left_count || ' | ' || right_count || ' | '
              || CASE WHEN match THEN 'Y' ELSE 'N' END || ' |' FROM p WHERE partitioned AND {counted}""",
        f"SELECT 2, '| Left | ' || left_count || ' |' FROM p WHERE NOT partitioned AND {counted}",
        f"SELECT 2, '| Right | ' || right_count || ' |' FROM p WHERE NOT partitioned AND {counted}",
        "SELECT 1, 'Tables with differences: **' || count(*) FILTER (WHERE NOT match) || '** / ' || count(*) FROM t",
        """SELECT 1, '| ' || f.number || ' | ' || f.table_name || ' | FAIL | ' || CASE f.table_name
              WHEN 'broken' THEN 'ERROR' WHEN 'unknown' THEN 'ERROR: no location known for unknown'
              ELSE r.reason END || ' |'
            FROM (SELECT *, row_number() OVER (ORDER BY table_name) AS number FROM t WHERE NOT match) AS f
            LEFT JOIN r ON f.table_name = r.table_name""",
        "SELECT 0, '- Partition filter: from 20300101 through 20300102' FROM orders HAVING count(*) > 0",
        "SELECT 1, 'All tables PASS - no differences found.' FROM orders HAVING count(*) > 0",
        "SELECT 2, '### events — No partitions found' FROM orders HAVING count(*) > 0",
    ]
    return f"""
        WITH m AS ({suite}), p AS ({PARTITIONS.format(metrics="SELECT * FROM m")}),
        r AS ({reasons("SELECT * FROM m")}),
        t AS (SELECT table_name, partitioned, first_pt, last_pt, match, status
              FROM ({VERDICTS.format(metrics="SELECT * FROM m")}) AS v
              UNION ALL SELECT 'broken', false, NULL, NULL, false, 'ERROR'
              UNION ALL SELECT 'unknown', false, NULL, NULL, false, 'ERROR')
        SELECT CAST(section AS INTEGER) AS section, line
        FROM ({" UNION ALL ".join(rows)}) AS lines(section, line)"""


def oracle_sql() -> dict[str, str]:
    suite = all_metrics(SUITE)
    verdicts = VERDICTS.format(metrics=suite)
    events_both = f"(SELECT pt FROM ({left(EVENTS)}) AS a UNION ALL SELECT pt FROM ({right(EVENTS)}) AS b)"
    return {
        "numeric_columns": " UNION ALL ".join(long_profile(t, c) for t, c in NUMERIC_COLUMNS.items()),
        "profile_global": wide(left(ORDERS), ORDERS.columns),
        "profile_empty": wide(left(ORDERS), ORDERS.columns, where="o_totalprice < 0"),
        "profile_by_pt": wide(
            left(LINEITEM), LINEITEM.columns, "pt", "pt >= '199603' AND pt <= '199912'"),
        "count_global": wide(left(DOCUMENTS), ()),
        "count_by_pt": wide(left(DOCUMENTS), (), "pt"),
        "partition_keys": f"SELECT DISTINCT pt FROM {events_both} AS k",
        "partition_bounds": f"SELECT min(pt) AS pt_start, '20240120' AS pt_end FROM {events_both} AS k",
        "compare_global": metrics(ORDERS),
        "compare_by_pt": metrics(LINEITEM),
        "compare_range": metrics(EVENTS, "pt >= '20240104' AND pt <= '20240111'"),
        "compare_hourly_range": metrics(
            EVENTS_HOURLY, "substr(pt, 1, 8) BETWEEN '20240104' AND '20240111'"),
        "compare_mixed_types": metrics(MIXED),
        "compare_rel_tol": tolerant(),
        "diffs_only": f"SELECT * FROM ({metrics(LINEITEM)}) AS m WHERE diff",
        "missing_partitions": f"""
            SELECT pt, 'LEFT_ONLY' AS presence FROM ({left(EVENTS)}) AS a
            WHERE pt NOT IN (SELECT pt FROM ({right(EVENTS)}) AS b) GROUP BY pt
            UNION ALL
            SELECT pt, 'RIGHT_ONLY' AS presence FROM ({right(EVENTS)}) AS b
            WHERE pt NOT IN (SELECT pt FROM ({left(EVENTS)}) AS a) GROUP BY pt""",
        "null_partition": metrics(EVENTS_NULL_KEY),
        "compare_count_only": metrics(DOCUMENTS),
        "compare_count_only_by_pt": metrics(DOCUMENTS_BY_PT),
        "partition_status": PARTITIONS.format(metrics=metrics(LINEITEM)),
        "table_status": verdicts,
        "failing_tables": f"""
            SELECT table_name, status, CAST(row_number() OVER (ORDER BY table_name) AS INTEGER) AS number
            FROM ({verdicts}) AS v WHERE NOT match""",
        "reasons": reasons(suite),
        "stored_keys": f"""
            SELECT DISTINCT pt FROM (SELECT pt FROM ({left(EVENTS_NULL_KEY)}) UNION ALL SELECT pt FROM ({right(EVENTS_NULL_KEY)}))""",
        "update_stored": f"""
            SELECT pt, count(*) AS n, CAST(sum(o_totalprice + CASE WHEN met THEN 1 ELSE 0 END) AS DOUBLE) AS price,
                   count(*) FILTER (WHERE met) AS changed
            FROM (SELECT *, o_totalprice > 490000 AND o_orderstatus <> 'P' AS met FROM ({left(ORDERS_BY_PT)})) GROUP BY pt""",
        "double_sums": f"""
            SELECT {day("l_shipdate")} AS pt, count(*) AS total_count, {exact_sum("l_extendedprice")} AS price_sum,
                   {exact_sum("l_discount")} AS l_discount_sum, {exact_sum("l_tax * pow(2, -50)", 115)} AS tiny_sum,
                   max(l_tax * pow(2, -50)) AS tiny_max
            FROM lineitem GROUP BY 1""",
        "compare_reshuffled": f"""
            SELECT pt, "column", metric, true AS match, false AS diff
            FROM (SELECT DISTINCT {day("l_shipdate")} AS pt FROM lineitem), (
              SELECT * FROM (VALUES {", ".join(f"('{c}')" for c, _ in LINEITEM_COLUMNS)}) AS c("column"),
                            (VALUES ('sum'), ('max'), ('min')) AS m(metric)
              UNION ALL SELECT '*', 'count')""",
        "exact_sums": f"""
            SELECT {day("l_shipdate")} AS pt, count(*) AS total_count,
                   CAST(sum(CAST((l_orderkey % 100000) * 70368744177664 AS HUGEINT)) AS VARCHAR) AS big_sum,
                   max((l_orderkey % 100000) * 70368744177664) AS big_max
            FROM lineitem GROUP BY 1""",
        "lookup_run": f"""
            SELECT table_name, partitioned, status, partitions_compared, n_diffs
            FROM ({VERDICTS.format(metrics=all_metrics((ORDERS_BY_PT, ORDERS)))}) AS v""",
        "run_summary": f"""
            SELECT count(*) AS n_tables, count(*) FILTER (WHERE NOT match) AS n_failed
            FROM ({verdicts}) AS v""",
        "sql_text_roundtrip": wide(
            left(LINEITEM), LINEITEM.columns, "pt", "pt >= '199603' AND pt <= '199912'"),
        "sql_text_all_keys": wide(left(LINEITEM), LINEITEM.columns, "pt"),
        "sql_text_whole": wide(left(LINEITEM), LINEITEM.columns),
        "sql_text_counts": wide(left(LINEITEM), (), "pt"),
        "sql_text_count": wide(left(LINEITEM), ()),
        "manifest": """
            SELECT 4 * row_number() OVER (ORDER BY p_partkey) - 1 AS line_no,
                   'shop.' || p_type || '.' || replace(p_name, ' ', '_') AS table_name FROM part""",
        "metadata_join": """
            SELECT 'events_by_day' AS name, true AS partitioned, true AS resolved, false AS has_error,
                   count(*) AS n_rows FROM events
            UNION ALL SELECT 'orders_whole', false, true, false, count(*) FROM orders
            UNION ALL SELECT 'not_there', false, false, true, 0 FROM region HAVING count(*) > 0""",
        "scan_roundtrip": metrics(ORDERS_BY_PT),
        "multi_table_run": run_statuses(),
        "resumed_run": resumed_statuses(),
        "footer_counts": metrics(DOCUMENTS_BY_PT),
        "report_file": report_file(),
        "report_lines": metric_report(),
        "report_sections": report_sections(),
        "listed_in_order": f"""
            SELECT pt, metric, "column", row_number() OVER (ORDER BY pt NULLS FIRST, ord) - 1 AS place
            FROM ({metrics(EVENTS)}) AS m""",
        "partition_counts": f"""
            SELECT {day("ts")} AS pt, count(*) AS total_count FROM events GROUP BY 1""",
    }
