"""Pairs of table copies, derived from the test tables by SQL that Spark and DuckDB both run.

The right copy differs from the left one by dropped rows and changed values. Doubles become
decimals, whose sums do not depend on the order of addition.
"""

from dataclasses import dataclass

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def month(ts: str) -> str:
    """``yyyyMM`` as text."""
    return f"CAST(year({ts}) * 100 + month({ts}) AS STRING)"


def day(ts: str) -> str:
    """``yyyyMMdd`` as text."""
    return f"CAST(year({ts}) * 10000 + month({ts}) * 100 + day({ts}) AS STRING)"


def hour(ts: str) -> str:
    """``yyyyMMddHH`` as text."""
    return f"CAST(year({ts}) * 1000000 + month({ts}) * 10000 + day({ts}) * 100 + hour({ts}) AS STRING)"


@dataclass(frozen=True)
class Pair:
    """SQL of both copies, in which tables are written ``{name}``."""

    table_name: str
    columns: tuple[tuple[str, str], ...]
    left: str
    right: str
    key: str | None = None
    right_columns: tuple[tuple[str, str], ...] | None = None  # where its types differ


def decimal(column: str) -> str:
    return f"CAST({column} AS DECIMAL(12,2)) AS {column}"


LINEITEM_COLUMNS = (
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
    ("l_linenumber", "int"), ("l_quantity", "decimal(12,2)"),
    ("l_extendedprice", "decimal(12,2)"), ("l_discount", "decimal(12,2)"),
    ("l_tax", "decimal(12,2)"),
)


def _lineitem(quantity: str, where: str = "") -> str:
    return f"""
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
               CAST({quantity} AS DECIMAL(12,2)) AS l_quantity,
               {decimal("l_extendedprice")}, {decimal("l_discount")}, {decimal("l_tax")},
               l_returnflag, l_linestatus, {month("l_shipdate")} AS pt
        FROM {{lineitem}} {where}"""


LINEITEM = Pair(
    "lineitem", LINEITEM_COLUMNS,
    left=_lineitem("l_quantity"),
    right=_lineitem(
        "CASE WHEN l_linenumber = 1 AND l_quantity = 1 AND l_tax = 0.08 "
        "THEN l_quantity + 1 ELSE l_quantity END",
        "WHERE NOT (l_linenumber = 7 AND l_quantity = 50 AND l_discount = 0.10)",
    ),
    key="pt",
)


def _orders(price: str) -> str:
    return f"""
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CAST({price} AS DECIMAL(12,2)) AS o_totalprice,
               o_orderpriority, {month("o_orderdate")} AS pt
        FROM {{orders}}"""


ORDERS_COLUMNS = (
    ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_totalprice", "decimal(12,2)"),
)
ORDERS_CHANGED = "CASE WHEN o_totalprice > 499000 THEN o_totalprice + 1 ELSE o_totalprice END"
ORDERS = Pair("orders", ORDERS_COLUMNS, _orders("o_totalprice"), _orders(ORDERS_CHANGED))
ORDERS_BY_PT = Pair(
    "orders_by_pt", ORDERS_COLUMNS, _orders("o_totalprice"), _orders(ORDERS_CHANGED), key="pt"
)

EVENTS_COLUMNS = (("event_id", "bigint"), ("user_id", "bigint"), ("value", "decimal(12,2)"))


def _events(value: str, dropped_day: str, key: str = day("ts")) -> str:
    return f"""
        SELECT event_id, user_id, event_type, CAST({value} AS DECIMAL(12,2)) AS value, {key} AS pt
        FROM {{events}} WHERE {day("ts")} <> '{dropped_day}'"""


EVENTS_CHANGED = "CASE WHEN event_type = 'error' AND value > 300 THEN value * 2 ELSE value END"
EVENTS = Pair(
    "events", EVENTS_COLUMNS,
    _events("value", "20240105"), _events(EVENTS_CHANGED, "20240110"), key="pt",
)


NULL_FOR_ERRORS = f"CASE WHEN event_type = 'error' THEN NULL ELSE {day('ts')} END"
EVENTS_NULL_KEY = Pair(
    "events_null_key", EVENTS_COLUMNS,
    _events("value", "20240105", NULL_FOR_ERRORS),
    _events(EVENTS_CHANGED, "20240110", NULL_FOR_ERRORS), key="pt",
)
EVENTS_HOURLY = Pair(
    "events_hourly", EVENTS_COLUMNS,
    _events("value", "20240105", hour("ts")), _events(EVENTS_CHANGED, "20240110", hour("ts")), key="pt",
)


def _documents(where: str = "") -> str:
    return f"SELECT text, source, lang AS pt FROM {{documents}} {where}"


DOCUMENTS = Pair("documents", (), _documents(), _documents("WHERE n_chars >= 20"))
DOCUMENTS_BY_PT = Pair(
    "documents_by_pt", (), _documents(), _documents("WHERE n_chars >= 20 AND lang <> 'de'"),
    key="pt",
)


def _same(sql: str) -> dict[str, str]:
    return {"left": sql, "right": sql}


CUSTOMER = Pair(
    "customer",
    (("c_custkey", "bigint"), ("c_nationkey", "int"), ("c_acctbal", "decimal(12,2)")),
    **_same(f"SELECT c_custkey, c_name, c_nationkey, {decimal('c_acctbal')} FROM {{customer}}"),
)
PART = Pair(
    "part",
    (("p_partkey", "bigint"), ("p_size", "int"), ("p_retailprice", "decimal(12,2)")),
    **_same(f"SELECT p_partkey, p_name, p_size, {decimal('p_retailprice')} FROM {{part}}"),
)
NATION = Pair(
    "nation", (("n_nationkey", "int"), ("n_regionkey", "int")),
    **_same("SELECT n_nationkey, n_name, n_regionkey FROM {nation}"),
)
REGION = Pair(
    "region", (("r_regionkey", "int"),), **_same("SELECT r_regionkey, r_name FROM {region}")
)

# The numbers of the left copy in other types on the right.
MIXED = Pair(
    "orders_migrated",
    (("o_orderkey", "bigint"), ("o_custkey", "int"), ("o_totalprice", "decimal(12,2)"),
     ("o_cents", "bigint")),
    left=f"""
        SELECT o_orderkey, CAST(o_custkey AS INT) AS o_custkey, {decimal("o_totalprice")},
               CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT) AS o_cents
        FROM {{orders}}""",
    right="""
        SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey, o_custkey,
               CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(18,4)) AS o_totalprice,
               CAST(floor(o_totalprice * 100 + 0.5) AS DOUBLE)
                 + CASE WHEN o_totalprice > 499000 THEN 0.5 ELSE 0.0 END AS o_cents
        FROM {orders}""",
    right_columns=(("o_orderkey", "double"), ("o_custkey", "bigint"),
                   ("o_totalprice", "decimal(18,4)"), ("o_cents", "double")),
)

SUITE = (LINEITEM, ORDERS, EVENTS, DOCUMENTS, CUSTOMER, PART, NATION, REGION)
