"""Table metadata: where a copy is stored and what it is partitioned by."""

import queue
import threading
import time
from collections import deque
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countersign.functions.names import quoted_table

Lookup = Callable[[SparkSession, str], tuple[str, list[str]]]

DETAILS = "# Detailed Table Information"
METADATA_SCHEMA = "table_name string, location string, partition_cols array<string>, error string"


def table_metadata(spark: SparkSession, name: str) -> tuple[str, list[str]]:
    """Storage location and partition columns of a catalog table."""
    partition_cols = [c.name for c in spark.catalog.listColumns(quoted_table(name)) if c.isPartition]
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted_table(name)}").collect()
    titles = [row.col_name for row in described]
    # Columns come first, and one of them may be called Location too.
    details = described[titles.index(DETAILS):] if DETAILS in titles else []
    location = next((row.data_type for row in details if row.col_name == "Location"), "")
    return location, partition_cols


def prefetch_metadata(
    spark: SparkSession,
    names: Iterable[str],
    lookup: Lookup = table_metadata,
    workers: int = 15,
    timeout_s: float | None = None,
) -> DataFrame:
    """``table_name, location, partition_cols, error`` of each name.

    A lookup that fails gives an empty location and its message, so that only this table
    ends as an error; so does one that has not answered ``timeout_s`` seconds after it began. The names are those of the manifest: catalog calls, no table data.
    ``lookup`` may ask another catalog for the left copy.
    """
    def one(name: str):
        try:
            location, partition_cols = lookup(spark, name)
            return (name, location, list(partition_cols), None)
        except Exception as problem:
            return (name, "", [], str(problem))

    rows = _answers(list(dict.fromkeys(names)), one, workers, timeout_s)
    return spark.createDataFrame(rows, METADATA_SCHEMA)


def _answers(names: list[str], one: Callable[[str], tuple], workers: int, timeout_s: float | None) -> list[tuple]:
    """``one`` of each name, ``workers`` at a time. A call that is late gives its place to the next one and is left behind:
    a thread cannot be ended, but nothing waits for it any more."""
    answered: queue.Queue = queue.Queue()
    waiting, began, found = deque(names), {}, {}
    while waiting or began:
        while waiting and len(began) < workers:
            name = waiting.popleft()
            began[name] = time.monotonic()
            threading.Thread(target=lambda name=name: answered.put((name, one(name))), daemon=True).start()
        try:
            left = None if timeout_s is None else max(0.0, min(began.values()) + timeout_s - time.monotonic())
            name, row = answered.get(timeout=left)
        except queue.Empty:
            now = time.monotonic()
            for name in [name for name, start in began.items() if now - start >= timeout_s]:
                del began[name]
                found[name] = (name, "", [], f"no answer from the catalog within {timeout_s:g} s")
            continue
        if began.pop(name, None) is not None:
            found[name] = row
    return [found[name] for name in names]


def attach_metadata(manifest: DataFrame, metadata: DataFrame) -> DataFrame:
    """Each manifest line with its table's metadata, empty where there is none."""
    return manifest.join(metadata, "table_name", "left").select(
        "line_no", "table_name",
        F.coalesce("location", F.lit("")).alias("location"),
        F.coalesce("partition_cols", F.array().cast("array<string>")).alias("partition_cols"),
        "error",
    )
