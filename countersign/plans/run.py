"""Comparing many tables at once: workers, time limits, isolated errors, result tables."""

import logging
import re
import threading
import time
import uuid
from collections.abc import Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from datetime import datetime
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from countersign.operators.compare import METRICS_SCHEMA, compare
from countersign.operators.rollup import (
    LABELS, partition_reasons, partition_status, run_totals, table_status,
)
from countersign.operators.schema import (
    PARTITION_COLUMN, field_type, integer_columns, is_partitioned, numeric_columns,
)
from countersign.operators.sqltext import check_sql
from countersign.operators.together import Opened, compare_together, estimated_bytes, shape
from countersign.sources.catalog import Lookup, attach_metadata, prefetch_metadata
from countersign.sources.storage import read_if_there, work_folder
from countersign.sources.tables import Stored, TableSpec, check_two_copies, open_for_counts, open_side

log = logging.getLogger(__name__)

RUN_ID = re.compile(r"[A-Za-z0-9._-]+")
WORKERS = 15
TIMEOUT_S = 600.0
POLL_S = 0.2
# So many small tables share a job: more of them would make its plan slow.
TOGETHER = 100

RUN_METRICS_SCHEMA = f"line_no bigint, {METRICS_SCHEMA}"
OUTCOME_SCHEMA = (
    "line_no bigint, table_name string, partitioned boolean, partition_column string, "
    "branch string, sql string, error string, started timestamp, elapsed_s double"
)
RUN_KEY = ("line_no", "table_name")
# What a finished line leaves behind in a run that can be resumed: its outcome, and the settings it was compared with.
MARK_SCHEMA = f"{OUTCOME_SCHEMA}, settings string"


class RunResult(NamedTuple):
    """Result tables of a run, read back from its output folder."""

    metrics: DataFrame
    partitions: DataFrame
    tables: DataFrame
    reasons: DataFrame
    runs: DataFrame


@dataclass
class _Attempt:
    """One table in work: what the watching thread needs to stop it."""

    line_no: int  # 0: a batch of small tables
    tag: str
    deadline: float | None = None
    expired: bool = False


def spec_from_metadata(entry: Row, left_format: str = "parquet") -> TableSpec:
    """Left copy by its storage location, right copy by catalog name.

    Only a partition column named ``pt`` makes the comparison run per partition.
    """
    known = entry.asDict()
    if not known.get("location"):
        if known.get("error"):
            raise LookupError(f"metadata lookup failed: {entry.error}")
        raise LookupError(f"no location known for {entry.table_name}")
    return TableSpec(
        entry.table_name,
        left=Stored(entry.location, left_format),
        right=entry.table_name,
        partition_column=PARTITION_COLUMN if is_partitioned(entry.partition_cols) else None,
    )


def _entries(
    spark: SparkSession,
    manifest: DataFrame,
    specs: Mapping[str, TableSpec],
    lookup: Lookup | None,
    left_format: str,
    workers: int,
    timeout_s: float,
) -> list[tuple[str, TableSpec | Exception]]:
    """The manifest on the driver: names and how to open them, no table data."""
    if "line_no" not in manifest.columns:
        manifest = manifest.withColumn("line_no", F.monotonically_increasing_id())
    manifest = manifest.select("line_no", "table_name")
    if lookup:
        names = [row.table_name for row in manifest.select("table_name").collect()]
        unspecified = [name for name in names if name not in specs]
        manifest = attach_metadata(manifest, prefetch_metadata(spark, unspecified, lookup, workers, timeout_s))
    entries: list[tuple[str, TableSpec | Exception]] = []
    for entry in sorted(manifest.collect(), key=lambda e: e.line_no):
        spec: TableSpec | Exception | None = specs.get(entry.table_name)
        if spec is None:
            try:
                spec = spec_from_metadata(entry, left_format)
            except LookupError as problem:
                spec = problem
        entries.append((entry.table_name, spec))
    return entries


class _Runner:
    def __init__(self, spark, folder, marks, timeout_s, start, end, nan_equal, rel_tol):
        self.spark = spark
        self.folder = folder
        self.marks = marks
        self.timeout_s = timeout_s
        self.start, self.end = start, end
        self.options = {"nan_equal": nan_equal, "rel_tol": rel_tol}

    def table_folder(self, line_no: int) -> str:
        return f"{self.folder}/line_no={line_no}"

    @property
    def settings(self) -> str:
        return repr({"start": self.start, "end": self.end, **self.options})

    def finished_before(self, entries: list[tuple[str, TableSpec | Exception]]) -> list[dict]:
        """Outcomes of the lines that an earlier attempt at this run has finished: their metrics are complete."""
        found = read_if_there(self.spark, self.marks, MARK_SCHEMA) if self.marks else None
        marks = found.collect() if found is not None else []  # a row a manifest line
        for mark in marks:
            if not 0 < mark.line_no <= len(entries) or entries[mark.line_no - 1][0] != mark.table_name:
                raise ValueError(f"line {mark.line_no} of the run to resume was {mark.table_name}; the manifest differs")
            if mark.settings != self.settings:
                raise ValueError(f"the run to resume was started with {mark.settings}, not {self.settings}")
        return [{name: value for name, value in mark.asDict().items() if name != "settings"} for mark in marks]

    def mark_finished(self, *outcomes: dict) -> None:
        """Written after the lines' metrics, so a line with a mark has all of them."""
        rows = [{**outcome, "settings": self.settings} for outcome in outcomes]
        marks = self.spark.createDataFrame(rows, MARK_SCHEMA).coalesce(1)  # a row a line of the batch
        marks.write.mode("overwrite").parquet(f"{self.marks}/line={outcomes[0]['line_no']}")

    def opened(self, line_no: int, name: str, spec: TableSpec) -> Opened:
        check_two_copies(self.spark, spec)
        left, right = open_side(self.spark, spec.left), open_side(self.spark, spec.right)
        return Opened(line_no, name, left, right, spec.partition_column)

    def described(self, table: Opened) -> dict:
        """What the outcome of a table says about its comparison."""
        key = table.partition_column
        columns = [column for column, _ in numeric_columns(table.left)]
        return {
            "partitioned": key is not None, "partition_column": key,
            "branch": ("numeric" if columns else "count_only") + ("_by_partition" if key else "_global"),
            "sql": check_sql(
                table.table_name, columns, key, self.start, self.end,
                integers=integer_columns(table.left),
                **({"partition_type": field_type(table.left, key)} if key else {}),
            ),
        }

    def small_table(self, line_no: int, name: str, spec: TableSpec | Exception, below: int) -> Opened | None:
        """The table, if both copies are smaller than ``below`` bytes; whatever goes wrong is left to its own comparison."""
        try:
            if isinstance(spec, Exception):
                return None
            table = self.opened(line_no, name, spec)
            shape(table)
            small = max(estimated_bytes(table.left), estimated_bytes(table.right)) < below
            return table if small else None
        except Exception:
            return None

    def compare_batch(self, attempt: _Attempt, tables: list[Opened]) -> list[dict] | None:
        """Write the metrics of many small tables in one job; None where that fails, and each is on its own then."""
        began, started = time.time(), datetime.now()
        attempt.deadline = began + self.timeout_s
        self._begin(attempt)
        try:
            metrics = compare_together(self.spark, tables, self.start, self.end, **self.options)
            # Each line's rows become a file in a folder of its own, as those of a table compared alone do.
            metrics = metrics.repartition("line_no").sortWithinPartitions("line_no")
            if attempt.expired:
                raise TimeoutError
            metrics.write.mode("append").partitionBy("line_no").parquet(self.folder)
            outcomes = [
                {"line_no": t.line_no, "table_name": t.table_name, "error": None, "started": started,
                 "elapsed_s": time.time() - began, **self.described(t)}
                for t in tables
            ]
            if self.marks:
                self.mark_finished(*outcomes)
            return outcomes
        except Exception as problem:
            log.info("%d small tables are compared one by one: %s", len(tables), problem)
            return None
        finally:
            self._end(attempt)

    def _begin(self, attempt: _Attempt) -> None:
        context = self.spark.sparkContext
        # Jobs of one pool run in order, pools share the cluster when the scheduler is FAIR.
        context.setLocalProperty("spark.scheduler.pool", threading.current_thread().name)
        context.addJobTag(attempt.tag)
        context.setInterruptOnCancel(True)  # a table past its limit frees its executors at once

    def _end(self, attempt: _Attempt) -> None:
        attempt.deadline = None
        self.spark.sparkContext.removeJobTag(attempt.tag)

    def compare_table(self, attempt: _Attempt, name: str, spec: TableSpec | Exception) -> dict:
        """Write the metrics of one table; anything that goes wrong becomes its error."""
        outcome = {
            "line_no": attempt.line_no, "table_name": name, "partitioned": False,
            "partition_column": None, "branch": "error", "sql": None, "error": None,
            "started": datetime.now(), "elapsed_s": 0.0,
        }
        began = time.time()
        attempt.deadline = began + self.timeout_s
        self._begin(attempt)
        try:
            if isinstance(spec, Exception):
                raise spec
            key = spec.partition_column
            outcome.update(partitioned=key is not None, partition_column=key)
            table = self.opened(attempt.line_no, name, spec)
            left, right = table.left, table.right
            described = self.described(table)
            outcome["sql"] = described["sql"]
            if not numeric_columns(left):
                left, right = open_for_counts(self.spark, spec.left), open_for_counts(self.spark, spec.right)
            metrics = compare(
                left, right, table_name=name, partition_column=key,
                start=self.start, end=self.end, **self.options,
            )
            if attempt.expired:
                raise TimeoutError
            metrics.write.mode("overwrite").parquet(self.table_folder(attempt.line_no))
            outcome["branch"] = described["branch"]
            if self.marks:
                self.mark_finished({**outcome, "elapsed_s": time.time() - began})
        except Exception as problem:
            outcome["branch"] = "error"
            outcome["error"] = (
                f"timed out after {self.timeout_s:g} s" if attempt.expired else str(problem)
            ) or type(problem).__name__
        finally:
            self._end(attempt)
        outcome["elapsed_s"] = time.time() - began
        log.info("%s: %s", name, outcome["error"] or "compared")
        return outcome


def _stop_late(spark: SparkSession, attempts: list[_Attempt]) -> None:
    """Cancel the jobs of tables past their limit, again and again while they start new ones."""
    now = time.time()
    for attempt in attempts:
        deadline = attempt.deadline
        if deadline is not None and now > deadline:
            attempt.expired = True
            spark.sparkContext.cancelJobsWithTag(attempt.tag)


def run(
    spark: SparkSession,
    manifest: DataFrame,
    specs: Mapping[str, TableSpec] | None = None,
    *,
    lookup: Lookup | None = None,
    left_format: str = "parquet",
    workers: int = WORKERS,
    timeout_s: float = TIMEOUT_S,
    start: str | None = None,
    end: str | None = None,
    nan_equal: bool = True,
    rel_tol: float | None = None,
    labels: tuple[str, str] = LABELS,
    out: str | None = None,
    run_id: str | None = None,
    together_below: int = 0,
) -> RunResult:
    """Compare every table of the manifest and write the result tables below ``out``.

    A table is opened as its spec says, or else by what ``lookup`` tells about it (location
    and partition columns): the left copy by location, the right one by name. Tables are
    compared by concurrent Spark jobs, each of which writes its metrics to a folder of its
    own; the driver keeps names, times and error messages. A table that fails or exceeds
    ``timeout_s``, or whose lookup does, is reported as ERROR and does not touch the others.

    A run that is given a ``run_id`` can be resumed: each compared line leaves a mark below ``out``, and
    the next run of that id into the same ``out`` takes over the lines with a mark and compares the others, those that
    ended as ERROR included. Its result tables replace those of the attempt before, one row a line. The manifest
    and the bounds and rules of comparison must be the same; the copies are taken to be so.

    Tables of which both copies are smaller than ``together_below`` bytes, by Spark's estimate, share jobs, up to
    ``TOGETHER`` of them a job, while the others are compared on their own. When such a job fails or exceeds
    ``timeout_s``, its tables are compared one by one.
    """
    began = time.time()
    if run_id is not None and not (out and RUN_ID.fullmatch(run_id)):
        raise ValueError("a run to resume needs out, and an id of letters, digits, '.', '_' and '-'")
    marks = f"{out.rstrip('/')}/marks/run_id={run_id}" if run_id else None
    run_id = run_id or f"r{uuid.uuid4().hex}"
    out = (out or work_folder(spark, "run")).rstrip("/")
    folder = f"{out}/metrics/run_id={run_id}"
    runner = _Runner(spark, folder, marks, timeout_s, start, end, nan_equal, rel_tol)
    entries = _entries(spark, manifest, specs or {}, lookup, left_format, workers, timeout_s)
    prefetch_s = time.time() - began

    outcomes = runner.finished_before(entries)
    finished = {outcome["line_no"] for outcome in outcomes}
    todo = [(i, *entry) for i, entry in enumerate(entries, 1) if i not in finished]
    attempt_id = uuid.uuid4().hex  # jobs of an earlier attempt at this run are not to be taken for this one's
    attempts: list[_Attempt] = []

    def attempt_at(line_no: int) -> _Attempt:
        attempts.append(_Attempt(line_no, f"countersign-{attempt_id}-{len(attempts)}"))
        return attempts[-1]

    with ThreadPoolExecutor(max_workers=workers, thread_name_prefix="countersign") as pool:
        pending: dict[Future, list[int]] = {}
        waiting: list[list[Opened]] = []

        def submit(lines: list[int], work, *args) -> None:
            # Wrapped one by one: each wrapper hands its own copy of the job settings to its thread.
            pending[pool.submit(inheritable_thread_target(spark)(work), *args)] = lines

        def submit_batch() -> None:
            """One at a time: all of them write below the same folder."""
            if waiting:
                tables = waiting.pop(0)
                submit([table.line_no for table in tables], runner.compare_batch, attempt_at(0), tables)

        def submit_line(line_no: int) -> None:
            submit([line_no], runner.compare_table, attempt_at(line_no), *entries[line_no - 1])

        small: list[Opened] = []
        if together_below:
            look = [pool.submit(inheritable_thread_target(spark)(runner.small_table), *line, together_below) for line in todo]
            small = [table for table in (future.result() for future in look) if table]
        shared = {table.line_no for table in small}
        waiting += [small[at:at + TOGETHER] for at in range(0, len(small), TOGETHER)]
        submit_batch()
        for line_no, _, _ in todo:
            if line_no not in shared:
                submit_line(line_no)
        try:
            while pending:
                done, _ = wait(pending, timeout=POLL_S, return_when=FIRST_COMPLETED)
                for future in done:
                    lines, found = pending.pop(future), future.result()
                    outcomes += [] if found is None else found if isinstance(found, list) else [found]
                    if found is None or isinstance(found, list):
                        submit_batch()
                    if found is None:
                        for line_no in lines:
                            submit_line(line_no)
                _stop_late(spark, attempts)
        except BaseException:  # an interrupted run leaves no jobs behind
            pool.shutdown(wait=False, cancel_futures=True)
            for attempt in attempts:
                attempt.deadline = 0.0 if attempt.deadline is not None else None
            while not all(future.done() for future in pending):
                _stop_late(spark, attempts)
                time.sleep(POLL_S)
            raise

    compared = spark.createDataFrame(outcomes, OUTCOME_SCHEMA)
    if any(o["error"] is None for o in outcomes):
        # One read of the whole folder. A stopped table may have left rows, so only finished lines count.
        complete = F.broadcast(compared.filter("error IS NULL").select("line_no"))  # the manifest's size
        metrics = spark.read.schema(RUN_METRICS_SCHEMA).parquet(folder).join(complete, "line_no", "left_semi")
    else:
        metrics = spark.createDataFrame([], RUN_METRICS_SCHEMA)

    def stored(result: DataFrame, name: str) -> DataFrame:
        path = f"{out}/{name}/run_id={run_id}"
        result.write.mode("overwrite").parquet(path)
        return spark.read.schema(result.schema).parquet(path)

    partitions = stored(partition_status(metrics, RUN_KEY), "partitions")
    reasons = stored(partition_reasons(metrics, RUN_KEY, labels), "reasons")
    tables = stored(tables_result(compared, metrics, start, end), "tables")
    totals = run_totals(tables).select(
        "n_tables", "n_failed",
        F.lit(start).cast("string").alias("pt_start"), F.lit(end).cast("string").alias("pt_end"),
        F.lit(workers).alias("workers"), F.lit(prefetch_s).alias("prefetch_s"),
        F.lit(time.time() - began).alias("elapsed_s"),
        F.lit(datetime.fromtimestamp(began)).alias("started"),
    )
    return RunResult(metrics, partitions, tables, reasons, stored(totals, "runs"))


def tables_result(
    compared: DataFrame,
    metrics: DataFrame,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """One row per manifest line. A table without any partition in range passes, with 0 compared.

    ``pt_start`` and ``pt_end`` are the bounds as given; a missing one is the first or last
    partition found on either side, which the metrics tell without another scan.
    """
    verdicts = table_status(metrics, RUN_KEY).select(
        "line_no", "partitions_compared", "first_pt", "last_pt", "n_diffs", "match"
    )
    failed = F.col("error").isNotNull()
    match = ~failed & F.coalesce("match", F.lit(True))
    compared_by_partition = F.col("partitioned") & ~failed
    nothing_found = F.col("partitioned") & (F.coalesce("partitions_compared", F.lit(0)) == 0)
    joined = compared.join(verdicts, "line_no", "left")
    return joined.select(
        "line_no", "table_name", "partitioned", "partition_column",
        F.when(failed, "error").when(nothing_found, "no_partitions")
        .otherwise(F.col("branch")).alias("branch"),
        match.alias("match"),
        F.when(failed, "ERROR").when(match, "PASS").otherwise("FAIL").alias("status"),
        F.coalesce("partitions_compared", F.lit(0).cast("bigint")).alias("partitions_compared"),
        F.when(compared_by_partition, F.coalesce(F.lit(start), "first_pt")).alias("pt_start"),
        F.when(compared_by_partition, F.coalesce(F.lit(end), "last_pt")).alias("pt_end"),
        F.coalesce("n_diffs", F.lit(0).cast("bigint")).alias("n_diffs"),
        "error", "sql", "started", "elapsed_s",
    )
