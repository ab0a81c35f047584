"""Small helpers of the operators: written tables, bounded samples, bindings in expressions."""

from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from countersign.functions.names import free_name
from countersign.sources.storage import work_folder


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Written below the shared folder and read back: lineage ends, lost executors cost nothing."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bits by which ``marked`` tells keys, whatever their number: 262,144 broadcast words of 64.
KEY_BITS = 1 << 24


def marked(df: DataFrame, key: str, among: DataFrame, flag: str) -> DataFrame:
    """``df`` with ``flag``: may ``key`` be a value of the only column of ``among``? False means no, NULL keys aside.

    A bit for each value's hash is broadcast, so rows are told apart where they are. An exact join of those that may
    be follows; the more values there are, the more others it gets.
    """
    (value,) = among.columns
    word, bits = (free_name([*df.columns, flag], name) for name in ("bits_word", "bits"))
    bit = F.pmod(F.xxhash64(value), F.lit(KEY_BITS))
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), (bit % 64).cast("int"))
    told = among.select(F.shiftright(bit, 6).alias(word), mask.alias(bits)).groupBy(word).agg(F.bit_or(bits).alias(bits))
    own = F.pmod(F.xxhash64(F.col(key).cast(among.schema[value].dataType)), F.lit(KEY_BITS))
    joined = df.join(F.broadcast(told), F.shiftright(own, 6) == F.col(word), "left")
    return joined.withColumn(flag, F.coalesce(F.getbit(bits, (own % 64).cast("int")) == 1, F.lit(False))).drop(word, bits)


def tidy[T](task: Callable[[Iterator[T]], Iterator[T]]) -> Callable[[Iterator[T]], Iterator[T]]:
    """The task over batches; at its end the memory that Arrow has free goes back to the system, as workers outlive tasks."""
    @wraps(task)
    def run(batches):
        yield from task(batches)
        pa.default_memory_pool().release_unused()

    return run


def whole_text(df: DataFrame, column: str = "text") -> Column:
    """The text column, with NULL as the empty text."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def in_fold(id_column: Column, folds: int, remainder: int) -> Column:
    """Is crc32 of the id's text, modulo ``folds``, the remainder? Never NULL."""
    text = F.coalesce(id_column.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == remainder


def bounded_sample(df: DataFrame, order_by: str, rows: int, seed: int = 0) -> DataFrame:
    """At most ``rows`` rows, the same ones on every run: those with the smallest keyed hash."""
    return df.orderBy(F.xxhash64(F.lit(seed), order_by), order_by).limit(rows)


def sampled_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``key, text`` and the other columns of ``ids`` (``doc_id`` and more, a bounded sample), one row each.

    A repeated id gives its first text in order. The sample is written, so it is read from all
    documents once.
    """
    rest = [c for c in ids.columns if c != "doc_id"]
    listed = F.broadcast(ids.withColumnRenamed("doc_id", "key"))  # bounded by the sample
    texts = docs.select(F.col("doc_id").alias("key"), whole_text(docs).alias("text")).join(listed, "key")
    first = F.row_number().over(Window.partitionBy("key", *rest).orderBy("text"))
    return written(texts.withColumn("place", first).filter("place = 1").select("key", "text", *rest), "sample")
