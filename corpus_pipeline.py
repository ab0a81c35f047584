"""From raw documents to packed sequences: quality, near duplicates, private data, mixture, packing.

Each stage works on all rows the one before it kept. All but the last return the columns of
``documents``; a changed text changes ``n_chars`` with it. An empty table runs through all stages.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countersign.functions.names import free_name
from countersign.llm import mixing, near_dedup, pii, quality
from countersign.llm.queries import PIPELINE_TARGETS, TEST_KEY, packed, quality_model, table
from countersign.llm.shared import marked, written

#: Documents whose score is below it go: more likely bad than good.
REJECTED_BELOW = 0.5
#: Of all tokens, so many are sampled; high, so that clean documents stay.
SAMPLED_SHARE = 0.9


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    trees = quality_model(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.filter(quality.quality(docs["text"], trees) >= REJECTED_BELOW)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id. Rows without an id stay, and so do all rows
    that repeat the id of one that stays. Most rows are told to stay without a shuffle of their texts."""
    groups = near_dedup.near_groups(docs)
    gone = written(groups.filter("NOT kept").select("doc_id"), "gone")
    may_go = free_name(docs.columns, "may_go")
    told = marked(docs, "doc_id", gone, may_go)
    stay = told.filter(~F.col(may_go)).select(*docs.columns)
    return stay.union(told.filter(may_go).join(gone, "doc_id", "left_anti").select(*docs.columns))


def hide_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kinds = free_name(docs.columns, "private_kinds")
    hidden = pii.pseudonymise(docs, TEST_KEY, kinds_column=kinds).drop(kinds)
    chars = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint"))
    types = dict(docs.dtypes)
    return hidden.withColumn("n_chars", chars.cast(types["n_chars"])).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(docs, PIPELINE_TARGETS, SAMPLED_SHARE)
    return mixed.filter("sampled").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed(docs)


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_copies),
    ("private_data", hide_private),
    ("mixture", mix_sources),
    ("packing", pack_documents),
]

#: Trained trees, rakes and a public tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
