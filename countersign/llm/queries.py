"""One query for each operator, over its whole table with production settings."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from countersign.llm import ann, centroids, chat, mixing, near_dedup, omh, packing, pii, prefix_trie, quality, toxicity, urls, weak_rules
from countersign.llm import oracle
from countersign.llm.shared import in_fold

PREDICTED = 0.7
FIXED_RULES = {
    "com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow",
    "net/es/": "block", "net/fr/": "block",
}
#: Only for the test tables: a deployment names a secret of its own.
TEST_KEY = "countersign-test-key"
PIPELINE_TARGETS = {"lang": {"en": 0.45, "de": 0.18, "fr": 0.18, "es": 0.19}}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _judged(docs: DataFrame, held_out: Column, score: Column) -> DataFrame:
    scored = docs.select("doc_id", held_out.alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= PREDICTED).cast("int"))


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.PUModel:
    """Positives and class prior from the labels outside the held-out fold; unlabelled text from documents outside it."""
    known = labels.filter(~in_fold(F.col("doc_id"), 3, 1) & F.col("toxic").isNotNull())
    prior = known.agg(F.avg("toxic")).first()[0]
    unlabelled = docs.select("doc_id").filter(~in_fold(F.col("doc_id"), 3, 1))
    return toxicity.train_pu(docs, known.filter("toxic = 1"), unlabelled, prior or 0.0)


def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return _judged(docs, in_fold(docs["doc_id"], 3, 1), toxicity.toxicity(docs["text"], model))


def op2_ann_forest(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.FlatTrees:
    return quality.train_quality(docs, labels.filter(~in_fold(F.col("doc_id"), 4, 2)))


def op3_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    trees = quality_model(docs, table(spark, sf_dir, "labels"))
    return _judged(docs, in_fold(docs["doc_id"], 4, 2), quality.quality(docs["text"], trees))


def op4_chat_format(spark, sf_dir):
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn int, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    turns, loss = F.col("turns"), F.col("loss")
    spoken = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chat.format_chats(rows).select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("pieces")).alias("loss"),
    ).select(
        "conv_id", F.size(turns).cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(spoken, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op5_order_minhash(spark, sf_dir):
    paired = omh.with_next(table(spark, sf_dir, "documents"))
    cut = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.left("text", F.length("text") - cut), F.left("next_text", cut))
    compared = paired.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited"))
    sketched = compared.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "sketch", "next_sketch",
        omh.fingerprint(F.col("edited")).alias("edited_sketch"),
    )
    return sketched.select(
        "doc_id", "n_chars", "edited_sha256",
        omh.as_text(F.col("sketch")).alias("fingerprint"), omh.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        omh.likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        omh.likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def op6_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), PIPELINE_TARGETS).drop("row")


def op7_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, TEST_KEY)


def packed(docs: DataFrame) -> DataFrame:
    pieces = packing.token_pieces(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"
    )
    return packing.place(packing.numbered(pieces)).drop("piece_id")


def op8_packing(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents"))


def op9_near_dedup(spark, sf_dir):
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), near_dedup.NearSettings(shingle=2))


def op10_url_rules(spark, sf_dir):
    """A page's label is that of the document its path names by number."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.bool_or((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("blocked")
    )
    number = F.expr("try_cast(regexp_extract(url, '/([0-9]+)', 1) AS bigint)")
    labelled = pages.withColumn("doc_id", number).join(labels, "doc_id").select("url", "blocked")
    return urls.judge(pages, urls.rule_table(labelled), FIXED_RULES)


def rebuilt_turns(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first turns of another: c takes the first h of c - c % 20, then its own after
    its first h; h is the crc32 of c, modulo 4."""
    placed, convs = prefix_trie.turns_in_place(rows)
    taken_from = convs.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("base_turns"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    plan = convs.select("*", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 20).alias("base")).join(
        taken_from, "base", "left"
    ).withColumn("taken", F.least("h", F.coalesce("base_turns", F.lit(0))))
    pos = F.col("place") - F.col("first_place")
    own = placed.join(plan, "conv_id").filter(pos >= F.col("h")).select(
        "conv_id", (pos - F.col("h") + F.col("taken")).alias("pos"), "id", "words"
    )
    heads = placed.join(convs, "conv_id").select(F.col("conv_id").alias("base"), pos.alias("pos"), "id", "words").filter("pos < 3")
    borrowed = heads.join(plan.select("conv_id", "base", "h"), "base").filter("pos < h").select("conv_id", "pos", "id", "words")
    kept = F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))
    return own.unionByName(borrowed), plan.select("conv_id", (F.col("taken") + kept).alias("n_turns"))


def op11_prefix_trie(spark, sf_dir):
    nodes, ends = prefix_trie.prefix_trie(*rebuilt_turns(table(spark, sf_dir, "conversations")))
    hashed = nodes.join(prefix_trie.ids_sha256(ends), "name", "left")
    return hashed.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(prefix_trie.EMPTY_SHA256)).alias("ends_sha256"),
    )


#: What fails whatever the rules say: few words, or most of them in repeated windows.
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def op12_weak_rules(spark, sf_dir):
    """Rules are weighed by the texts that pass the base; more likely good than bad is kept."""
    judged, _ = weak_rules.judged(table(spark, sf_dir, "documents"), fit_on=f"NOT ({BASE_FAILED})")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.expr(BASE_FAILED).alias("base_failed"), (F.expr(f"NOT ({BASE_FAILED})") & (F.col("quality") >= 0.5)).alias("kept"),
    )


def op13_centroids(spark, sf_dir):
    return centroids.clusters(table(spark, sf_dir, "embeddings"))[0]


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_ann_forest": op2_ann_forest,
        "op3_quality": op3_quality,
        "op4_chat_format": op4_chat_format,
        "op5_order_minhash": op5_order_minhash,
        "op6_mixing": op6_mixing,
        "op7_pii": op7_pii,
        "op8_packing": op8_packing,
        "op9_near_dedup": op9_near_dedup,
        "op10_url_rules": op10_url_rules,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_weak_rules": op12_weak_rules,
        "op13_centroids": op13_centroids,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op11_prefix_trie": oracle.prefix_trie(),
        "op12_weak_rules": oracle.weak_rules(),
        "op13_centroids": oracle.centroids(),
    }
