"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic examples and unlabelled text are needed. With a class prior p, the risk on
clean text is what remains of the unlabelled risk after the toxic share is taken out; where a
classifier has fitted so far that this remainder turns negative, the step goes back instead::

    risk = p * E_pos[loss(f, +1)] + max(0, E_unl[loss(f, -1)] - p * E_pos[loss(f, -1)])

The classifiers are linear over the presence of words and of their beginnings. Their vocabulary holds the words that
stand out most in the toxic examples, counted by Spark over both samples.

Samples are bounded (``max_positive``, ``max_unlabelled``) and drawn by a hash of the id; every text is
scored whole. Results in special cases: a NULL text is the empty one; the empty text gets the score of a text without
any known word; without toxic examples or unlabelled text, every score is the prior; of a sampled id
that repeats, the first text in order is the example; an empty table gives no row.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countersign.llm.shared import bounded_sample, sampled_texts

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5)


def features(text: str | None) -> set[str]:
    """The text's words, and the beginnings of longer ones, so that inflected forms share a feature."""
    words = set(WORD.findall((text or "").lower()))
    return words.union(*({w[:n] + "-" for w in words if len(w) > n} for n in PREFIXES))


@dataclass(frozen=True)
class PUSettings:
    max_positive: int = 12_000
    max_unlabelled: int = 36_000
    vocabulary: int = 1024
    min_documents: int = 5
    members: int = 2
    epochs: int = 150
    batch: int = 16_384
    rate: float = 0.1
    l2: float = 1e-5
    seed: int = 1


@dataclass(frozen=True)
class PUModel:
    words: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        known = features(text) & self.words.keys()
        logit = self.bias + sum(self.words[w] for w in sorted(known))
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def _word_counts(texts: DataFrame, size: int, least: int) -> dict[str, float]:
    """The words that stand out most in the positive texts, with their log odds."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    starts = [
        F.transform(
            F.filter("words", lambda w, n=n: F.length(w) > n), lambda w, n=n: F.concat(F.left(w, F.lit(n)), F.lit("-"))
        )
        for n in PREFIXES
    ]
    n_pos, n_unl = texts.agg(F.count_if("positive"), F.count_if(~F.col("positive"))).first()
    if not n_pos or not n_unl:
        return {}
    counted = (
        texts.select("positive", words.alias("words"))
        .select("positive", F.explode(F.array_distinct(F.concat("words", *starts))).alias("word"))
        .groupBy("word")
        .agg(F.count_if("positive").alias("pos"), F.count_if(~F.col("positive")).alias("unl"))
        .filter(F.col("pos") >= least)
    )
    share_pos, share_unl = (F.col("pos") + 0.5) / (n_pos + 1), (F.col("unl") + 0.5) / (n_unl + 1)
    pooled = (F.col("pos") + F.col("unl") + 1) / (n_pos + n_unl + 2)
    spread = F.sqrt(pooled * (1 - pooled) * (1 / n_pos + 1 / n_unl))
    chosen = (
        counted.withColumn("stands_out", (share_pos - share_unl) / spread)
        .filter("stands_out > 4")
        .orderBy(F.desc("stands_out"), "word").limit(size)
    )
    return {r.word: float(r.stands_out) for r in chosen.collect()}


def _presence(texts: DataFrame, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bits of the known words of each sampled text, and whether it is a positive one."""
    place = {w: i for i, w in enumerate(words)}

    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            packed = []
            for text in batch["text"]:
                row = np.zeros(len(place), np.uint8)
                row[[place[w] for w in features(text) & place.keys()]] = 1
                packed.append(np.packbits(row).tobytes())
            yield pd.DataFrame({"key": batch["key"], "positive": batch["positive"], "bits": packed})

    rows = texts.mapInPandas(bits, "key bigint, positive boolean, bits binary").collect()
    rows.sort(key=lambda r: (r.positive, r.key, bytes(r.bits)))
    packed = np.array([np.frombuffer(r.bits, np.uint8) for r in rows])
    return np.unpackbits(packed, axis=1)[:, : len(words)], np.array([r.positive for r in rows])


def _train(x: np.ndarray, positive: np.ndarray, prior: float, settings: PUSettings, seed: int):
    """Adam on batches that hold positive and unlabelled rows in the samples' proportion."""
    rng = np.random.default_rng(seed)
    xp, xu = x[positive], x[~positive]
    w, m, v = (np.zeros(x.shape[1] + 1, np.float32) for _ in range(3))
    w[-1] = np.log(prior / (1 - prior))
    batches = max(1, (len(xp) + len(xu)) // settings.batch)
    step = 0
    for epoch in range(settings.epochs):
        parts = zip(
            np.array_split(rng.permutation(len(xp)), batches),
            np.array_split(rng.permutation(len(xu)), batches), strict=True,
        )
        for ip, iu in parts:
            if not len(ip) or not len(iu):
                continue
            step += 1
            bp, bu = xp[ip].astype(np.float32), xu[iu].astype(np.float32)
            fp, fu = (np.clip(b @ w[:-1] + w[-1], -30, 30) for b in (bp, bu))
            # Logistic loss: loss(f, +1) = log(1 + e^-f), loss(f, -1) = log(1 + e^f).
            clean = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
            sp, su = 1 / (1 + np.exp(-fp)), 1 / (1 + np.exp(-fu))
            if clean >= 0:
                gp, gu = prior * (sp - 1) - prior * sp, su
            else:
                gp, gu = prior * sp, -su
            gp, gu = (gp / len(ip)).astype(np.float32), (gu / len(iu)).astype(np.float32)
            g = np.append(bp.T @ gp + bu.T @ gu, gp.sum() + gu.sum())
            g[:-1] += settings.l2 * w[:-1]
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            rate = settings.rate * (1 - epoch / settings.epochs)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def train_pu(
    docs: DataFrame, positive_ids: DataFrame, unlabelled_ids: DataFrame, prior: float,
    settings: PUSettings = PUSettings(),
) -> PUModel:
    """Learn from the texts of ``docs`` whose ``doc_id`` is in either list of ids."""
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    constant = PUModel({}, float(np.log(prior / (1 - prior))))
    chosen = [
        bounded_sample(ids.select("doc_id").filter("doc_id IS NOT NULL").distinct(), "doc_id", n, settings.seed)
        .withColumn("positive", F.lit(flag))
        for ids, n, flag in (
            (positive_ids, settings.max_positive, True), (unlabelled_ids, settings.max_unlabelled, False),
        )
    ]
    texts = sampled_texts(docs, chosen[0].unionByName(chosen[1]))
    found = _word_counts(texts, settings.vocabulary, settings.min_documents)
    if not found:
        return constant
    words = sorted(found)
    x, positive = _presence(texts, words)
    if positive.all() or not positive.any():
        return constant
    weights = np.mean(
        [_train(x, positive, prior, settings, settings.seed + k) for k in range(settings.members)], axis=0
    )
    return PUModel(dict(zip(words, map(float, weights[:-1]))), float(weights[-1]))


def toxicity(text: Column, model: PUModel) -> Column:
    """Probability that the whole text is toxic, 0 to 1."""
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return scored(text)
