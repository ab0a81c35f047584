"""Quality by histogram gradient-boosted trees over document statistics.

Statistics of the whole text are cut into at most 64 bins at the sample's quantiles. Each tree grows
level by level; for every node and statistic a histogram of gradients gives the best split of the
logistic loss. All trees are laid out in flat arrays (statistic, threshold, children, value), so that
a batch of documents walks down all trees at once, one numpy step a level.

The sample is bounded (``max_rows``) and drawn by a hash of the id; every text is scored whole.
Results in special cases: a NULL text is the empty one, which has statistics like any other; a
sample without rows or of one label gives that label's share to every text; labels of ids that repeat
are averaged, and of their texts the first in order counts; NULL labels are left out; an empty table gives no row.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countersign.llm.shared import bounded_sample, sampled_texts, tidy

STATISTICS = (
    "characters", "words", "lines", "word_length", "line_length", "upper", "lower", "digits", "blanks",
    "sentence_marks", "other_marks", "beyond_ascii", "pipes", "exclamations", "distinct_words",
    "distinct_lines", "capitalised", "longest_word", "bytes_used", "byte_entropy",
)
SCORED_TEXTS = 512
_CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digits": range(48, 58), "blanks": (9, 10, 13, 32),
    "sentence_marks": (44, 46, 58, 59, 63), "pipes": (124,), "exclamations": (33,),
    "other_marks": (35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 92, 94, 95, 96, 126),
    "beyond_ascii": range(128, 256),
}
_BYTES = np.zeros((256, len(_CLASSES)))
for _column, _codes in enumerate(_CLASSES.values()):
    _BYTES[list(_codes), _column] = 1
_CAPITAL = re.compile(r"(?<![^\W\d_])[A-Z][a-z]")


def statistics(text: str | None) -> list[float]:
    """The statistics of a text, in the order of ``STATISTICS``."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = max(1, len(raw))
    share = dict(zip(_CLASSES, counts @ _BYTES / size))
    words, lines = text.split(), text.split("\n")
    n_words, n_lines = max(1, len(words)), len(lines)
    used = counts[counts > 0] / size
    return [
        np.log1p(len(text)), np.log1p(len(words)), np.log1p(n_lines), len(text) / n_words,
        np.log1p(len(text) / n_lines), share["upper"], share["lower"], share["digits"], share["blanks"],
        share["sentence_marks"], share["other_marks"], share["beyond_ascii"], share["pipes"],
        share["exclamations"], len(set(words)) / n_words, len(set(lines)) / n_lines,
        len(_CAPITAL.findall(text)) / n_words, np.log1p(max(map(len, words), default=0)),
        float(len(used)), float(-(used * np.log2(used)).sum()),
    ]


@dataclass(frozen=True)
class BoostSettings:
    max_rows: int = 40_000
    trees: int = 60
    depth: int = 4
    bins: int = 64
    rate: float = 0.15
    l2: float = 2.0
    least_in_leaf: int = 10
    seed: int = 3


@dataclass(frozen=True)
class FlatTrees:
    """All trees' nodes one after the other; a leaf is its own child."""

    statistic: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            below = x[rows, self.statistic[at]] <= self.threshold[at]
            at = np.where(below, self.left[at], self.right[at])
        logit = self.base + self.value[at].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, settings: BoostSettings = BoostSettings()) -> FlatTrees:
    n, n_stats = x.shape if len(x) else (0, len(STATISTICS))
    share = float(np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3))
    base = float(np.log(share / (1 - share)))
    nodes: list[list[float]] = []  # statistic, threshold, left, right, value
    roots: list[int] = []
    if n and 0 < y.mean() < 1:
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, settings.bins + 1)[1:-1])) for j in range(n_stats)]
        binned = np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)], axis=1)
        logit = np.full(n, base)
        for _ in range(settings.trees):
            p = 1 / (1 + np.exp(-logit))
            roots.append(len(nodes))
            logit += _grow(nodes, binned, cuts, p - y, p * (1 - p), settings)
    else:
        roots.append(0)
        nodes.append([0, 0.0, 0, 0, 0.0])
    table = np.array(nodes)
    return FlatTrees(
        table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int), table[:, 3].astype(int),
        table[:, 4], np.array(roots), base, settings.depth,
    )


def _grow(nodes, binned, cuts, grad, hess, settings: BoostSettings) -> np.ndarray:
    """Append one tree to the nodes; returns what it adds to each row."""
    bins, n_stats = settings.bins, binned.shape[1]

    def leaf(g: float, h: float) -> int:
        nodes.append([0, 0.0, len(nodes), len(nodes), -settings.rate * g / (h + settings.l2)])
        return len(nodes) - 1

    at = np.full(len(grad), leaf(grad.sum(), hess.sum()))
    for _ in range(settings.depth):
        ids, local = np.unique(at, return_inverse=True)
        shape = (len(ids), bins)
        best = np.full(len(ids), 1e-9)
        choice = np.zeros((len(ids), 2), int)
        for j in range(n_stats):
            key = local * bins + binned[:, j]
            g, h, c = (
                np.bincount(key, weight, len(ids) * bins).reshape(shape).cumsum(axis=1)
                for weight in (grad, hess, None)
            )
            gt, ht, ct = g[:, -1:], h[:, -1:], c[:, -1:]
            gain = g**2 / (h + settings.l2) + (gt - g) ** 2 / (ht - h + settings.l2) - gt**2 / (ht + settings.l2)
            allowed = (c >= settings.least_in_leaf) & (ct - c >= settings.least_in_leaf)
            allowed &= np.arange(bins)[None, :] < len(cuts[j])
            gain = np.where(allowed, gain, 0)
            top = gain.argmax(axis=1)
            found = gain[np.arange(len(ids)), top]
            choice[found > best] = np.stack([np.full(len(ids), j), top], axis=1)[found > best]
            best = np.maximum(best, found)
        if (best <= 1e-9).all():
            break
        for k, node in enumerate(ids):
            if best[k] <= 1e-9:
                continue
            j, cut = choice[k]
            rows = np.flatnonzero(local == k)
            goes_left = binned[rows, j] <= cut
            children = [leaf(grad[r].sum(), hess[r].sum()) for r in (rows[goes_left], rows[~goes_left])]
            nodes[node] = [j, cuts[j][cut], *children, 0.0]
            at[rows] = np.where(goes_left, *children)
    return np.array([nodes[i][4] for i in range(at.max() + 1)])[at]


def train_quality(docs: DataFrame, labels: DataFrame, settings: BoostSettings = BoostSettings()) -> FlatTrees:
    """Learn ``quality`` of ``labels`` (0 or 1, by ``doc_id``) from the statistics of the texts."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("label"))
    texts = sampled_texts(docs, bounded_sample(known, "doc_id", settings.max_rows, settings.seed))

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            stats = np.array([statistics(t) for t in batch["text"]]).reshape(len(batch), len(STATISTICS))
            yield pd.DataFrame({"key": batch["key"], "label": batch["label"], "stats": list(stats)})

    rows = texts.mapInPandas(described, "key bigint, label double, stats array<double>").collect()
    rows.sort(key=lambda r: (r.key, r.stats))
    return boost(np.array([r.stats for r in rows]), np.array([r.label for r in rows]), settings)


def quality(text: Column, trees: FlatTrees) -> Column:
    """Probability that the whole text is a good one, 0 to 1."""
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            scores = [np.zeros(0)]
            # Few texts at a time: those of a whole batch would stay in the worker's memory.
            for at in range(0, len(texts), SCORED_TEXTS):
                stats = [statistics(t) for t in texts.slice(at, SCORED_TEXTS).to_pylist()]
                scores.append(trees.score(np.array(stats)))
            yield pa.array(np.concatenate(scores))

    return F.arrow_udf(tidy(scored), "double")(text)
