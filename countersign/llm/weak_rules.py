"""Quality from rules that vote or abstain, weighed by expectation-maximisation without any label.

Each rule reads statistics of the whole text and votes for good (1), for bad (-1) or not at all (0). How
far a rule can be trusted is estimated from how the rules agree: a text is taken to be good or bad with a
probability, and a rule has, for good texts and for bad ones, a probability of each of its three votes.
Expectation gives each pattern of votes its probability to be good; maximisation estimates the share of
good texts and the rules' tables anew from these. So a rule that bad texts seldom break says little by being kept
and much by being broken, and a text may break one rule and still be good.

Spark counts how often each pattern of votes occurs; the rounds run on these counts alone, 3^rules rows at
most, and every text counts. The estimates start from ``START``, which also counts like ``PSEUDO`` texts of each class, so
that a table without votes keeps sensible ones and the two classes keep their meaning.

Results in special cases: NULL and empty texts and those without a word have zero counts; a statistic's ratio to no words breaks
no rule and keeps none; rows without an id and repeated rows are judged like others; an empty table gives no row;
very long texts are counted whole; other columns are ignored.
"""

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countersign.llm.shared import written

#: Counts of a text, in the order of ``statistics``.
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended_lines",
    "n_lettered", "n_short", "n_upper", "n_distinct",
)
SYMBOLS = b"#*$%&|<>"
ENDS = tuple(c.encode() for c in ".!?:;\")…»”")
SHORT = 3
#: Words whose properties a task remembers.
KNOWN_WORDS = 100_000

VOTES = (-1, 0, 1)
ROUNDS = 50
PSEUDO = 10.0
START_GOOD = 0.8
#: Probability of the votes bad, none, good: of a bad text, of a good one.
START = ((0.3, 0.2, 0.5), (0.02, 0.18, 0.8))
MOST_RULES = 10


@dataclass(frozen=True)
class Rule:
    """SQL conditions over ``COUNTS``; where neither holds, or ``of`` is 0, the rule abstains."""

    name: str
    bad: str
    good: str
    of: str = "n_words"


RULES = (
    Rule("symbols", "10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    Rule("word_length", "word_chars < 3 * n_words OR word_chars > 10 * n_words", "word_chars >= 4 * n_words AND 2 * word_chars <= 13 * n_words"),
    Rule("duplicate_lines", "10 * n_dup_lines > 3 * n_lines", "n_dup_lines = 0 AND n_lines >= 3", "n_lines"),
    Rule("repeated_words", "5 * n_repeat_words > n_words", "50 * n_repeat_words <= n_words"),
    Rule("lettered_words", "5 * n_lettered < 4 * n_words", "20 * n_lettered >= 19 * n_words"),
    Rule("short_words", "10 * n_short < n_words", "5 * n_short >= n_words AND 20 * n_short <= 9 * n_words"),
    Rule("upper_words", "5 * n_upper > n_words", "20 * n_upper <= n_words"),
    Rule("ended_lines", "5 * n_ended_lines < 2 * n_lines", "5 * n_ended_lines >= 4 * n_lines", "n_lines"),
    Rule("distinct_words", "5 * n_distinct < n_words", "2 * n_distinct >= n_words"),
)


class Counter:
    """Counts of one text after the other; remembers what it found out about words."""

    def __init__(self):
        self.known: dict[bytes, tuple[int, int, int]] = {}

    def _word(self, word: bytes) -> tuple[int, int, int]:
        """Has a letter, is short, is in upper case (two letters at least)."""
        found = self.known.get(word)
        if found is None:
            text = word.decode("utf-8", "replace")
            letters = [c for c in text if c.isalpha()]
            upper = len(letters) > 1 and any(c.isupper() for c in letters) and not any(c.islower() for c in letters)
            if len(self.known) >= KNOWN_WORDS:
                self.known.clear()
            found = self.known[word] = (int(bool(letters)), int(len(text) <= SHORT), int(upper))
        return found

    def counts(self, text: bytes) -> tuple[int, ...]:
        # bytes.split() cuts at the blank and at 0x09 to 0x0D.
        words = text.split()
        bytes_of = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        blanks = int(bytes_of[0x20] + bytes_of[0x09:0x0E].sum())
        word_chars = len(text) - int(bytes_of[0x80:0xC0].sum()) - blanks
        symbols = int(bytes_of[list(SYMBOLS)].sum())
        lines = [line for line in text.split(b"\n") if line.strip()]
        ended = sum(line.rstrip().endswith(ENDS) for line in lines)
        numbers: dict[bytes, int] = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
        lettered, short, upper = (
            np.array([self._word(w) for w in numbers], np.int64).T @ np.bincount(ids) if words else (0, 0, 0)
        )
        return (
            len(words), word_chars, symbols, len(lines) - len(set(lines)), repeated_words(ids, len(numbers)), len(lines),
            ended, int(lettered), int(short), int(upper), len(numbers),
        )


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Words that lie in a window of three that occurs twice or more; ``ids`` number equal words alike."""
    if len(ids) < 4 or distinct == len(ids):
        return 0
    _, pairs = np.unique(ids[:-1] * distinct + ids[1:], return_inverse=True)
    _, windows, often = np.unique(pairs[:-1] * distinct + ids[2:], return_inverse=True, return_counts=True)
    again = often[windows] > 1
    inside = np.zeros(len(ids), bool)
    for shift in range(3):
        inside[shift : shift + len(again)] |= again
    return int(inside.sum())


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``COUNTS`` of each row's whole text."""
    schema = pa.schema([("doc_id", pa.int64()), *((name, pa.int64()) for name in COUNTS)])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column("text").cast(pa.binary())
                rows = [counter.counts(text.as_py() or b"") for text in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(column, pa.int64()) for column in zip(*rows))], schema=schema
                )

    fields = ", ".join(f"{name} bigint" for name in ("doc_id", *COUNTS))
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(counted, fields)


def vote(rule: Rule) -> Column:
    return F.expr(f"CASE WHEN {rule.of} = 0 THEN 0 WHEN {rule.bad} THEN -1 WHEN {rule.good} THEN 1 ELSE 0 END")


@dataclass(frozen=True)
class RuleModel:
    """Share of good texts, and for each rule the probabilities of its votes: ``tables[class][rule][vote + 1]``,
    class 0 bad and 1 good."""

    rules: tuple[Rule, ...]
    good: float
    tables: tuple

    def weight(self, rule: int, vote: int) -> float:
        """What a vote adds to the log odds of being good."""
        return math.log(self.tables[1][rule][vote + 1] / self.tables[0][rule][vote + 1])

    def probability(self, votes: Sequence[Column]) -> Column:
        """Probability to be good, from the columns of votes."""
        odds = F.lit(math.log(self.good / (1 - self.good)))
        for rule, column in enumerate(votes):
            odds = odds + (
                F.when(column == -1, self.weight(rule, -1)).when(column == 1, self.weight(rule, 1)).otherwise(self.weight(rule, 0))
            )
        return 1 / (1 + F.exp(-odds))

    def accuracies(self) -> dict[str, tuple[float, float]]:
        """Of each rule that votes: how often it is right about bad texts, and about good ones."""
        return {
            rule.name: (bad[0] / (bad[0] + bad[2]), good[2] / (good[0] + good[2]))
            for rule, bad, good in zip(self.rules, *self.tables)
        }


def estimated(patterns: Sequence[Sequence[int]], counts: Sequence[float], rules: Sequence[Rule], rounds: int = ROUNDS) -> RuleModel:
    """The model after ``rounds`` rounds of expectation and maximisation over counted patterns of votes."""
    n = np.array(counts, float)
    cast = np.array([[[v == vote for vote in VOTES] for v in pattern] for pattern in patterns], float).reshape(len(n), len(rules), 3)
    start = np.repeat(np.array(START)[:, None, :], len(rules), axis=1)
    tables, good = start, START_GOOD
    for _ in range(rounds):
        logs = np.einsum("prv,krv->kp", cast, np.log(tables)) + np.log([[1 - good], [good]])
        share = np.exp(logs - np.logaddexp(logs[0], logs[1])) * n
        seen = np.einsum("kp,prv->krv", share, cast) + PSEUDO * start
        tables = seen / seen.sum(axis=2, keepdims=True)
        good = float((share[1].sum() + PSEUDO * START_GOOD) / (n.sum() + PSEUDO))
    return RuleModel(tuple(rules), good, tuple(tuple(tuple(map(float, row)) for row in table) for table in tables))


def fitted(voted: DataFrame, rules: Sequence[Rule]) -> RuleModel:
    """The model of all rows of ``voted``, which has a column ``vote_<rule>`` for each rule."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules have too many patterns of votes; {MOST_RULES} is the most")
    names = [f"vote_{rule.name}" for rule in rules]
    rows = sorted(tuple(row) for row in voted.groupBy(*names).count().collect())  # 3^rules rows at most
    return estimated([row[:-1] for row in rows], [row[-1] for row in rows], rules)


def judged(docs: DataFrame, rules: Sequence[Rule] = RULES, fit_on: str = "true") -> tuple[DataFrame, RuleModel]:
    """``doc_id``, ``COUNTS``, a ``vote_<rule>`` of each rule and ``quality``, the probability to be good; and the model.

    The model is estimated from the rows for which the SQL condition ``fit_on`` over the counts holds, and judges all rows.
    """
    counted = written(statistics(docs), "statistics")
    voted = counted.select("*", *[vote(rule).alias(f"vote_{rule.name}") for rule in rules])
    model = fitted(voted.filter(fit_on), rules)
    return voted.withColumn("quality", model.probability([F.col(f"vote_{rule.name}") for rule in rules])), model
