"""Mixing of sources, languages and topics to target shares, with Spark expressions only.

Documents are counted in cells of equal source, language and topic. Iterative proportional fitting
rakes the tokens to be sampled from each cell: for one dimension after the other, each cell is
scaled by target over current sum of its value, and never beyond the tokens it has. A document's
probability is its cell's raked share; a hash of its id decides, so every run samples the same.

Cells are combined before they are shuffled and raked as a table: a source with a third of all
rows costs no more than any other. Each round is written below the shared folder, so lineage stays
short. Rounds end when no sum changes by more than ``tolerance``, or after ``rounds``. A target beyond
what its cells hold is met as far as they go; in ``mix``, the other values then fill up the sampled share.
Targets and shares that are missed are logged, and ``marginals`` lists wanted and achieved ones.

Results in special cases: NULL sources, languages and topics are values of their own; values without a
target share what the named ones leave, in proportion to their tokens; where the targets leave nothing, such values keep
their own share of all tokens and the targets are scaled to the rest; a NULL or empty text has no
tokens and follows its cell (probability 0 in a cell without tokens); rows without an id are told
apart by their text, and repeated rows share their fate; an empty table gives no row.
"""

import logging
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countersign.llm.shared import written

log = logging.getLogger(__name__)

DIMENSIONS = ("source", "lang", "topic")
ROUNDS, TOLERANCE = 12, 1e-3
#: Goals and sums of a dimension with at most so many values are broadcast; beyond, they are joined by a shuffle.
BROADCAST_VALUES = 100_000
#: Targets that leave less than this to values without one leave them nothing.
LEAST_LEFT = 1e-9
#: Shares that are missed by more are reported.
MISSED = 0.01
Targets = Mapping[str, Mapping[str, float]]

#: Topic of a text: the first rule that its text matches, else "prose".
TOPICS = {
    "licence": r"(?i)licensed under|all rights reserved|copyright",
    "contact": r"@[A-Za-z0-9-]+\.[A-Za-z]|\(\d{3}\) ?\d{3}-\d{4}",
    "table": r" \| [^|\n]* \| ",
    "symbols": r"[#$%&*]{3}",
}


def topic_of(text: Column, rules: Mapping[str, str] = TOPICS) -> Column:
    named = [F.when(text.rlike(pattern), F.lit(name)) for name, pattern in rules.items()]
    return F.coalesce(*named, F.lit("prose"))


def tokens_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\S+")).cast("bigint")


def shares(cells: DataFrame, dimension: str, targets: Mapping[str, float]) -> DataFrame:
    """``value, tokens, share`` of a dimension: named targets; the rest by tokens."""
    sums = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").cast("double").alias("tokens"))
    named = F.lit(None).cast("double")
    for value, share in targets.items():
        named = F.when(F.col("value").eqNullSafe(F.lit(value)), F.lit(float(share))).otherwise(named)
    marked = sums.select("value", "tokens", named.alias("named"))
    total = marked.agg(
        F.coalesce(F.sum("named"), F.lit(0.0)).alias("taken"),
        F.coalesce(F.sum(F.when(F.col("named").isNull(), F.col("tokens"))), F.lit(0.0)).alias("open"),
        F.sum("tokens").alias("all"),
    )
    left = 1 - sum(map(float, targets.values()))
    # Targets that leave nothing are scaled down: values without one keep their own share of the tokens.
    rest = F.lit(left) if left > LEAST_LEFT else F.when(F.col("all") > 0, F.col("open") / F.col("all")).otherwise(F.lit(0.0))
    scale = F.lit(1.0) if left > LEAST_LEFT else F.when(F.col("taken") > 0, (1 - rest) / F.col("taken")).otherwise(F.lit(0.0))
    free = F.when(F.col("open") > 0, F.col("tokens") / F.col("open") * rest).otherwise(F.lit(0.0))
    # One row on the right: the sums of the left side.
    joined = marked.join(F.broadcast(total), F.lit(True))
    weighed = joined.select(
        "value", "tokens", F.coalesce(F.col("named") * scale, free).alias("share"),
        (F.col("taken") * scale + F.when(F.col("open") > 0, rest).otherwise(F.lit(0.0))).alias("whole"),
    )
    share = F.when(F.col("whole") > 0, F.col("share") / F.col("whole")).otherwise(F.lit(0.0))
    return weighed.select("value", "tokens", share.alias("share"))


def within_reach(goal: DataFrame, sampled_share: float) -> DataFrame:
    """Goals that the tokens of each value can meet: the rest of one beyond them goes to the others, by their shares."""
    total = goal.agg(F.sum("tokens")).first()[0] or 0.0
    room = F.col("tokens") / F.lit(total * sampled_share or 1.0)
    factor, full = 1.0, -1
    while True:
        over = (F.col("share") > 0) & (F.col("share") * F.lit(factor) >= room)
        # One row: the sums of all values. Values that are full stay so, since the factor only grows.
        sums = goal.agg(
            F.count_if(over), F.sum(F.when(over, room).otherwise(F.lit(0.0))),
            F.sum(F.when(over, F.lit(0.0)).otherwise(F.col("share"))),
        ).first()
        if not sums[0] or sums[0] == full or sums[2] <= 0:
            break
        full, factor = sums[0], max(factor, (1 - sums[1]) / sums[2])
    return goal.withColumn("share", F.least(F.col("share") * F.lit(factor), room))


def rake(
    cells: DataFrame, targets: Targets, sampled_share: float,
    rounds: int = ROUNDS, tolerance: float = TOLERANCE, reachable: bool = False,
) -> DataFrame:
    """``source, lang, topic, tokens, raked``: tokens to sample from each cell.

    With ``reachable``, targets beyond the tokens of their values give way, so that the sampled share is met.
    """
    cells = written(cells, "cells")
    listed, few = cells, {}
    for d in DIMENSIONS:
        goal = written(shares(cells, d, targets.get(d, {})), f"goal-{d}")
        if reachable and targets.get(d):
            goal = within_reach(goal, sampled_share)
        goal = goal.select("value", "share")
        few[d] = goal.count() <= BROADCAST_VALUES
        same = listed[d].eqNullSafe(goal["value"])
        listed = listed.join(F.broadcast(goal) if few[d] else goal, same).drop("value").withColumnRenamed("share", f"goal_{d}")
    wanted = (cells.agg(F.sum("tokens")).first()[0] or 0) * sampled_share
    kept = [*DIMENSIONS, "tokens", *[f"goal_{d}" for d in DIMENSIONS]]
    raked = written(listed.withColumn("raked", F.col("tokens") * F.lit(float(sampled_share))), "raked")
    for _ in range(rounds):
        raked = raked.select(*kept, "raked", F.col("raked").alias("last"))
        for d in DIMENSIONS:
            # One row a value: as many as its goals.
            sums = raked.groupBy(F.col(d).alias("value")).agg(F.sum("raked").alias("now"))
            joined = raked.join(F.broadcast(sums) if few[d] else sums, raked[d].eqNullSafe(sums["value"]))
            factor = F.when(F.col("now") > 0, F.col(f"goal_{d}") * F.lit(wanted) / F.col("now")).otherwise(F.lit(0.0))
            scaled = F.least(F.col("tokens").cast("double"), F.col("raked") * factor)
            raked = joined.select(*kept, "last", scaled.alias("raked"))
        raked = written(raked, "raked")
        change = raked.agg(
            F.max(F.abs(F.col("raked") - F.col("last")) / F.greatest(F.lit(1.0), F.col("last")))
        ).first()[0]
        if change is None or change <= tolerance:
            break
    return raked.select(*DIMENSIONS, "tokens", "raked")


def marginals(raked: DataFrame, targets: Targets) -> DataFrame:
    """``dimension, value, tokens, wanted, achieved, full_share``: shares of the sampled tokens per value.

    ``wanted`` is what the targets ask for, ``full_share`` the largest sampled share that could meet it: the least of
    these meets all targets of the dimension.
    """
    parts = []
    for d in DIMENSIONS:
        sums = raked.groupBy(F.col(d).alias("value")).agg(F.sum("raked").alias("sampled"))
        goal = shares(raked, d, targets.get(d, {}))
        # One row on the right: the sums of all cells.
        whole = raked.agg(F.sum("raked").alias("all_sampled"), F.sum("tokens").alias("all_tokens"))
        joined = goal.join(sums.withColumnRenamed("value", "v"), F.col("value").eqNullSafe(F.col("v")))
        parts.append(joined.join(F.broadcast(whole), F.lit(True)).select(
            F.lit(d).alias("dimension"), F.col("value").cast("string").alias("value"), "tokens", F.col("share").alias("wanted"),
            F.when(F.col("all_sampled") > 0, F.col("sampled") / F.col("all_sampled")).alias("achieved"),
            F.when(F.col("share") > 0, F.least(
                F.lit(1.0), F.col("tokens") / F.col("all_tokens") / F.col("share")
            )).alias("full_share"),
        ))
    return reduce(DataFrame.unionByName, parts)


def report_misses(raked: DataFrame, targets: Targets, sampled_share: float) -> None:
    """Warn of each target, and of the sampled share, that the data miss by more than ``MISSED``."""
    for d, named in targets.items():
        # At most as many rows as named targets.
        values = F.col("value").isin([str(v) for v in named if v is not None]) | F.col("value").isNull()
        off = F.abs(F.col("achieved") - F.col("wanted")) > MISSED
        for r in marginals(raked, {d: named}).filter((F.col("dimension") == d) & values & off).collect():
            log.warning("%s %s: share %.3f wanted, %.3f sampled (met up to a sampled share of %.3f)", d, r.value, r.wanted, r.achieved, r.full_share)
    sums = raked.agg(F.sum("raked"), F.sum("tokens")).first()
    if sums[1] and abs(sums[0] / sums[1] - sampled_share) > MISSED:
        log.warning("sampled share %.3f wanted, %.3f reached", sampled_share, sums[0] / sums[1])


def mix(
    docs: DataFrame, targets: Targets | None = None, sampled_share: float = 0.5,
    rounds: int = ROUNDS, seed: int = 6, topics: Mapping[str, str] = TOPICS,
) -> DataFrame:
    """``doc_id, source, lang, topic, n_tokens, probability, sampled, row`` per document; ``row``
    holds the columns of the document.

    About ``sampled_share`` of all tokens are sampled. A value's target is its share of them; where the tokens of
    a value do not suffice for that, all are sampled, the others get the rest by their targets, and a warning says so.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    described = docs.select(
        "doc_id", "source", "lang", topic_of(text, topics).alias("topic"),
        tokens_of(text).alias("n_tokens"),
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
    )
    cells = described.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens"))
    raked = rake(cells, targets or {}, sampled_share, rounds, reachable=True)
    report_misses(raked, targets or {}, sampled_share)
    probability = F.when(F.col("tokens") > 0, F.col("raked") / F.col("tokens")).otherwise(F.lit(0.0))
    rates = raked.select(*[F.col(d).alias(f"cell_{d}") for d in DIMENSIONS], probability.alias("probability"))
    same = reduce(
        Column.__and__, [described[d].eqNullSafe(rates[f"cell_{d}"]) for d in DIMENSIONS]
    )
    drawn = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.col("row.text")), F.lit(""))
    chance = F.shiftrightunsigned(F.xxhash64(F.lit(seed), drawn), 11) / F.lit(float(1 << 53))
    return described.join(rates, same).select(
        "doc_id", "source", "lang", "topic", "n_tokens", "probability",
        (chance < F.col("probability")).alias("sampled"), "row",
    )
