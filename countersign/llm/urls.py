"""URL filtering by association rules.

URLs become sets of tokens: parts of the host, path segments, file endings, query keys. Token sets that are frequent
among blocked URLs are found level by level, over all tokens and at any size; those that imply "block" with enough
support and confidence become rules. A rule that holds a more general one of at least its confidence is
dropped, and sets that can give only such rules are not grown. Rules are matched by an inverted index: each is filed
under its rarest token, so a URL looks up only the rules of its own tokens; a table of rules, of any number, is matched
by a join on that token. Fixed allow and block rules on host and path come first.

Results in special cases: a URL that is NULL or has no ``://`` has an empty host and path, fits no
rule and is allowed unless a mined one matches; NULL labels are left out; without labelled or blocked URLs there
are no mined rules; repeated rows are judged alike; an empty table gives no row; other columns are ignored.
"""

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countersign.llm.shared import written

@dataclass(frozen=True)
class RuleSettings:
    min_support: int = 25
    min_confidence: float = 0.5


@dataclass(frozen=True)
class MinedRule:
    tokens: frozenset[str]
    confidence: float
    support: int


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    """Distinct tokens: host parts and suffixes, then path segments, ending, query keys."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        labels, lambda _, i: F.concat(F.lit("host:"), F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    )
    parts = F.transform(labels, lambda part: F.concat(F.lit("part:"), part))
    segments = F.transform(
        F.filter(F.split(path, "/"), lambda s: s != ""),
        lambda s: F.concat(F.lit("path:"), F.regexp_replace(F.lower(s), "[0-9]+", "#")),
    )
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})/?$", 1)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1)
    keys = F.transform(
        F.filter(F.split(query, "&"), lambda p: p != ""),
        lambda p: F.concat(F.lit("key:"), F.lower(F.substring_index(p, "=", 1))),
    )
    endings = F.when(ending != "", F.array(F.concat(F.lit("ending:"), F.lower(ending)))).otherwise(F.array().cast("array<string>"))
    return F.when(
        host != "", F.array_distinct(F.concat(suffixes, segments, parts, endings, keys))
    ).otherwise(F.array().cast("array<string>"))


def rule_table(labelled: DataFrame, settings: RuleSettings = RuleSettings()) -> DataFrame:
    """``tokens, confidence, support``: rules that imply a block, from ``url`` and ``blocked``, without redundant ones.

    Sets grow by one token a turn, over whole URLs. A set that is as frequent as one of its subsets, or that holds
    a subset of confidence 1, can only give redundant rules, and so can all that hold it: it is not grown.
    """
    known = labelled.filter("blocked IS NOT NULL").select(
        F.array_sort(tokens_of(F.col("url"))).alias("items"), F.col("blocked").cast("bigint").alias("hit")
    )
    baskets = written(known.groupBy("items").agg(F.count("*").alias("n"), F.sum("hit").alias("hits")), "baskets")
    least = min(settings.min_support, baskets.agg(F.sum("n")).first()[0] or 0)
    held = baskets.select(F.xxhash64("items").alias("basket"), F.md5(F.to_json("items")).alias("same"), "n", "hits", F.explode("items").alias("token"))
    held = held.select("basket", "same", "n", "hits", F.array("token").alias("tokens"))
    frequent = held.groupBy("tokens").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).filter(F.col("hits") >= max(least, 1))
    confidence = F.col("hits") / F.col("n")
    level = written(frequent.select("tokens", "n", confidence.alias("confidence"), F.col("hits").alias("support"), F.lit(0.0).alias("best")), "sets")
    rules, size = [], 1
    while not level.isEmpty():
        rules.append(level.filter((F.col("confidence") >= settings.min_confidence) & (F.col("confidence") > F.col("best"))))
        grown = level.filter("confidence < 1")
        held = written(held.join(grown.select("tokens"), "tokens", "left_semi"), "held")
        head = F.slice("tokens", 1, size - 1).alias("head")
        left = held.select("basket", "same", "n", "hits", head, F.element_at("tokens", -1).alias("last"))
        right = held.select("basket", "same", head, F.element_at("tokens", -1).alias("next"))
        pairs = left.join(right, ["basket", "same", "head"]).filter("last < next")
        size += 1
        held = pairs.select("basket", "same", "n", "hits", F.concat("head", F.array("last", "next")).alias("tokens"))
        counted = written(
            held.groupBy("tokens").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).filter(F.col("hits") >= max(least, 1)), "counted"
        )
        part = F.transform(
            F.sequence(F.lit(1), F.lit(size)),
            lambda i: F.concat(F.slice(F.col("tokens"), F.lit(1), i - 1), F.slice(F.col("tokens"), i + 1, F.lit(size))),
        )
        parts = counted.select(F.col("tokens").alias("whole"), "n", "hits", F.explode(part).alias("tokens"))
        within = grown.select("tokens", F.col("n").alias("part_n"), F.greatest("confidence", "best").alias("part_best"))
        checked = parts.join(within, "tokens").groupBy(F.col("whole").alias("tokens"), "n", "hits").agg(
            F.count("*").alias("parts"), F.min("part_n").alias("least_n"), F.max("part_best").alias("best")
        ).filter((F.col("parts") == size) & (F.col("least_n") > F.col("n")))
        level = written(checked.select("tokens", "n", confidence.alias("confidence"), F.col("hits").alias("support"), "best"), "sets")
    return reduce(DataFrame.unionByName, rules or [level]).select("tokens", "confidence", "support")


def mine_rules(labelled: DataFrame, settings: RuleSettings = RuleSettings()) -> list[MinedRule]:
    """The rules of ``rule_table`` on the driver, most confident first."""
    found = [MinedRule(frozenset(r.tokens), r.confidence, r.support) for r in rule_table(labelled, settings).collect()]
    return sorted(found, key=lambda r: (-r.confidence, len(r.tokens), sorted(r.tokens)))


def inverted_index(rules: list[MinedRule]) -> dict[str, list[MinedRule]]:
    """Rules by the token that the fewest rules have."""
    uses: dict[str, int] = {}
    for rule in rules:
        for token in rule.tokens:
            uses[token] = uses.get(token, 0) + 1
    index: dict[str, list[MinedRule]] = {}
    for rule in rules:
        index.setdefault(min(rule.tokens, key=lambda t: (uses[t], t)), []).append(rule)
    return index


def mined_confidence(tokens: Column, rules: list[MinedRule]) -> Column:
    """Confidence of the best rule that the tokens match, NULL if none does."""
    if not rules:
        return F.lit(None).cast("double")
    index = inverted_index(rules)

    @F.pandas_udf("double")
    def matched(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            best = []
            for listed in batch:
                have = set(listed)
                hits = (r.confidence for t in have & index.keys() for r in index[t] if r.tokens <= have)
                best.append(max(hits, default=None))
            yield pd.Series(best, dtype="float64")

    return matched(tokens)


def joined_confidence(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``url, confidence`` of the best rule that each distinct URL matches; URLs without one are left out."""
    uses = rules.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("uses"))
    numbered = rules.select("tokens", "confidence", F.explode("tokens").alias("token")).join(uses, "token")
    filed = numbered.groupBy("tokens", "confidence").agg(F.min(F.struct("uses", "token")).alias("rarest"))
    filed = filed.select(F.col("rarest.token").alias("token"), F.col("tokens").alias("needed"), "confidence")
    looked = pages.select("url").distinct().select("url", tokens_of(F.col("url")).alias("have"))
    looked = looked.select("url", "have", F.explode("have").alias("token"))
    hits = looked.join(filed, "token").filter(F.size(F.array_except("needed", "have")) == 0)
    return hits.groupBy("url").agg(F.max("confidence").alias("confidence"))


def fixed_rule(host: Column, path: Column, rules: Mapping[str, str]) -> Column:
    """``struct<rule, verdict>`` of the longest fixed rule that fits, else NULL."""
    found = None
    for rule, verdict in sorted(rules.items(), key=lambda r: (-len(r[0]), r[0])):
        rule_host, _, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rest)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found if found is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def judge(pages: DataFrame, mined: list[MinedRule] | DataFrame, fixed: Mapping[str, str]) -> DataFrame:
    """``page_id, host, path, rule, verdict, confidence`` per row; rules are a list or a table like ``rule_table``."""
    pages = pages.select("page_id", "url")
    if isinstance(mined, DataFrame):
        found = pages.join(joined_confidence(pages, mined), "url", "left")
    else:
        found = pages.withColumn("confidence", mined_confidence(tokens_of(F.col("url")), mined))
    described = found.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "confidence")
    ruled = described.withColumn("fixed", fixed_rule(F.col("host"), F.col("path"), fixed))
    own = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return ruled.select(
        "page_id", "host", "path", F.col("fixed.rule").alias("rule"),
        F.coalesce("fixed.verdict", own).alias("verdict"), "confidence",
    )
