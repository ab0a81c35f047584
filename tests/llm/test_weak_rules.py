"""Rules weighed by expectation-maximisation: counts against plain Python, estimates against known votes, the query against SQL."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from countersign.llm import oracle
from countersign.llm.queries import op12_weak_rules
from countersign.llm.weak_rules import COUNTS, RULES, Counter, Rule, estimated, fitted, judged, statistics
from tests.compare_engines import problem

DATA = "/root/testdata/sf0.001"


def plain_counts(text: str) -> dict[str, int]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": sum(line in lines[:i] for i, line in enumerate(lines)), "n_repeat_words": len(again),
        "n_lines": len(lines), "n_distinct": len(set(words)), "n_short": sum(len(w) <= 3 for w in words),
        "n_lettered": sum(any(c.isalpha() for c in w) for w in words),
    }


@settings(max_examples=300, deadline=None)
@given(st.one_of(
    st.text(max_size=80), st.lists(st.sampled_from(["a", "b", "aa", "#", "\n", " ", "\x0b", " ", "é|", " ", "\x85"]), max_size=60).map(" ".join),
))
def test_counts_of_any_text(text):
    found = dict(zip(COUNTS, Counter().counts(text.encode("utf-8", "ignore"))))
    for name, n in plain_counts(text.encode("utf-8", "ignore").decode()).items():
        assert found[name] == n, name


def test_query_against_sql(spark):
    assert problem(spark, DATA, op12_weak_rules, oracle.weak_rules()) is None


def test_judged_without_labels_agrees_with_them(spark, rows_of):
    quality = dict(rows_of("labels", "doc_id, quality"))
    rows = [r for r in op12_weak_rules(spark, DATA).collect() if r.doc_id in quality and not r.base_failed]
    good, bad = ([r.kept for r in rows if quality[r.doc_id] == q] for q in (1, 0))
    assert good and bad and sum(good) >= 0.99 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_estimates_find_the_rules_that_votes_came_from():
    drawn = random.Random(3)
    rules = [Rule(f"r{i}", "", "") for i in range(6)]
    # Probability of bad, none, good for bad and for good texts; the last rule knows nothing.
    tables = [((0.7, 0.2, 0.1), (0.03, 0.17, 0.8))] * 5 + [((0.2, 0.3, 0.5), (0.2, 0.3, 0.5))]
    patterns = {}
    for _ in range(40_000):
        good = drawn.random() < 0.9
        votes = tuple(drawn.choices((-1, 0, 1), t[good])[0] for t in tables)
        patterns[votes] = patterns.get(votes, 0) + 1
    model = estimated(list(patterns), list(patterns.values()), rules)
    assert model.good == pytest.approx(0.9, abs=0.01)
    for rule, table in enumerate(tables):
        for kind in (0, 1):
            assert model.tables[kind][rule] == pytest.approx(table[kind], abs=0.03)
    right = model.accuracies()
    assert right["r0"] == pytest.approx((0.7 / 0.8, 0.8 / 0.83), abs=0.02)
    assert abs(model.weight(5, -1)) < 0.1 < abs(model.weight(0, -1))
    # One broken rule of a few does not make a text bad, as all-must-pass filtering would have it.
    odds = sum(model.weight(r, 1) for r in range(1, 6)) + model.weight(0, -1)
    assert odds > 0 > sum(model.weight(r, -1) for r in range(4)) + 2.2


def test_estimates_do_not_fall_over_rounds():
    patterns, counts = [(1, 1), (1, -1), (-1, -1), (0, 1)], [50, 5, 8, 3]
    a, b = (estimated(patterns, counts, RULES[:2], rounds) for rounds in (50, 51))
    assert a.good == pytest.approx(b.good, abs=1e-3)
    none = estimated([], [], RULES)
    assert none.good == pytest.approx(0.8) and all(sum(row) == pytest.approx(1) for t in none.tables for row in t)


def test_odd_documents(spark, odd_docs):
    rows, model = judged(odd_docs.withColumn("n_words", odd_docs["component"]))
    found = rows.collect()
    assert sorted((r.doc_id or 0) for r in found) == sorted((r.doc_id or 0) for r in odd_docs.select("doc_id").collect())
    assert all(0 <= r.quality <= 1 for r in found)
    by_id = {r.doc_id: r for r in found}
    for empty in (1, 2, 8):
        assert by_id[empty].n_words == 0 and all(by_id[empty][f"vote_{rule.name}"] == 0 for rule in RULES)
    assert by_id[6].n_words == 60_000 and by_id[6].n_repeat_words == 60_000 and by_id[9].n_lettered == 5
    again = {r.quality for r in found if r.doc_id in (4, 5)}
    assert len(again) == 1  # equal texts are judged alike
    assert judged(odd_docs.limit(0))[0].count() == 0 and statistics(odd_docs.limit(0)).count() == 0


def test_no_more_rules_than_patterns_can_be_counted(spark, odd_docs):
    with pytest.raises(ValueError, match="11 rules"):
        fitted(odd_docs, [Rule(f"r{i}", "true", "true") for i in range(11)])
