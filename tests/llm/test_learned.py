"""Classifiers, neighbours, near duplicates, packing, URL rules, against brute force."""

import itertools
import random
import zlib
from collections import Counter, defaultdict
from unittest.mock import MagicMock

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from countersign.llm import ann, near_dedup, packing, quality, shared, toxicity, urls
from countersign.llm.queries import FIXED_RULES, op2_ann_forest, op8_packing, op9_near_dedup, op10_url_rules
from countersign.llm.shared import marked
from countersign.llm.shared import in_fold

DATA = "/root/testdata/sf0.001"


def test_folds(spark):
    rows = spark.createDataFrame([(7,), (123456,), (None,)], "doc_id bigint")
    got = [r[0] for r in rows.select(in_fold(F.col("doc_id"), 3, 1)).collect()]
    assert got == [zlib.crc32(t) % 3 == 1 for t in (b"7", b"123456", b"")]


def test_toxicity_from_positives_and_unlabelled(spark, odd_docs):
    rng = random.Random(5)
    rows = []
    for i in range(1200):
        words = [f"w{rng.randrange(300)}" for _ in range(60)]
        words = ["".join(chr(97 + int(c)) for c in w[1:]) + "x" for w in words]
        if i % 5 == 0:
            words[rng.randrange(60)] = rng.choice(["vile", "nasty", "rotten"])
        rows.append((i, " ".join(words), i % 5 == 0))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic boolean")
    known = docs.filter("toxic AND doc_id % 2 = 0")
    model = toxicity.train_pu(docs, known, docs.filter("doc_id % 3 <> 1"), 0.2)
    scored = docs.select("doc_id", "toxic", toxicity.toxicity(F.col("text"), model).alias("s")).collect()
    hidden = [r.s for r in scored if r.toxic and r.doc_id % 2]
    assert np.mean([s >= 0.7 for s in hidden]) > 0.9
    assert np.mean([r.s >= 0.7 for r in scored if not r.toxic]) < 0.02
    odd = [r[0] for r in odd_docs.select(toxicity.toxicity(F.col("text"), model)).collect()]
    assert all(0 <= s <= 1 for s in odd) and odd[0] == odd[1]
    nothing = toxicity.train_pu(docs, known.limit(0), docs, 0.2)
    assert abs(nothing.score("vile") - 0.2) < 1e-9
    assert toxicity.train_pu(odd_docs, odd_docs, odd_docs.limit(0), 0.1).words == {}


def test_trees_against_plain_walk(spark, odd_docs):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, len(quality.STATISTICS)))
    y = ((x[:, 3] > 0.3) ^ (x[:, 7] < -0.5)).astype(float)
    trees = quality.boost(x, y)
    scores = trees.score(x)
    assert ((scores > 0.5) == y).mean() > 0.97
    for row, score in zip(x[:20], scores):
        logit = trees.base
        for root in trees.roots:
            node = root
            while trees.left[node] != node:
                node = trees.left[node] if row[trees.statistic[node]] <= trees.threshold[node] else trees.right[node]
            logit += trees.value[node]
        assert abs(1 / (1 + np.exp(-logit)) - score) < 1e-12
    assert quality.boost(x[:0], y[:0]).score(x[:2]).tolist() == [0.5, 0.5]
    odd = odd_docs.select(quality.quality(F.col("text"), trees)).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r[0] <= 1 for r in odd)


def test_quality_learns_from_labels(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{n}.parquet") for n in ("documents", "labels"))
    trees = quality.train_quality(docs, labels)
    scored = docs.join(labels, "doc_id").select("quality", quality.quality(F.col("text"), trees).alias("s")).collect()
    assert np.mean([(r.s >= 0.5) == (r.quality == 1) for r in scored]) > 0.95
    assert quality.train_quality(docs.limit(0), labels.limit(0)).score(np.zeros((1, 20)))[0] == 0.5


def test_neighbours_against_all(spark, rows_of):
    rows = sorted(rows_of("embeddings", "vec_id, embedding"))
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    got = defaultdict(list)
    for r in op2_ann_forest(spark, DATA).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    hits = 0
    for k in np.flatnonzero(ids % 20 == 0):
        scores = (x * x[k]).sum(axis=1)
        best = [int(i) for i in sorted(ids, key=lambda i: (-scores[np.searchsorted(ids, i)], i)) if i != ids[k]][:20]
        found = got[int(ids[k])]
        hits += len({i for i, _ in found} & set(best))
        assert all(abs(s - scores[np.searchsorted(ids, i)]) < 1e-12 for i, s in found)
    assert hits >= 0.9 * 20 * len(got) and len(got) == (ids % 20 == 0).sum()


def test_neighbours_of_odd_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(30)] + [
        (30, None), (31, []), (32, [0.0, 0.0]), (33, [1.0, None]), (34, [1.0, float("nan")]), (35, [float("inf"), 0.0]),
        (36, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (40, [5.0, 9.0]), (40, [5.0, 9.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit(1))
    got = defaultdict(list)
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert got == {0: [40, 1, 2, 3, 4], 20: [40, 0, 1, 2, 3], 40: [0, 1, 2, 3, 4]}
    assert ann.nearest(df.limit(0), F.col("vec_id") == 0).count() == 0


def shingle_sets(rows, width):
    out = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        k = min(width, len(words))
        out[i] = frozenset(tuple(words[j : j + k]) for j in range(len(words) - k + 1)) if words else frozenset()
    return out


def groups_by_hand(sets):
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


def test_near_groups_against_all_pairs(spark, rows_of):
    sets = shingle_sets(rows_of("documents", "doc_id, text"), 2)
    want = groups_by_hand(sets)
    got = {r.doc_id: r for r in op9_near_dedup(spark, DATA).collect()}
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(sets[i]), want[i], want[i] == i) for i in sets}


def test_near_groups_around_edited_copies(spark, odd_docs):
    """Copies of one text with own edits, whose links run through the original; chains; odd rows."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = [(500, " ".join(base))]
    for i in range(60):
        words = list(base)
        for at in rng.sample(range(120), 5):
            words[at] = f"x{i}.{at}"
        rows.append((i, " ".join(words)))
    rows += [(600 + i, " ".join(f"c{j}" for j in range(4 * i, 4 * i + 60))) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    settings = near_dedup.NearSettings(shingle=2)
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(df, settings).collect()}
    assert got == groups_by_hand(shingle_sets(rows, 2))
    odd = near_dedup.near_groups(odd_docs).collect()
    assert len(odd) == odd_docs.count()
    assert [r.component_id for r in odd if r.doc_id in (4, 5)] == [4, 4, 4]
    assert {r.component_id for r in odd if r.doc_id in (6, 7)} == {6}
    assert all(r.kept and r.component_id is None for r in odd if r.doc_id is None)
    assert all(r.n_shingles == 0 for r in odd if r.doc_id in (1, 2, 8))
    assert near_dedup.near_groups(odd_docs.limit(0)).count() == 0


def test_pairs_are_made_in_one_bucket(spark, monkeypatch):
    """A chain whose neighbours share many buckets: the rows that leave the join of a bucket are no pair twice."""
    rows = [(i, " ".join(f"c{j}" for j in range(4 * i, 4 * i + 60))) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    made, keep = [], near_dedup._candidates

    def counted(*args):
        with monkeypatch.context() as patch:
            patch.setattr(type(df), "distinct", lambda self: self)
            found = keep(*args)
        made.append((found.count(), found.distinct().count()))
        return found.distinct()

    monkeypatch.setattr(near_dedup, "_candidates", counted)
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(df, near_dedup.NearSettings(shingle=2)).collect()}
    assert got == groups_by_hand(shingle_sets(rows, 2))
    assert made[0][1] > 0 and all(rows_made == pairs for rows_made, pairs in made)


def test_links_of_buckets_beyond_the_centres(spark, rows_of, monkeypatch):
    """With two centres a bucket in the second turn, pairs wait for later turns; none is lost."""
    monkeypatch.setattr(near_dedup, "CENTRES", 2)
    drawn = random.Random(12)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(60):
        words = list(base)
        for at in drawn.sample(range(100), drawn.randrange(2, 8)):
            words[at] = f"x{i}.{at}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(df, near_dedup.NearSettings(shingle=2)).collect()}
    assert got == groups_by_hand(shingle_sets(rows, 2))


def test_routes_do_not_repeat_vectors_in_python(spark):
    """A query that visits 400 leaves is one row of what the task returns."""
    drawn = np.random.default_rng(5)
    x = drawn.standard_normal((2000, 8))
    forest = ann.grow_forest(x, float(np.sqrt((x**2).sum(axis=1)).max()), ann.ForestSettings(leaf_rows=4))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "first_id bigint, vec array<double>").coalesce(1)
    rows = ann._leaves_of(df, forest, 400).collect()
    assert len(rows) == 2000 and [r.first_id for r in rows] == list(range(2000))
    assert all(r.leaves == forest.visited(x[r.first_id], 400) and r.vec == x[r.first_id].tolist() for r in rows[1000:1050])
    leaves = forest.leaves(x)
    found = ann._leaves_of(df, forest, None).collect()
    # A vector of the sample may lie on a plane, so that rounding tells its side.
    assert sum(r.leaves == leaves[r.first_id].tolist() for r in found) > 1900 and all(len(r.leaves) == 10 for r in found)


def test_neighbours_among_many_ties(spark):
    """3,000 vectors of the same product with every query: the smallest ids are found."""
    rows = [(i, [1.0, float(i % 7 + 1), float(i)] if i % 50 else [1.0, 0.0, 0.0]) for i in range(1, 3001)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = defaultdict(list)
    settings = ann.ForestSettings(trees=1, leaf_rows=5000)
    for r in ann.nearest(df, F.col("vec_id") % 1000 == 0, 5, settings).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert got == {i: [(j, 1.0) for j in range(1, 6)] for i in (1000, 2000, 3000)}


def test_a_worker_knows_few_words(spark, monkeypatch):
    """However many different words there are, few are kept and few are in a call of the tokenizer."""
    import sys

    import pyarrow as pa
    import tokenizers

    calls = []

    class Spied:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        @classmethod
        def from_str(cls, text):
            return cls(Tokenizer.from_str(text))

        def encode_batch(self, texts, **more):
            calls.append(sum(t.count(" ") + 1 for t in texts))
            return self.tokenizer.encode_batch(texts, **more)

        def encode_batch_fast(self, texts, **more):
            calls.append(len(texts))
            return self.tokenizer.encode_batch_fast(texts, **more)

    docs = spark.createDataFrame([], "doc_id bigint, text string")
    tasks = []
    monkeypatch.setattr(tokenizers, "Tokenizer", Spied)
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, task, schema: tasks.append(task))
    monkeypatch.setitem(sys.modules, packing.STORE, type(sys)(packing.STORE))
    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "false")
    packing.token_pieces(docs)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(w) for w in itertools.islice(itertools.product(letters, repeat=5), 420_000)]
    texts = [" ".join([*words[i : i + 1000], f"{i}x"]) for i in range(0, len(words), 1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    pieces = [r for out in tasks[0]([batch]) for r in out.to_pylist()]
    assert {r["doc_id"] for r in pieces} == set(range(len(texts)))
    (_, known), = (v for v in sys.modules[packing.STORE].__dict__.values() if isinstance(v, tuple))
    assert max(calls) <= 2_000 and len(known) < 500_000


def tokenizing_task(monkeypatch):
    """What a worker runs on batches, with a store of words of its own."""
    import sys

    class Docs:
        def select(self, *columns):
            return self

        def mapInArrow(self, task, schema):
            return task

    monkeypatch.setattr(packing, "F", MagicMock())
    monkeypatch.setitem(sys.modules, packing.STORE, type(sys)(packing.STORE))
    return packing.token_pieces(Docs()), sys.modules[packing.STORE].__dict__


def lettered(n):
    return ["".join(w) for w in itertools.islice(itertools.product("abcdefghijklmnopqrstuvwxyz", repeat=4), n)]


def docs_batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])


def test_a_worker_keeps_words_that_a_chunk_repeats(monkeypatch):
    """Words met once, most of all different ones, take no lasting memory."""
    task, store = tokenizing_task(monkeypatch)
    words = lettered(20_000)
    list(task([docs_batch([" ".join(words), " ".join(words[:100])])]))
    (_, known), = (v for v in store.values() if isinstance(v, tuple))
    assert set(known) == {"", *words[:100]}


def test_separable_texts_have_the_same_ids():
    """Every letter with case, composed and with a mark; letters beyond ASCII are lowered too."""
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    cased = [c for c in map(chr, range(0x80, 0x1E950)) if not 0xD800 <= ord(c) < 0xE000 and c.lower() != c.upper()]
    marks = "\u0300\u0301\u0308\u030a\u030c\u0331\u0345"
    texts = [f"A{c}É b{c}! {c}Z {c}" for c in cased] + [f"{c}{m}Z" for c in [*cased, *"AHIJTWYahijtwy"] for m in marks]
    told = packing.separable(pa.array(texts)).to_pylist()
    for text, other in zip(tokenizer.encode_batch_fast(texts), tokenizer.encode_batch_fast(told)):
        assert text.ids == other.ids
    assert packing.separable(pa.array(["Über Ärger, Été."])).to_pylist() == ["über ärger , été ."]


def test_words_beyond_the_store_cost_no_python_call_each(monkeypatch):
    """Every word's ids are whole when the store has no room, without a Python function called for each."""
    import sys

    task, _ = tokenizing_task(monkeypatch)
    monkeypatch.setattr(packing, "CACHED_WORDS", 0)
    texts = [" ".join(lettered(20_000)), "4a! b"]
    list(task([docs_batch(["warm"])]))
    calls = Counter()
    sys.setprofile(lambda frame, event, arg: calls.update([event]) if event == "call" else None)
    try:
        out = list(task([docs_batch(texts)]))
    finally:
        sys.setprofile(None)
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    for doc, text in enumerate(texts):
        ids = b"".join(r["ids"] for o in out for r in o.to_pylist() if r["doc_id"] == doc)
        assert np.frombuffer(ids, "<u4").tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
    assert calls["call"] < 10_000


def test_scores_of_few_texts_at_a_time(spark):
    class Few(quality.FlatTrees):
        def score(self, x):
            assert len(x) <= 512
            return super().score(x)

    rng = np.random.default_rng(4)
    grown = quality.boost(rng.random((300, 20)), rng.integers(0, 2, 300).astype(float))
    docs = spark.createDataFrame([(i, None if i % 9 == 0 else f"Some text {i}. " * (i % 7)) for i in range(1500)], "i int, text string").coalesce(1)
    found = {r.i: r.s for r in docs.select("i", quality.quality(docs["text"], Few(**vars(grown))).alias("s")).collect()}
    texts = {r.i: r.text for r in docs.collect()}
    stats = np.array([quality.statistics(texts[i]) for i in range(1500)])
    assert [found[i] for i in range(1500)] == grown.score(stats).tolist()


def test_overlap_is_read_from_arrow():
    sets = [np.array(s, np.uint64).tobytes() for s in ([1, 2, 3], [2, 3, 4, 5], [9])]
    left, right = pa.array(sets, pa.binary()), pa.array(sets[1:] + sets[:1], pa.binary())
    assert near_dedup.common.func(left, right).to_pylist() == [2, 0, 0]


def test_free_memory_goes_back_after_a_task(monkeypatch):
    seen, pool = [], MagicMock()
    pool.default_memory_pool.return_value.release_unused.side_effect = lambda: seen.append("released")
    monkeypatch.setattr(shared, "pa", pool)
    for out in shared.tidy(lambda batches: (2 * b for b in batches))([1, 2]):
        seen.append(out)
    assert seen == [2, 4, "released"]


def test_pieces_against_the_tokenizer(spark, rows_of, odd_docs):
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    texts = dict(rows_of("documents", "doc_id, text"))
    tricky = "<|endoftext|> it's I'LL don't, A.B., ÀÉ\u0301 \u0130 ΣΑΣ Σ, x\u00a0y\u2028z 12.5,\t\r\n«q» a\u0301 \u0301b"
    got = defaultdict(list)
    for r in op8_packing(spark, DATA).collect():
        got[r.doc_id].append(r)
    extra = spark.createDataFrame([(1, tricky)], "doc_id bigint, text string")
    pieces = packing.token_pieces(extra).collect()
    ids = [*tokenizer.encode(tricky, add_special_tokens=False).ids, 1]
    assert [int(i) for p in pieces for i in np.frombuffer(p.ids, "<u4")] == ids
    fill = Counter()
    for doc, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(got[doc], key=lambda r: r.start):
            part = np.array(ids[r.start : r.start + r.length], "<u4")
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += r.length
            fill[r.sequence_id] += r.length
        assert at == len(ids)
    by_sequence = defaultdict(list)
    for rows in got.values():
        for r in rows:
            by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    odd = packing.pack(odd_docs).collect()
    assert Counter(r.doc_id for r in odd if r.start == 0)[4] == 2 and sum(r.doc_id is None for r in odd) == 2
    assert packing.pack(odd_docs.limit(0)).count() == 0


def test_shortest_pack_first():
    rng = random.Random(2)
    histogram = Counter(rng.randrange(1, 2049) for _ in range(5000))
    found = packing.patterns(dict(histogram))
    placed = Counter()
    for content, count in found:
        assert sum(content) <= 2048
        for length in content:
            placed[length] += count
    assert placed == histogram
    sequences = sum(count for _, count in found)
    assert sum(k * v for k, v in histogram.items()) > 0.97 * 2048 * sequences


def test_urls_against_the_contract(spark, rows_of):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def split(url):
        if url is None or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = rest[:end].translate(lower), rest[end:]
        return host, rest[: min((rest.index(c) for c in "?#" if c in rest), default=len(rest))]

    rows = rows_of("pages", "page_id, url")
    odd = [(-1, None), (-2, "no scheme"), (-3, "https://EXAMPLE.com"), (-4, "a://b://c.net/es/x"), (-5, "x://net/es/"), (-6, "x://notnet/es/")]
    extra = spark.createDataFrame(odd, "page_id bigint, url string").withColumn("rule", F.lit(1))
    judged = op10_url_rules(spark, DATA).collect() + urls.judge(extra, [], FIXED_RULES).collect()
    got = {r.page_id: r for r in judged}
    assert len(judged) == len(rows) + len(odd)
    for page, url in [*rows, *odd]:
        host, path = split(url)
        fits = [
            r for r in FIXED_RULES
            if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])
        ]
        rule = max(fits, key=len, default=None)
        row = got[page]
        assert (row.host, row.path, row.rule) == (host, path, rule)
        if rule:
            assert row.verdict == FIXED_RULES[rule]


def test_mined_rules(spark):
    rng = random.Random(4)
    rows = []
    for i in range(3000):
        site, section = rng.choice(["aa", "bb", "cc"]), rng.choice(["casino", "news", "blog"])
        bad = section == "casino" and site == "aa"
        rows.append((f"http://{site}.org/{section}/{i}?id={i}", bad or rng.random() < 0.02))
    labelled = spark.createDataFrame(rows, "url string, blocked boolean")
    rules = urls.mine_rules(labelled, urls.RuleSettings(min_support=30, min_confidence=0.6))
    assert rules and all(r.support >= 30 and r.confidence >= 0.6 for r in rules)
    for rule in rules:  # counted by hand
        have = labelled.withColumn("t", urls.tokens_of(F.col("url")))
        have = have.filter(" AND ".join(f"array_contains(t, '{t}')" for t in rule.tokens))
        assert (have.filter("blocked").count(), have.count()) == (rule.support, round(rule.support / rule.confidence))
    assert not any(a is not b and a.tokens <= b.tokens and a.confidence >= b.confidence for a in rules for b in rules)
    pages = spark.createDataFrame([(1, "http://aa.org/casino/9"), (2, "http://bb.org/casino/9")], "page_id bigint, url string")
    assert {r.page_id: r.verdict for r in urls.judge(pages, rules, {}).collect()} == {1: "block", 2: "allow"}
    assert urls.mine_rules(labelled.limit(0)) == []


def late_and_hot(spark):
    """URLs of more than twelve tokens that only their last keys tell apart, and one spam host."""
    long_url = "http://a{0}.b.c.d{0}.org/p/q/r/s{1}/x.php?id=1&bad{2}=1"
    rows = [(long_url.format("x" * (i % 3), "z" * (i % 5), "" if i % 2 else "good"), i % 2 == 1) for i in range(400)]
    rows += [("http://spam.one.two.three.net/" + "/".join(f"seg{c}" for c in "abcdefgh") + "?k=1&l=2&m=3", True)] * 60
    return long_url, spark.createDataFrame(rows, "url string, blocked boolean")


def test_rules_on_late_tokens(spark):
    """Keys after twelve other tokens are mined; a hot host of many tokens gives no redundant rules."""
    _, labelled = late_and_hot(spark)
    rules = {r.tokens: r.confidence for r in urls.mine_rules(labelled, urls.RuleSettings(min_support=30, min_confidence=0.6))}
    assert rules[frozenset(["key:bad"])] == 1.0 and rules[frozenset(["path:sega"])] == 1.0
    assert all(len(r) == 1 for r in rules if any(t.startswith("path:seg") for t in r))
    assert not any(a < b and rules[a] >= rules[b] for a in rules for b in rules)


def test_rules_matched_by_a_join(spark):
    """A table of rules gives the verdicts of the listed ones."""
    long_url, labelled = late_and_hot(spark)
    settings = urls.RuleSettings(min_support=30, min_confidence=0.6)
    table = urls.rule_table(labelled, settings).cache()
    pages = spark.createDataFrame([
        (1, long_url.format("n", "n", "")), (1, long_url.format("n", "n", "")), (2, long_url.format("n", "n", "good")),
        (None, None), (3, "http://spam.one.two.three.net/new"),
    ], "page_id bigint, url string")
    listed = urls.mine_rules(labelled, settings)
    want = sorted(map(str, urls.judge(pages, listed, {}).collect()))
    got = urls.judge(pages, table, {}).collect()
    assert sorted(map(str, got)) == want
    assert sorted((r.page_id or 0, r.verdict) for r in got) == [(0, "allow"), (1, "block"), (1, "block"), (2, "allow"), (3, "block")]


def test_bitmaps_never_rule_out_a_link():
    drawn = random.Random(4)
    for _ in range(300):
        both = [drawn.getrandbits(64) for _ in range(drawn.randrange(1, 600))]
        own = [[drawn.getrandbits(64) for _ in range(drawn.randrange(0, 1 + len(both) // 6))] for _ in range(2)]
        sets = [np.unique(np.array(both + extra, np.uint64)) for extra in own]
        differ = len(set(sets[0].tolist()) ^ set(sets[1].tolist()))
        a, b = (near_dedup.parity(s).view(np.uint64) for s in sets)
        seen = sum(int(x).bit_count() for x in (a ^ b).tolist())
        assert seen <= differ
        common = len(set(sets[0].tolist()) & set(sets[1].tolist()))
        if 100 * common >= 80 * (differ + common):
            assert seen * 180 <= (len(sets[0]) + len(sets[1])) * 20


def test_a_large_group_that_is_not_similar_enough_makes_few_pairs(spark, monkeypatch):
    """300 texts, any two of which share 0.65 to 0.79 of their shingles: 44,850 pairs, no link."""
    drawn = random.Random(8)
    original = [f"w{i}" for i in range(300)]
    texts = []
    for number in range(300):
        words = list(original)
        for place in drawn.sample(range(300), 12):
            words[place] = f"own{number}x{place}"
        texts.append((number, " ".join(words)))
    sets = [set(zip(w := t.split(), w[1:])) for _, t in texts]
    likeness = [len(a & b) / len(a | b) for a, b in itertools.combinations(sets, 2)]
    assert 0.65 < min(likeness) and max(likeness) < 0.8
    pairs = []
    keep = near_dedup.written

    def counted(df, purpose):
        out = keep(df, purpose)
        if purpose == "pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "written", counted)
    found = near_dedup.near_groups(spark.createDataFrame(texts, "doc_id bigint, text string"), near_dedup.NearSettings(shingle=2)).collect()
    assert all(r.kept for r in found) and len(found) == 300
    assert sum(pairs) < 300 * 299 / 2 / 20


def test_large_buckets_take_few_turns(spark, monkeypatch):
    """150 texts with like shingles and no link: all pairs are made in the second turn, and links between them are found."""
    drawn = random.Random(11)
    original = [f"w{i}" for i in range(200)]
    texts = []
    for number in range(150):
        words = list(original)
        for place in drawn.sample(range(200), 9):
            words[place] = f"own{number}x{place}"
        texts.append((number, " ".join(words)))
    texts += [(1000 + number, f"{text} end") for number, text in texts[:40]]
    turns = []
    keep = near_dedup.written
    monkeypatch.setattr(near_dedup, "written", lambda df, purpose: turns.append(purpose) or keep(df, purpose))
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(df, near_dedup.NearSettings(shingle=2)).collect()}
    assert got == groups_by_hand(shingle_sets(texts, 2))
    assert turns.count("pairs") <= 2


def test_marked_keys_miss_none(spark):
    among = spark.range(0, 3000, 3).selectExpr("if(id = 9, NULL, id) AS k")
    df = spark.range(20_000).selectExpr("cast(if(id = 5, NULL, id) AS int) AS bits", "id AS bits_word")
    told = marked(df, "bits", among, "may be")
    assert told.columns == ["bits", "bits_word", "may be"] and "SortMergeJoin" not in told._jdf.queryExecution().toString()
    rows = told.collect()
    assert len(rows) == 20_000 and all(r["may be"] for r in rows if r.bits is not None and r.bits < 3000 and r.bits % 3 == 0 and r.bits != 9)
    assert sum(r["may be"] for r in rows) < 1_020
    assert marked(df, "bits", among.limit(0), "f").filter("f").isEmpty()
