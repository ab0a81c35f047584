"""Near duplicates by one-permutation MinHash.

A text's shingles are hashed once; the upper bits of a hash name its bin, and each bin keeps its
smallest hash. Empty bins borrow from bins drawn by a hash of their own number and the attempt (optimal
densification), alike in all texts. ``rows`` bins make a band; texts with an equal band share a bucket.

Within a bucket not all pairs are made, but stars: members are compared with a centre, at first the
one that shares buckets with most texts, as the original of a group of edited copies does. Candidates are
checked by the exact overlap of their full shingle sets. Texts linked so far are one component; a bucket
whose members all belong to one needs no further work. Others go on with other centres, against
members of other components only: in the first turn each text takes one centre, then all of its
buckets' centres, some 2,048 a bucket and four times as many with every turn, until no bucket has a pair left that is
neither compared nor connected. Two texts that share several buckets are a candidate in the smallest of them alone. So no link between texts of one bucket is lost, and large groups of near copies, whose
members join their first centres, take about one comparison each. Large groups whose members are just not similar
enough are what costs: there the pairs grow with the square of the group.

Texts of equal sets are one before anything else: they are represented by the smallest id and never paired.

Two texts of similarity s share a bucket with probability 1 - (1 - s^rows)^bands: with the default
bands that is above 0.99999 at 0.8.

Results in special cases: NULL and empty texts and those without words have an empty set and are
linked with nothing; fewer words than a shingle has make one shingle; rows without an id are linked
with nothing and kept, with a NULL component; rows that repeat an id have the smallest component
of its texts; an empty table gives no row; other columns are ignored.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countersign.llm.shared import marked, tidy, written


@dataclass(frozen=True)
class NearSettings:
    shingle: int = 5
    similarity: int = 80  # per cent
    bands: int = 40
    rows: int = 5
    seed: int = 9
    known_words: int = 100_000

    @property
    def bins(self) -> int:
        return self.bands * self.rows


class Shingler:
    """Sorted 64-bit hashes of a text's distinct shingles."""

    def __init__(self, settings: NearSettings):
        self.settings, self.known = settings, {}

    def hashes(self, text: str | None) -> np.ndarray:
        # bytes.lower() changes A-Z alone; bytes.split() cuts at the blank and at 0x09 to 0x0D.
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > self.settings.known_words:
            self.known.clear()
        known, out = self.known, []
        for word in words:
            value = known.get(word)
            if value is None:
                value = known[word] = xxhash.xxh3_64_intdigest(word, self.settings.seed)
            out.append(value)
        single = np.array(out, np.uint64)
        width = min(self.settings.shingle, len(words))
        n = len(words) - width + 1
        mixed = np.full(n, width, np.uint64)
        for j in range(width):
            mixed = _mixed(mixed + single[j : j + n])
        return np.unique(mixed)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (multiply and shift, three times)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)


class Sketcher:
    """Smallest hash of each bin, densified, cut into bands."""

    def __init__(self, settings: NearSettings):
        self.settings, bins = settings, settings.bins
        self.starts = np.array([-(-(i << 64) // bins) for i in range(bins)], np.uint64)
        tries = np.arange(bins * 64, dtype=np.uint64).reshape(64, bins) + np.uint64(settings.seed << 32)
        self.donors = (_mixed(tries) % np.uint64(bins)).astype(int)

    def bands(self, hashes: np.ndarray) -> np.ndarray:
        bins = self.settings.bins
        first = np.searchsorted(hashes, self.starts)
        filled = np.append(first[1:], len(hashes)) > first
        donor = np.where(filled, np.arange(bins), -1)
        turn = 0
        while (open_bins := np.flatnonzero(donor < 0)).size:
            # Beyond the drawn attempts: one bin after the other, so that it ends.
            drawn = self.donors[turn, open_bins] if turn < 64 else (open_bins + turn - 63) % bins
            donor[open_bins] = np.where(filled[drawn], drawn, -1)
            turn += 1
        values = hashes[first[donor]].reshape(self.settings.bands, self.settings.rows)
        out = np.arange(self.settings.bands, dtype=np.uint64)
        for j in range(self.settings.rows):
            out = _mixed(out + values[:, j])
        return out.view(np.int64)


#: Centres of a bucket in the second turn: a smaller bucket has all of its pairs made there.
CENTRES = 2048

SKETCH = "doc_id bigint, n_shingles bigint, content string, bands array<bigint>"


def sketches(docs: DataFrame, settings: NearSettings) -> DataFrame:
    """``doc_id, n_shingles, content, bands``; ``content`` is 128 bits of the whole set, NULL if empty."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("content", pa.string()), ("bands", pa.list_(pa.int64())),
    ])

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, sketcher = Shingler(settings), Sketcher(settings)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = [shingler.hashes(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets], pa.string()),
                    pa.array([sketcher.bands(s) if len(s) else [] for s in sets], pa.list_(pa.int64())),
                ], schema=schema)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(tidy(sketched), SKETCH)


#: 64-bit words of a set's bitmap.
PARITY = [f"p{i}" for i in range(16)]


def parity(hashes: np.ndarray) -> np.ndarray:
    """Of the hashes at each place (their lowest bits), is the number odd? As 64-bit words."""
    places = len(PARITY) * 64
    odd = np.bincount((hashes & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def shingle_sets(docs: DataFrame, settings: NearSettings) -> DataFrame:
    """``doc_id, n, hashes`` and the bitmap: the full set as sorted 64-bit numbers in one binary value, and its size."""
    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(settings)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = [shingler.hashes(t) for t in part.column("text").to_pylist()]
                words = np.array([parity(s) for s in sets])
                sizes, full_sets = pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), sizes, full_sets, *(pa.array(w) for w in words.T)],
                    names=["doc_id", "n", "hashes", *PARITY],
                )

    types = "doc_id bigint, n bigint, hashes binary, " + ", ".join(f"{p} bigint" for p in PARITY)
    return docs.select("doc_id", "text").mapInArrow(tidy(full), types)


@F.arrow_udf(T.LongType())
def common(left: pa.Array, right: pa.Array) -> pa.Array:
    """Size of the intersection of two sets of hashes, read where Arrow has them: copies of a batch's sets would fill a worker."""
    sizes = []
    for a, b in zip(left, right):
        a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
        if len(a) > len(b):
            a, b = b, a
        at = np.minimum(np.searchsorted(b, a), len(b) - 1)
        sizes.append(int((b[at] == a).sum()))
    return pa.array(sizes, pa.int64())


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable over the links (``a, b``).

    Every node points at the smallest label among itself and its neighbours, then labels are followed to
    where they point, so chains shrink by halves. Each round is a written table, of a few files a core: its rows are short.
    """
    files = 4 * nodes.sparkSession.sparkContext.defaultParallelism
    edges = written(links.select("a", "b").union(links.select("b", "a")).distinct().coalesce(files), "edges")
    labels = written(nodes.select("node", F.col("node").alias("component")).coalesce(files), "labels")
    while True:
        least = (
            edges.join(labels, edges["b"] == labels["node"])
            .groupBy("a").agg(F.min("component").alias("least"))
        )
        lowered = labels.join(least, labels["node"] == least["a"], "left").select(
            "node", "component", F.least("component", F.coalesce("least", "component")).alias("lower")
        )
        lowered = written(lowered.coalesce(files), "lowered")
        jump = lowered.select(F.col("node").alias("at"), F.col("lower").alias("beyond"))
        # Where a node's label moved, the label's own node is told as well: roots of joined groups meet.
        told = lowered.filter("lower < component").groupBy(F.col("component").alias("root")).agg(F.min("lower").alias("told"))
        followed = (
            lowered.join(jump, lowered["lower"] == jump["at"], "left")
            .join(told, lowered["node"] == told["root"], "left")
            .select(
                "node", F.col("component").alias("before"),
                F.least("lower", F.coalesce("beyond", "lower"), F.coalesce("told", "lower")).alias("component"),
            )
        )
        followed = written(followed.coalesce(files), "labels")
        settled = followed.filter("component < before").isEmpty()
        labels = followed.select("node", "component")
        if settled:
            return labels


def near_groups(docs: DataFrame, settings: NearSettings = NearSettings()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``."""
    sketched = written(sketches(docs, settings), "sketches")
    known = sketched.filter("content IS NOT NULL AND doc_id IS NOT NULL")
    # One text of each content: the one with the smallest id.
    first = F.row_number().over(Window.partitionBy("content").orderBy("doc_id"))
    texts = known.withColumn("place", first).filter("place = 1")
    bucketed = written(texts.select(F.col("doc_id").alias("rep"), F.explode("bands").alias("bucket")), "buckets")
    shared = bucketed.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    # Texts by the number of others they share buckets with, as one number; a hash breaks ties.
    shared_with = F.sum("members").over(Window.partitionBy("rep"))  # as many rows as bands
    order = F.shiftleft(F.least(shared_with, F.lit((1 << 23) - 1)), 40) + F.pmod(F.xxhash64("rep"), F.lit(1 << 40))
    members = written(bucketed.join(shared, "bucket").select("bucket", "rep", "members", order.alias("order")), "members")
    labels = linked_components(docs, members, settings)

    owners = known.groupBy("content").agg(F.min("doc_id").alias("rep"))
    component = F.coalesce("component", "rep")
    # A group of copies may be large, so its rows are combined before they are shuffled ...
    owners = owners.join(labels, F.col("rep") == F.col("node"), "left").select(
        F.col("content").alias("same"), component.alias("component")
    )
    # ... and this join leaves a hot content to be split by adaptive execution.
    joined = sketched.join(owners, F.col("content") == F.col("same"), "left")
    if known.groupBy("doc_id").agg(F.min("content").alias("low"), F.max("content").alias("high")).filter("low < high").isEmpty():
        found = joined.withColumn("component", F.coalesce("component", "doc_id"))
    else:
        own = joined.groupBy(F.col("doc_id").alias("own_id")).agg(F.min("component").alias("least"))
        found = joined.join(own, F.col("doc_id") == F.col("own_id"), "left").withColumn(
            "component", F.coalesce("least", "doc_id")
        )
    return found.select(
        "doc_id", "n_shingles", F.col("component").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def linked_components(docs: DataFrame, members: DataFrame, settings: NearSettings) -> DataFrame:
    """``node, component`` of all texts with a link; ``members`` is ``bucket, rep, members, order``."""
    labels = docs.sparkSession.createDataFrame([], "node bigint, component bigint")
    reps = members.select(F.col("rep").alias("doc_id"))
    texts = docs.select("doc_id", "text")
    # Most texts share no bucket: they are left where they are.
    asked = marked(texts, "doc_id", reps, "asked").filter("asked").drop("asked")
    sets = written(shingle_sets(asked.join(reps, "doc_id", "left_semi"), settings), "sets")
    bitmaps = sets.drop("hashes").withColumnRenamed("doc_id", "rep")
    tested = links = None
    turn = 0
    while True:
        if turn == 0:
            pairs = _first_candidates(members, bitmaps, settings)
        else:
            # After a turn with as many centres as members, all of a bucket's pairs were made.
            seated = members.filter(F.col("members") > _centres(turn - 1)).join(labels, F.col("rep") == F.col("node"), "left")
            seated = written(seated.select("bucket", "rep", "members", F.coalesce("component", "rep").alias("component")), "seated")
            open_buckets = (
                seated.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
                .filter("low < high").select("bucket")
            )
            waiting = written(_with_buckets(seated.join(open_buckets, "bucket")).join(bitmaps, "rep"), "waiting")
            if waiting.isEmpty():
                return labels
            pairs = _candidates(waiting, turn, settings).join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        found = written(_confirmed(pairs, sets, settings), "links")
        if not found.isEmpty():
            links = found if links is None else links.union(found)
            nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
            labels = components(nodes, links)
        turn += 1


def _centres(turn: int) -> int:
    """About so many centres has a bucket; the first turn makes no bucket's pairs whole."""
    return CENTRES * 4 ** (turn - 1) if turn else 1


def _may_link(settings: NearSettings) -> Column:
    """Of a text and its centre: sizes and bitmaps allow a link."""
    enough = 100 * F.least("n", "centre_n") >= settings.similarity * F.greatest("n", "centre_n")
    differ = F.expr(" + ".join(f"bit_count({p} ^ centre_{p})" for p in PARITY))
    return enough & (differ * (100 + settings.similarity) <= (F.col("n") + F.col("centre_n")) * (100 - settings.similarity))


def _as_centres(texts: DataFrame) -> DataFrame:
    return texts.select(
        F.col("rep").alias("centre"), F.col("n").alias("centre_n"), *[F.col(p).alias(f"centre_{p}") for p in PARITY],
        *[F.col(c).alias(c if c == "bucket" else f"centre_{c}") for c in ("bucket", "component", "buckets") if c in texts.columns],
    )


def _first_candidates(members: DataFrame, bitmaps: DataFrame, settings: NearSettings) -> DataFrame:
    """``a, b``: each text and, of the first members of its buckets by order, the first one it may be linked with."""
    firsts = members.groupBy("bucket").agg(F.max(F.struct("order", "rep")).alias("first"))
    stars = members.join(firsts, "bucket").filter(F.col("rep") != F.col("first.rep"))
    stars = stars.select("rep", F.col("first.order").alias("centre_order"), F.col("first.rep").alias("centre")).distinct()
    stars = stars.join(bitmaps, "rep").join(_as_centres(bitmaps), "centre").filter(_may_link(settings))
    best = stars.groupBy("rep").agg(F.max(F.struct("centre_order", "centre")).alias("best"))
    return best.select(F.least("rep", "best.centre").alias("a"), F.greatest("rep", "best.centre").alias("b"))


def _with_buckets(seated: DataFrame) -> DataFrame:
    """``buckets`` added: all of the text's buckets here, small ones first; as many as bands."""
    listed = F.collect_set(F.struct("members", "bucket")).over(Window.partitionBy("rep"))
    return seated.withColumn("buckets", F.array_sort(listed)["bucket"])


def _candidates(waiting: DataFrame, turn: int, settings: NearSettings) -> DataFrame:
    """``a, b``: members drawn by a hash as centres, and members of other components that may be linked with them.

    Only the first bucket that two texts share makes them a pair: like texts share many. Should they be no centres there, a
    later turn makes the pair, as that bucket is not done before.
    """
    is_centre = F.pmod(F.xxhash64("bucket", "rep"), F.col("members")) < _centres(turn)
    waiting = waiting.withColumn("is_centre", is_centre)
    centres = _as_centres(waiting.filter("is_centre"))
    # Of two centres one is the member.
    once = ~F.col("is_centre") | (F.col("rep") < F.col("centre"))
    first_shared = F.get(F.array_intersect("buckets", "centre_buckets"), F.lit(0)) == F.col("bucket")
    may_link = (F.col("component") != F.col("centre_component")) & _may_link(settings)
    stars = waiting.join(centres, "bucket").filter(once & may_link & first_shared)
    return stars.select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b")).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, settings: NearSettings) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("left_set"), F.col("n").alias("left_n"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("right_set"), F.col("n").alias("right_n"))
    sized = pairs.join(left, "a").join(right, "b").select(
        "a", "b", common("left_set", "right_set").alias("both"),
        "left_n", "right_n",
    )
    union = F.col("left_n") + F.col("right_n") - F.col("both")
    return sized.filter(100 * F.col("both") >= settings.similarity * union).select("a", "b")
