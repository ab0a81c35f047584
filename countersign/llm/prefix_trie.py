"""Prefix trie of conversations, from adaptive radix trees over fixed-width turn ids.

A turn's id is the first 128 bits of the SHA-256 of its role and text, so a conversation is a key of 16 bytes a turn, and
keys in byte order have equal beginnings side by side. The keys are dealt out by ranges of that order. A task
puts its keys, some megabytes at a time, into an adaptive radix tree: inner nodes of 4, 16, 48 or 256
places that grow when full, one-way paths compressed into their lower node, leaves that keep their whole key.
Walked from below, the tree gives a row for each distinct beginning; only depths at whole turns make one, all other
bytes of a path lie inside a turn. Trees of different tasks may hold parts of the same beginning, so its
rows, known by a 128-bit sum of hashes of its turns and their places, are added up.

What counts members (``n_convs``, words times members) adds up over tasks. What counts distinct nodes (leaves,
words) would be counted twice where tasks meet, so it takes a second walk: every node is entered on the account of
its smallest member, whose own nodes are one unbroken lower part of its path, and trees over
these smallest members alone add up the accounts. saved_tokens is the difference of both sums.

No group is gathered: a conversation's places come from ranges over all rows, keys are cut into segments of
``segment`` turns, each filed below the sum of hashes before it, equal segments are counted before they are dealt out, and
the ids that end at a node are joined to texts of ``chunk`` ids before one task hashes them in order, as
SHA-256 demands. That last step alone reads all ids of one node in one task, as a stream.

Results in special cases: NULL role and text count as empty; rows without ``conv_id`` belong to no conversation and are left
out; turns are ordered by ``turn`` (NULL first), equal ones by their id; repeated rows are repeated turns; empty and
very long texts are turns like others; a conversation of which no turn is left ends at the root; an
empty table has no node, not even the root; other columns are ignored.
"""

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from countersign.llm.shared import written
from countersign.operators.ordering import numbered

WORD = r"[^\x20\x09-\x0D]+"
WIDTH = 16
ROOT = "0" * 32
LOW = 0xFFFFFFFF
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


# Turns ---------------------------------------------------------------------------------------------------------

def turn_id(role: Column, text: Column) -> Column:
    """The 16 bytes that stand for a turn. The length of the role keeps role and text apart."""
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(named, 256)), 1, WIDTH)


def turns_in_place(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, place, id, words`` of each turn, where places count from 0 over all conversations, and
    ``conv_id, first_place, n_turns`` of each conversation."""
    role, text = (F.coalesce(rows[c].cast("string"), F.lit("")) for c in ("role", "text"))
    turns = rows.filter(rows["conv_id"].isNotNull()).select(
        rows["conv_id"].cast("bigint").alias("conv_id"), rows["turn"].alias("turn"),
        turn_id(role, text).alias("id"), F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
    )
    # Written first: numbering samples its input, and texts are read and hashed once.
    placed = numbered(written(turns, "turns"), "conv_id", F.col("turn").asc_nulls_first(), "id").drop("turn")
    convs = placed.groupBy("conv_id").agg(F.min("place").alias("first_place"), F.count(F.lit(1)).alias("n_turns"))
    return placed, written(convs, "conversations")


def numbered_turns(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, pos, id, words`` with places from 0 in each conversation, and the conversations as
    ``conv_id, n_turns``: what ``prefix_trie`` takes."""
    placed, convs = turns_in_place(rows)
    turns = placed.join(convs, "conv_id").select("conv_id", (F.col("place") - F.col("first_place")).alias("pos"), "id", "words")
    return turns, convs.select("conv_id", "n_turns")


# Segments ------------------------------------------------------------------------------------------------------

def _lanes() -> list[Column]:
    """Four 32-bit hashes of a turn at its place. Their sums modulo 2^32 name a sequence of turns."""
    first, second = F.xxhash64(F.col("id"), F.col("pos")), F.xxhash64(F.col("pos"), F.lit("second"), F.col("id"))
    return [part for whole in (first, second) for part in (F.shiftrightunsigned(whole, 32), whole.bitwiseAND(LOW))]


def _name(*lanes: Column) -> Column:
    return F.concat(*[F.lpad(F.lower(F.hex(lane.bitwiseAND(LOW))), 8, "0") for lane in lanes])


def segments(turns: DataFrame, segment: int) -> DataFrame:
    """A row for each conversation and ``segment`` turns of it: ``conv_id, seg, start, end`` (names of the
    beginnings before and with it), ``ids``, ``words`` and ``lanes`` of its turns, ``after`` (words in later segments),
    ``last``."""
    hashed = turns.select("conv_id", "pos", "id", "words", *[lane.alias(f"l{i}") for i, lane in enumerate(_lanes())])
    cut = hashed.groupBy("conv_id", F.floor(F.col("pos") / segment).alias("seg")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "id", "words", "l0", "l1", "l2", "l3"))).alias("turns"),  # at most ``segment``
        F.sum("words").alias("own"), *[F.sum(f"l{i}").alias(f"l{i}") for i in range(4)],
    )
    # One row for ``segment`` turns passes these windows.
    before = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(1, Window.unboundedFollowing)
    starts = [F.coalesce(F.sum(f"l{i}").over(before), F.lit(0)) for i in range(4)]
    lane = [F.col(f"turns.l{i}") for i in range(4)]  # a field of an array of structs is an array
    return cut.select(
        "conv_id", "seg", _name(*starts).alias("start"), _name(*[s + F.col(f"l{i}") for i, s in enumerate(starts)]).alias("end"),
        F.unhex(F.array_join(F.transform("turns.id", F.hex), "")).alias("ids"),
        F.col("turns.words").alias("words"), F.flatten(F.array(*lane)).alias("lanes"),
        F.coalesce(F.sum("own").over(later), F.lit(0)).alias("after"),
        F.lead("seg").over(Window.partitionBy("conv_id").orderBy("seg")).isNull().alias("last"),
    )


# The adaptive radix tree ----------------------------------------------------------------------------------------

class Leaf:
    """A key at the end of its path, with the number of the entry that brought it."""

    __slots__ = ("key", "entry")

    def __init__(self, key: bytes, entry: int):
        self.key, self.entry = key, entry


class Inner:
    """A branching. ``path`` are the bytes all keys below share after the branching above; ``ended`` is the
    entry of the key that ends here. The layout follows the number of children: 4 or 16 sorted
    bytes beside their children, an index of 256 bytes into 48 places, or 256 places."""

    __slots__ = ("path", "ended", "size", "bytes", "places")

    def __init__(self, path: bytes):
        self.path, self.ended = path, None
        self.size, self.bytes, self.places = 4, bytearray(), []

    def child(self, byte: int):
        if self.size <= 16:
            at = bisect.bisect_left(self.bytes, byte)
            return self.places[at] if at < len(self.bytes) and self.bytes[at] == byte else None
        if self.size == 48:
            at = self.bytes[byte]
            return self.places[at - 1] if at else None
        return self.places[byte]

    def put(self, byte: int, node) -> None:
        """Add a child or replace it; a full layout grows first."""
        if self.size <= 16:
            at = bisect.bisect_left(self.bytes, byte)
            if at < len(self.bytes) and self.bytes[at] == byte:
                self.places[at] = node
                return
            if len(self.bytes) < self.size:
                self.bytes.insert(at, byte)
                self.places.insert(at, node)
                return
        elif self.size == 48:
            at = self.bytes[byte]
            if at:
                self.places[at - 1] = node
                return
            if len(self.places) < 48:
                self.places.append(node)
                self.bytes[byte] = len(self.places)
                return
        else:
            self.places[byte] = node
            return
        self._grow()
        self.put(byte, node)

    def _grow(self) -> None:
        pairs = list(self.children())
        self.size = {4: 16, 16: 48, 48: 256}[self.size]
        if self.size == 48:
            self.bytes, self.places = bytearray(256), [node for _, node in pairs]
            for number, (byte, _) in enumerate(pairs, 1):
                self.bytes[byte] = number
        elif self.size == 256:
            self.bytes, self.places = bytearray(), [None] * 256
            for byte, node in pairs:
                self.places[byte] = node

    def children(self) -> Iterator[tuple[int, object]]:
        if self.size <= 16:
            yield from zip(self.bytes, self.places)
        elif self.size == 48:
            yield from ((b, self.places[at - 1]) for b, at in enumerate(self.bytes) if at)
        else:
            yield from ((b, node) for b, node in enumerate(self.places) if node is not None)


def shared_length(a: bytes, b: bytes) -> int:
    """So many first bytes are equal."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class RadixTree:
    """Distinct keys, each with the number of its entry."""

    def __init__(self):
        self.root = None

    def add(self, key: bytes, entry: int) -> int:
        """Files a key; returns the entry that has it already, or ``entry`` itself."""
        if self.root is None:
            self.root = Leaf(key, entry)
            return entry
        above, byte, node, at = None, 0, self.root, 0
        while True:
            if isinstance(node, Leaf):
                if node.key == key:
                    return node.entry
                shared = shared_length(node.key[at:], key[at:])
                fork = Inner(key[at : at + shared])
                self._hang(fork, node.key, at + shared, node)
                self._hang(fork, key, at + shared, Leaf(key, entry))
                self._replace(above, byte, fork)
                return entry
            shared = shared_length(node.path, key[at:])
            if shared < len(node.path):
                fork = Inner(node.path[:shared])
                lower, node.path = node.path[shared], node.path[shared + 1 :]
                fork.put(lower, node)
                self._hang(fork, key, at + shared, Leaf(key, entry))
                self._replace(above, byte, fork)
                return entry
            at += shared
            if at == len(key):
                if node.ended is None:
                    node.ended = entry
                return node.ended
            below = node.child(key[at])
            if below is None:
                node.put(key[at], Leaf(key, entry))
                return entry
            above, byte, node, at = node, key[at], below, at + 1

    @staticmethod
    def _hang(fork: Inner, key: bytes, at: int, leaf: Leaf) -> None:
        if at == len(key):
            fork.ended = leaf.entry
        else:
            fork.put(key[at], leaf)

    def _replace(self, above: Inner | None, byte: int, node) -> None:
        if above is None:
            self.root = node
        else:
            above.put(byte, node)

    def from_below(self) -> Iterator[tuple[int, int, list[int], int | None]]:
        """Nodes, children before their parent: ``above, depth`` (bytes: the path of the node goes from the one to the
        other), the numbers its children had in this listing, and the entry of the key that ends here."""
        if self.root is None:
            return
        count, waiting = 0, [(self.root, 0, [], None)]
        done: list[list[int]] = [[]]  # numbers of finished children, a list for each open node
        while waiting:
            node, above, _, rest = waiting.pop()
            if isinstance(node, Leaf):
                yield above, len(node.key), [], node.entry
                done[-1].append(count)
                count += 1
                continue
            depth = above + len(node.path)
            if rest is None:
                rest = node.children()
                done.append([])
            step = next(rest, None)
            if step is None:
                yield above, depth, done.pop(), node.ended
                done[-1].append(count)
                count += 1
            else:
                waiting.append((node, above, [], rest))
                # The byte that leads to a child is part of the child's path.
                waiting.append((step[1], depth + 1, [], None))


# Walks over dealt-out keys ---------------------------------------------------------------------------------------

NODES = pa.schema([
    ("name", pa.string()), ("parent", pa.string()), ("depth", pa.int64()), ("words", pa.int64()),
    ("n_convs", pa.int64()), ("conv_id", pa.int64()), ("total", pa.int64()), ("n_leaves", pa.int64()),
])
KEYS = ("start", "ids", "words", "lanes", "depth", "n_convs", "conv_id", "after", "since", "n_leaves")


class _Entry:
    """A key's weights and what its nodes are called."""

    __slots__ = ("names", "words", "depth", "n_convs", "conv_id", "after", "since", "n_leaves")

    def __init__(self, row: dict):
        start = np.frombuffer(bytes.fromhex(row["start"]), ">u4").astype(np.uint64)
        lanes = np.array(row["lanes"], np.uint64).reshape(4, -1)
        sums = (start[:, None] + np.cumsum(lanes, axis=1)) & np.uint64(LOW)
        self.names = bytes.fromhex(row["start"]) + sums.T.astype(">u4").tobytes()
        self.words, self.depth = row["words"], row["depth"]
        self.n_convs, self.conv_id, self.after = row["n_convs"], row["conv_id"], row["after"]
        self.since, self.n_leaves = row["since"], row["n_leaves"]

    def add(self, other: "_Entry") -> None:
        self.n_convs, self.conv_id = self.n_convs + other.n_convs, min(self.conv_id, other.conv_id)
        self.after, self.since = self.after + other.after, min(self.since, other.since)
        self.n_leaves += other.n_leaves

    def name(self, turns: int) -> str:
        return self.names[WIDTH * turns : WIDTH * (turns + 1)].hex()


def tree_nodes(entries: list[tuple[bytes, _Entry]], distinct: bool) -> Iterator[tuple]:
    """A row of ``NODES`` for each beginning of the keys, from one radix tree over them.

    ``total`` adds up the words of the last turns of the nodes from this one down: once for each member, or with
    ``distinct`` once for each node that one of the keys has on its account (depth ``since`` and below).
    """
    tree, kept = RadixTree(), []
    for key, entry in entries:
        number = tree.add(key, len(kept))
        if number == len(kept):
            kept.append(entry)
        else:
            kept[number].add(entry)
    # n_convs, conv_id, total, since, n_leaves and an entry below, of each node walked.
    sums: list[tuple] = []
    for above, depth, children, ended in tree.from_below():
        below = [sums[child] for child in children]
        if ended is not None:
            e = kept[ended]
            below.append((e.n_convs, e.conv_id, e.after, e.since, e.n_leaves, e))
        n, conv = sum(b[0] for b in below), min(b[1] for b in below)
        total, since, leaves, entry = sum(b[2] for b in below), min(b[3] for b in below), sum(b[4] for b in below), below[0][5]
        # Whole turns on the path, the deepest first. The first WIDTH bytes are the name of the segment's start.
        for turns in range(depth // WIDTH - 1, max(-(-above // WIDTH) - 1, 0) - 1, -1):
            at = entry.depth + turns
            if turns:
                words = entry.words[turns - 1]
                total += words * ((since <= at) if distinct else n)
                yield entry.name(turns), entry.name(turns - 1), at, words, n, conv, total, leaves
            elif not at:
                yield ROOT, None, 0, 0, n, conv, total, leaves
        sums.append((n, conv, total, since, leaves, entry))


def walked(keys: DataFrame, distinct: bool, tree_bytes: int) -> DataFrame:
    """Parts of nodes (``NODES``) from trees over ranges of the keys. ``keys`` has the columns ``KEYS``."""
    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                held.append((bytes.fromhex(row["start"]) + row["ids"], _Entry(row)))
                size += len(row["ids"]) + WIDTH
                if size > tree_bytes:
                    yield from _as_batches(tree_nodes(held, distinct))
                    held, size = [], 0
        yield from _as_batches(tree_nodes(held, distinct))

    dealt = keys.select(*KEYS).repartitionByRange("start", "ids").sortWithinPartitions("start", "ids")
    types = "name string, parent string, depth bigint, words bigint, n_convs bigint, conv_id bigint, total bigint, n_leaves bigint"
    return dealt.mapInArrow(nodes, types)


def _as_batches(rows: Iterator[tuple], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _as_batch(held)
            held = []
    if held:
        yield _as_batch(held)


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), NODES)], schema=NODES)


# The trie --------------------------------------------------------------------------------------------------------

def prefix_trie(
    turns: DataFrame, convs: DataFrame, segment: int = 256, tree_bytes: int = 8 << 20
) -> tuple[DataFrame, DataFrame]:
    """The nodes and where conversations end.

    ``turns`` has ``conv_id, pos, id, words``, places from 0 without a gap; ``convs`` has ``conv_id, n_turns`` of
    all conversations, turnless ones too. Nodes: ``name`` (of the beginning), ``parent, depth, words`` (of its last
    turn), ``n_convs, conv_id`` (smallest member), ``parent_conv_id, n_children, n_leaves, saved_tokens``. Ends:
    ``name, conv_id``.
    """
    cut = written(segments(turns, segment), "segments")
    turnless = convs.filter("n_turns = 0").selectExpr(
        "conv_id", "CAST(0 AS bigint) AS seg", f"'{ROOT}' AS start", f"'{ROOT}' AS end", "X'' AS ids",
        "CAST(array() AS array<bigint>) AS words", "CAST(array() AS array<bigint>) AS lanes", "CAST(0 AS bigint) AS after", "true AS last",
    )
    whole = cut.unionByName(turnless).withColumn("depth", F.col("seg") * segment)
    same = [F.first(c).alias(c) for c in ("ids", "words", "lanes", "depth")]
    members = whole.groupBy("start", "end").agg(
        *same, F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("after").alias("after"),
        F.lit(0).cast("bigint").alias("since"), F.lit(0).cast("bigint").alias("n_leaves"),
    )
    parts = walked(members, False, tree_bytes)
    merged = parts.groupBy("name").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("words").alias("words"),
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("total").alias("said"),
    )
    merged = written(merged, "nodes")
    children = merged.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = merged.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = written(nodes, "nodes")

    # Every node is on the account of its smallest member, from depth ``since`` down to that member's end.
    accounts = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("since"), F.sum("words").alias("owned"),
        F.max((F.col("n_children") == 0).cast("bigint")).alias("n_leaves"),
    )
    begins_later = F.col("since") > F.col("depth") + F.size("words")
    accounted = whole.join(accounts, "conv_id").withColumn("after", F.when(begins_later, F.col("owned")).otherwise(F.col("after")))
    distinct = accounted.groupBy("start", "end").agg(
        *same, F.lit(0).cast("bigint").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("after").alias("after"),
        F.min("since").alias("since"), F.sum("n_leaves").alias("n_leaves"),
    )
    once = walked(distinct, True, tree_bytes).groupBy("name").agg(F.sum("total").alias("once"), F.sum("n_leaves").alias("n_leaves"))
    above = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    trie = nodes.join(once, "name").join(above, "parent", "left").select(
        "name", "parent", "depth", "words", "n_convs", "conv_id", "parent_conv_id", "n_children", "n_leaves",
        (F.col("said") - F.col("once")).alias("saved_tokens"),
    )
    return trie, whole.filter("last").select(F.col("end").alias("name"), "conv_id")


def ids_sha256(ends: DataFrame, chunk: int = 4096) -> DataFrame:
    """``name, ends_sha256``: the SHA-256 of each node's ids in numerical order, as decimals joined by commas."""
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, ids = None, []
        for batch in batches:
            rows = []
            for own, conv in zip(batch.column("name").to_pylist(), batch.column("conv_id").to_pylist()):
                if ids and (own != name or len(ids) == chunk):
                    rows.append((name, ids[0], ",".join(map(str, ids))))
                    ids = []
                name = own
                ids.append(conv)
            yield _texts(rows)
        yield _texts([(name, ids[0], ",".join(map(str, ids)))] if ids else [])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, digest = None, None
        for batch in batches:
            rows = []
            for own, text in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist()):
                if own == name:
                    digest.update(b"," + text.encode())
                    continue
                if name is not None:
                    rows.append((name, digest.hexdigest()))
                name, digest = own, hashlib.sha256(text.encode())
            yield _digests(rows)
        yield _digests([(name, digest.hexdigest())] if name is not None else [])

    ordered = ends.repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id")
    texts = ordered.mapInArrow(joined, "name string, first bigint, ids string")
    return texts.repartition("name").sortWithinPartitions("name", "first").select("name", "ids").mapInArrow(
        hashed, "name string, ends_sha256 string"
    )


def _texts(rows: list[tuple]) -> pa.RecordBatch:
    return _columns(rows, [("name", pa.string()), ("first", pa.int64()), ("ids", pa.string())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    return _columns(rows, [("name", pa.string()), ("ends_sha256", pa.string())])


def _columns(rows: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    values = zip(*rows) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, (_, t) in zip(values, fields)], names=[n for n, _ in fields])
