"""Packing of token pieces into sequences, shortest pack first, over the histogram of lengths.

Documents become token ids and an end mark, cut into pieces of at most ``size`` ids. Only the
histogram of piece lengths comes to the driver: at most ``size`` numbers. Lengths are placed longest
first; all pieces of a length go to the shortest packs (most room left) that still hold them, or to new packs.
Packs of equal content are one pattern with a count, so work depends on ``size``, not on the number of documents.
Each piece has a rank among those of its length; slots of the patterns are numbered the same way,
and ranks join them.

Ranks are counted in two steps, by length and bucket of pieces and then within it, so a length
that a third of all pieces have is not ranked in one task.

Results in special cases: a NULL text is the empty one and gives one piece, the end mark; repeated
rows are documents of their own; an empty table gives no row; other columns are ignored.
"""

import os
import re
import sys
from bisect import insort
from collections.abc import Iterator
from itertools import pairwise
from struct import pack as pack_into_bytes
from types import ModuleType
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from countersign.llm.shared import tidy, written

SIZE, END_ID = 2048, 1
CACHED_WORDS = 300_000
# Only words that a chunk has so often are kept: the others, most of them, are hardly met again.
KEPT_FROM = 2
STORE = "countersign_known_words"
CHUNK_CHARACTERS = 1_000_000
LINE_WORDS = 500
# What the tokenizer returns for a word takes more memory than the word: so many in a call.
CALL_WORDS = 2_000
BUCKET_ROWS = 20_000

# Where lowering letters first could matter: names of special tokens, marks that compose with small letters alone, capital sigma,
# dotted capital I, letters newer than Unicode 15.
_CASE_MATTERS = r"<\||[\p{M}\x{3a3}\x{130}\x{1c89}\x{a7cb}-\x{a7dc}\x{10d50}-\x{10d65}]"
# Marks that end a word. The tokenizer parts them from letters too; apostrophes and the marks of special tokens stay.
_END_MARKS = r"([a-zß-öø-ÿ])([!-&(-/:;=?@\[-`{}~]+)([ \n]|$)"
_LETTERS = re.compile("[a-zß-öø-ÿ]+")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def separable(texts: pa.StringArray) -> pa.StringArray:
    """Texts of the same ids with fewer different words: lower case, the marks at a word's end apart.

    The tokenizer lowers letters itself, except in the names of special tokens. Texts where
    lowering first could matter (these names, a final sigma, a dotted I, letters not composed yet) keep their case.
    """
    cased = pc.match_substring_regex(texts, _CASE_MATTERS)
    # Not Arrow's normal form, which cuts off texts beyond ASCII, so that none of them seemed to be composed.
    composed = pa.array([is_normalized("NFC", text) for text in texts.to_pylist()], pa.bool_())
    lowered = pc.if_else(pc.and_not(composed, cased), pc.utf8_lower(texts), texts)
    return pc.replace_substring_regex(lowered, _END_MARKS, r"\1 \2\3")


def token_pieces(docs: DataFrame, tokenizer_path: str | None = None, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """``doc_id, start, length, doc_tokens, ids`` per piece; ids are little-endian unsigned 32-bit numbers.

    The tokenizer never joins over a space or a line end, so texts are cut there and each
    different word is tokenized once a chunk. Words that a chunk repeats are kept by the worker process, as long as their
    store has room.
    """
    with open(tokenizer_path or default_tokenizer(), encoding="utf-8") as file:
        definition = file.read()  # about 2 MB; executors need not have the file

    schema = pa.schema([
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
        ("doc_tokens", pa.int64()), ("ids", pa.binary()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task has one core; each thread of the tokenizer's own would hold on to memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        # Words stay known to the worker process for the tasks that follow.
        store = sys.modules.setdefault(STORE, ModuleType(STORE)).__dict__
        if definition not in store:
            store[definition] = Tokenizer.from_str(definition), {"": b""}
        tokenizer, known = store[definition]
        end = np.array([end_id], "<u4").tobytes()

        def alone(words: list[str]) -> list[bytes]:
            out = []
            for i in range(0, len(words), CALL_WORDS):
                found = tokenizer.encode_batch_fast(words[i : i + CALL_WORDS], add_special_tokens=False)
                out += [pack_into_bytes(f"<{len(e.ids)}I", *e.ids) for e in found]
            return out

        def together(words: list[str]) -> list[bytes]:
            """Words of letters in few calls; should the tokenizer see other words in them, one by one."""
            lines = [" ".join(words[i : i + LINE_WORDS]) for i in range(0, len(words), LINE_WORDS)]
            out, at_once = [], CALL_WORDS // LINE_WORDS
            for i in range(0, len(lines), at_once):
                for e in tokenizer.encode_batch(lines[i : i + at_once], add_special_tokens=False):
                    ids = np.array(e.ids, "<u4").tobytes()
                    cuts = 4 * np.flatnonzero(np.diff(np.array(e.word_ids, np.int64), prepend=-1))
                    out += [ids[a:b] for a, b in pairwise([*cuts.tolist(), len(ids)])]
            return out if len(out) == len(words) else alone(words)

        def of_words(words: pa.StringArray, often: np.ndarray) -> list[bytes]:
            listed = words.to_numpy(zero_copy_only=False).tolist()
            ids = list(map(known.get, listed))
            missing = [i for i, found in enumerate(ids) if found is None]
            letters = [i for i in missing if _LETTERS.fullmatch(listed[i])]
            others = [i for i in missing if not _LETTERS.fullmatch(listed[i])]
            for places, tokenized in ((letters, together), (others, alone)):
                for i, found in zip(places, tokenized([listed[i] for i in places])):
                    ids[i] = found
            if len(known) < CACHED_WORDS:
                known.update((listed[i], ids[i]) for i in missing if often[i])
            return ids

        def encoded(texts: pa.StringArray) -> list[bytes]:
            split = pc.split_pattern(pc.replace_substring(separable(texts), "\n", " "), " ")
            words = split.flatten().dictionary_encode()  # each different word is looked up once
            at = words.indices.to_numpy()
            ids = of_words(words.dictionary, np.bincount(at, minlength=len(words.dictionary)) >= KEPT_FROM)
            lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            starts = np.cumsum(lengths) - lengths
            ends = np.concatenate([[0], np.cumsum(lengths[at])])
            # The ids of every word in turn, taken from those of the different words.
            places = np.arange(ends[-1]) + np.repeat(starts[at] - ends[:-1], lengths[at])
            every = np.frombuffer(b"".join(ids), "<u4")[places]
            bounds = ends[split.offsets.to_numpy()]
            return [every[a:b].tobytes() + end for a, b in pairwise(bounds)]

        for batch in batches:
            keys, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            # Bounded numbers of characters at a time: the words of a text take more memory than the text.
            ends = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False)) // CHUNK_CHARACTERS
            for rows_at in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(ends)) + 1):
                if not len(rows_at):
                    continue
                first, rows = int(rows_at[0]), []
                part = texts.slice(first, len(rows_at))
                for key, ids in zip(keys[first : first + len(part)], encoded(part)):
                    total = len(ids) // 4
                    rows += [
                        (key, start, min(size, total - start), total, ids[4 * start : 4 * (start + size)])
                        for start in range(0, total, size)
                    ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*rows), schema.types)], schema=schema
                )

    texts = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(tidy(cut), "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary")


def numbered(pieces: DataFrame) -> DataFrame:
    """The pieces, written with a ``piece_id`` each, so that retried tasks find the same ids."""
    return written(pieces.withColumn("piece_id", F.monotonically_increasing_id()), "pieces")


def patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """Shortest pack first: ``(lengths of a pack, number of such packs)``."""
    packs: dict[int, list[tuple[tuple[int, ...], int]]] = {}  # by room left
    rooms: list[int] = []  # sorted

    def put(content: tuple[int, ...], count: int, room: int) -> None:
        if room not in packs:
            packs[room] = []
            insort(rooms, room)
        packs[room].append((content, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not rooms or rooms[-1] < length:
                # A new pack has the most room, so it takes pieces of this length until it is full.
                together = min(size // length, left)
                put((length,) * together, left // together, size - length * together)
                left %= together
                if left:
                    put((length,) * left, 1, size - length * left)
                break
            room = rooms[-1]
            content, count = packs[room].pop()
            if not packs[room]:
                del packs[room]
                rooms.pop()
            used = min(count, left)
            if count > used:
                put(content, count - used, room)
            put(content + (length,), used, room - length)
            left -= used
    return [pack for room in rooms for pack in packs[room]]


def slots(found: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """``(length, first rank, count, first sequence, offset)``: ``count`` slots of a length, one a sequence."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for content, count in found:
        offset = 0
        for length in content:
            first = used.get(length, 0)
            out.append((length, first, count, sequence, offset))
            used[length] = first + count
            offset += length
        sequence += count
    return out


def place(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """``sequence_id`` and ``offset`` added to pieces that have a ``length`` and a ``piece_id`` of their own."""
    spark = pieces.sparkSession
    histogram = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most size rows
    n_pieces = sum(histogram.values())
    buckets = max(1, -(-n_pieces // BUCKET_ROWS))
    keyed = pieces.withColumn("bucket", F.pmod(F.xxhash64("piece_id"), F.lit(buckets)).cast("int"))
    sizes = keyed.groupBy("length", "bucket").count()
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("piece_id")
    ranked = (
        keyed.join(offsets, ["length", "bucket"])
        .withColumn("rank", F.col("before") + F.row_number().over(within) - 1)
        .drop("bucket", "before")
    )
    listed = slots(patterns(histogram, size))
    schema = "length bigint, first bigint, n bigint, sequence bigint, offset bigint"
    by_length = (
        spark.createDataFrame(listed, schema)
        .groupBy("length").agg(F.sort_array(F.collect_list(F.struct("first", "n", "sequence", "offset"))).alias("runs"))
    )
    # Bounded by the patterns, whose number depends on size alone.
    joined = ranked.join(F.broadcast(by_length), "length")
    run = F.element_at(F.filter("runs", lambda r: r["first"] <= F.col("rank")), -1)
    return joined.withColumn("run", run).select(
        *pieces.columns,
        (F.col("run.sequence") + F.col("rank") - F.col("run.first")).alias("sequence_id"),
        F.col("run.offset").alias("offset"),
    )


def pack(docs: DataFrame, tokenizer_path: str | None = None, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """``doc_id, start, length, doc_tokens, ids, piece_id, sequence_id, offset`` per piece."""
    return place(numbered(token_pieces(docs, tokenizer_path, size, end_id)), size)
