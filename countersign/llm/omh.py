"""Order MinHash fingerprints with Spark expressions only.

A text's k-mers are its runs of ``k`` words, numbered where one occurs again. Every numbered k-mer
has a place on a circle, by its hash. Each of ``sketches`` evenly spaced points takes the
``length`` k-mers that follow it, puts them in text order and hashes that tuple. Texts that share
many k-mers in the same order share many tuples, so likeness falls with the edit distance, and also
when passages change places. One hash and one sort serve all sketches of a text.

Results in special cases: a NULL text is the empty one; the empty text has a fingerprint of zeros;
texts of fewer words than ``k`` or fewer k-mers than ``length`` use what there is; equal words give
equal fingerprints. Positions take 24 bits: beyond 16 million words in one text they start anew,
which only blurs the order there.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from countersign.llm.shared import let

SKETCHES, LENGTH, K = 64, 2, 2
POSITION_BITS = 24
POSITIONS = (1 << POSITION_BITS) - 1
SLICE_ROWS, MAX_SLICES = 2048, 65_536


def _place(hashed: Column, position: Column) -> Column:
    """A hash's upper bits with a position below, as one number to sort by."""
    return hashed.bitwiseAND(F.lit(~POSITIONS)).bitwiseOR(position)


def _repeats(places: Column, i: Column) -> Column:
    """How many equal k-mers stand before the i-th of the sorted places: a search by halves."""
    def same(back: Column) -> Column:
        other = F.get(places, i - back)
        return (i >= back) & (
            F.shiftright(other, POSITION_BITS) == F.shiftright(places[i], POSITION_BITS)
        )

    steps = F.lit([1 << b for b in range(POSITION_BITS - 1, -1, -1)])
    found = F.aggregate(
        steps, F.lit(0), lambda n, step: F.when(same(n + step), n + step).otherwise(n)
    )
    return F.when(same(F.lit(1)), found).otherwise(F.lit(0))


def fingerprint(text: Column, sketches: int = SKETCHES, length: int = LENGTH, k: int = K) -> Column:
    """``array<int>``: 16 bits for each sketch."""
    points = [-(1 << 63) + j * ((1 << 64) // sketches) for j in range(sketches)]
    points = F.lit([(p & ~POSITIONS) | POSITIONS for p in points])

    def kmers(words: Column) -> Column:
        return F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, k)]))

    def places(hashes: Column) -> Column:
        return F.sort_array(F.transform(hashes, lambda h, i: _place(h, i.bitwiseAND(F.lit(POSITIONS)))))

    def numbered(found: Column) -> Column:
        return F.sort_array(
            F.transform(
                found,
                lambda x, i: _place(
                    F.xxhash64(F.shiftright(x, POSITION_BITS), _repeats(found, i)),
                    x.bitwiseAND(F.lit(POSITIONS)),
                ),
            )
        )

    def firsts(circle: Column) -> Column:
        """Index of the first k-mer after each point."""
        with_points = F.sort_array(F.concat(circle, points))
        marks = F.filter(
            F.transform(
                with_points,
                lambda x, i: F.when(x.bitwiseAND(F.lit(POSITIONS)) == POSITIONS, i),
            ),
            lambda i: i.isNotNull(),
        )
        return F.transform(F.slice(marks, 1, sketches), lambda i, j: i - j)

    def tuples(hashes: Column, circle: Column) -> Column:
        n = F.size(circle)
        taken = F.sequence(F.lit(0), F.least(n, F.lit(length)) - 1)

        def one(first: Column) -> Column:
            positions = F.sort_array(
                F.transform(
                    taken, lambda r: F.get(circle, (first + r) % n).bitwiseAND(F.lit(POSITIONS))
                )
            )
            return F.xxhash64(
                F.transform(positions, lambda p: F.get(hashes, p.cast("int")))
            ).bitwiseAND(F.lit(0xFFFF)).cast("int")

        return F.transform(firsts(circle), one)

    def of_hashes(hashes: Column) -> Column:
        found = let(let(places(hashes), numbered), lambda circle: tuples(hashes, circle))
        return F.when(F.size(hashes) > 0, found).otherwise(F.array_repeat(F.lit(0), sketches))

    words = F.array_remove(F.split(text, r"\s+"), "")
    return let(let(words, kmers), of_hashes)


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda v: F.lpad(F.lower(F.hex(v)), 4, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal sketches."""
    same = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)
    return F.size(same) / F.size(a)


def _slice_of(key: Column, bounds: Column) -> Column:
    """How many of the sorted bounds lie below the key."""
    steps = F.lit([1 << b for b in range(16, -1, -1)])
    return F.aggregate(
        steps, F.lit(0),
        lambda n, step: F.when(
            (n + step <= F.size(bounds)) & (F.get(bounds, n + step - 1) < key), n + step
        ).otherwise(n),
    )


def with_next(
    docs: DataFrame, slice_rows: int = SLICE_ROWS, max_slices: int = MAX_SLICES
) -> DataFrame:
    """``doc_id, text, sketch`` with ``next_text, next_sketch`` of the next document in
    descending order of ``doc_id``; the first follows the last.

    Ids are cut into slices of about ``slice_rows`` rows, so that texts move once, to the slice
    they belong to. The last row of a slice takes the first one of the slice below: one row for
    each slice, of which there are at most ``max_slices``. Rows of one id are ordered by text;
    NULL ids come last.
    """
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    keyed = docs.select(
        "doc_id", key.alias("key"), F.coalesce("text", F.lit("")).alias("text")
    )
    n_rows = keyed.count()
    n_slices = max(1, min(max_slices, -(-n_rows // slice_rows)))
    bounds = []
    if n_slices > 1:
        shares = [i / n_slices for i in range(1, n_slices)]
        bounds = keyed.agg(F.percentile_approx("key", shares, 10 * n_slices)).first()[0]
    # A slice holds (bound below, own bound], so bounds are where slices end.
    cut = _slice_of(F.col("key"), F.lit(sorted(set(bounds)))) if bounds else F.lit(0)

    tops = keyed.select(cut.alias("slice"), "key").groupBy("slice").agg(F.max("key").alias("key"))
    below = Window.orderBy(F.desc("slice"))  # one short row a slice
    lowest = Window.orderBy("slice")
    heads = tops.select(
        "key",
        F.coalesce(F.lag("slice").over(below), F.first("slice").over(lowest)).alias("slice"),
    )
    first = Window.partitionBy("slice").orderBy("text")
    heads = (
        keyed.join(F.broadcast(heads), "key")
        .withColumn("rank", F.row_number().over(first)).filter("rank = 1")
        .select("slice", F.col("text").alias("head_text"), fingerprint(F.col("text")).alias("head_sketch"))
    )
    order = Window.partitionBy("slice").orderBy(F.desc("key"), "text")
    led = keyed.select(
        cut.alias("slice"), "key", "doc_id", "text", fingerprint(F.col("text")).alias("sketch")
    ).select(
        "slice", "doc_id", "text", "sketch",
        F.lead("text").over(order).alias("led_text"), F.lead("sketch").over(order).alias("led_sketch"),
    )
    return led.join(heads, "slice").select(
        "doc_id", "text", "sketch",
        F.coalesce("led_text", "head_text").alias("next_text"),
        F.coalesce("led_sketch", "head_sketch").alias("next_sketch"),
    )
