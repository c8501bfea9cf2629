"""Importance resampling of documents toward a target distribution of hashed n-grams.

A feature is a run of 1 to `width` consecutive words (digits, a-z after lower-casing A-Z,
characters beyond ASCII), joined by one space; its bucket is its CRC32 modulo `buckets`.
From the counts of all source and all target texts every bucket gets a gain, the log of its
smoothed ratio; a document's weight is the mean gain of its features, Gumbel noise from a
digest of its id is added, and the highest scores are drawn: sampling without replacement.

Each batch interns its n-grams in an open-addressed numpy table (`Interned`): a slot is
claimed by XXH64 and confirmed byte by byte, holds bucket and count, and every occurrence
keeps its slot. Counting sums slot counts per bucket; scoring gathers gains by slot.
Tables live for one slice of a batch. What the driver holds is one number per bucket
(a parameter) of source and target; the ranks come from a range partitioning of scores, so
no task sees all documents.

Defined cases: a null or empty text has no features and weight 0; a null id takes part as
the empty string; ties go to the smaller id, a null one last, then to the smaller hash of
the text, and equal rows of one id in any order; every row is returned. With empty source
or target tables the smoothing decides alone.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from riskloom.llm import wordspans
from riskloom.llm.batches import bounded_batches, quoted, slices
from riskloom.session import cut_lineage

#: A table never fills beyond half.
LOAD = 2


class Interned:
    """The distinct byte ranges of one batch in an open-addressed table.

    `slot[i]` is the table place of occurrence i; `owner` gives the first occurrence that
    claimed a place (-1: free), `count` how many occurrences sit there.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashes: np.ndarray | None = None):
        n = len(starts)
        size = 1 << max(4, (LOAD * n - 1).bit_length())
        mask = np.uint64(size - 1)
        hashes = wordspans.xxh64(data, starts, lengths) if hashes is None else hashes
        self.owner = np.full(size, -1, np.int64)
        self.slot = (hashes & mask).astype(np.int64)
        left = np.arange(n)
        while len(left):
            at = self.slot[left]
            free = self.owner[at] < 0
            # Of several that reach a free place the one written last holds it; the others compare with it.
            self.owner[at[free]] = left[free]
            holder = self.owner[at]
            same = (hashes[holder] == hashes[left]) & (lengths[holder] == lengths[left])
            other = np.flatnonzero(same & (holder != left))
            same[other] = wordspans.same_bytes(data, starts[holder[other]], data, starts[left[other]], lengths[left[other]])
            left = left[~same]
            self.slot[left] = (self.slot[left] + 1) & (size - 1)
        self.count = np.bincount(self.slot, minlength=size)
        self.used = np.flatnonzero(self.owner >= 0)


def ngrams(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and lengths of all n-grams, the text of each, and the number of words of every text."""
    data = wordspans.LOWER[data]
    starts, lengths, owner = wordspans.words_of(data, offsets, wordspans.ALNUM)
    n_words = np.bincount(owner, minlength=len(offsets) - 1)
    if width == 1 or not len(starts):
        return data, starts, lengths, owner, n_words
    # The words once more, one blank apart, so that every n-gram is one range of bytes.
    places = np.cumsum(lengths + 1) - lengths - 1
    tight = np.full(int(places[-1] + lengths[-1]), 0x20, np.uint8)
    steps = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    tight[np.repeat(places, lengths) + steps] = data[np.repeat(starts, lengths) + steps]
    parts = [(places, lengths, owner)]
    for more in range(1, width):
        first = np.flatnonzero(owner[:-more] == owner[more:]) if len(owner) > more else np.zeros(0, np.int64)
        parts.append((places[first], places[first + more] + lengths[first + more] - places[first], owner[first]))
    return tight, *(np.concatenate(c) for c in zip(*parts)), n_words


def _slot_buckets(table: Interned, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of every used place, 0 elsewhere."""
    out = np.zeros(len(table.owner), np.int64)
    view = memoryview(np.ascontiguousarray(data))
    first = table.owner[table.used]
    out[table.used] = [zlib.crc32(view[s : s + n]) % buckets for s, n in zip(starts[first].tolist(), lengths[first].tolist())]
    return out


def bucket_counts(df: DataFrame, text: str, width: int, buckets: int) -> DataFrame:
    """bucket, n: how many features of all texts fall into each bucket; buckets without any are left out."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                data, starts, lengths, _, _ = ngrams(*wordspans.joined_bytes(part.column(0)), width)
                table = Interned(data, starts, lengths)
                places = _slot_buckets(table, data, starts, lengths, buckets)[table.used]
                total += np.bincount(places, table.count[table.used], minlength=buckets).astype(np.int64)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], schema=schema)

    own = bounded_batches(df.select(F.col(quoted(text)).alias("__text")))
    return own.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets)))) per bucket."""
    total_s, total_t = sum(source.values()), sum(target.values())
    return np.array([math.floor(1000 * math.log(float(target.get(b, 0) + 1) * float(total_s + buckets) / (float(source.get(b, 0) + 1) * float(total_t + buckets))))
                     for b in range(buckets)], np.int64)


def weights(df: DataFrame, text: str, gain: np.ndarray, width: int, keep: list[str]) -> DataFrame:
    """The kept columns and __features, __words, __weight of every text; `gain` has one number per bucket."""
    source = df.select(*[F.col(quoted(c)) for c in keep], F.col(quoted(text)).alias("__source"))
    out = df.select(*[F.col(quoted(c)) for c in keep], *[F.lit(0).cast("long").alias(c) for c in ("__features", "__words", "__weight")]).schema
    arrow, at = to_arrow_schema(out), len(keep)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at):
                data, starts, lengths, owner, n_words = ngrams(*wordspans.joined_bytes(part.column(at)), width)
                table = Interned(data, starts, lengths)
                own = gain[_slot_buckets(table, data, starts, lengths, len(gain))][table.slot]
                order = np.argsort(owner, kind="stable") if width > 1 else slice(None)
                # Sums from differences of running sums stay in whole numbers.
                n = np.bincount(owner, minlength=part.num_rows)
                running = np.concatenate([[0], np.cumsum(own[order])])
                ends = np.cumsum(n)
                weight = (running[ends] - running[ends - n]) // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(at)] + [pa.array(c.astype(np.int64)) for c in (n, n_words, weight)], schema=arrow)

    return bounded_batches(source).mapInArrow(weigh, out)


def noise(id_text, seed: int):
    """Gumbel noise of an id in thousandths, floored: from the first 32 bits of a digest."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_text, F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(df: DataFrame, order: list, name: str, most: int) -> DataFrame:
    """`df` with its place in the given order, null beyond `most`; ranges are ranked side by side."""
    at = F.monotonically_increasing_id()
    rows = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", at))
    rows = rows.withColumn("__range", F.shiftright("__at", 33))
    # One row per range, a number that the session sets: small enough for one window and for every task.
    before = F.sum("n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    starts = rows.groupBy("__range").agg(F.count("*").alias("n")).select("__range", F.coalesce(before, F.lit(0)).alias("__before"))
    place = (F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1) + 1).cast("long")
    return (rows.join(F.broadcast(starts), "__range").withColumn(name, F.when(place <= most, place))
            .drop("__at", "__range", "__before"))


def resample(docs: DataFrame, target: DataFrame, id_col: str, text: str, target_text: str, width: int = 1, buckets: int = 10_000,
             seed: int = 2024, least_words: int = 20, percent: int = 10) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of `docs`; rank is null where a row isn't drawn."""
    counts = lambda df, column: {r.bucket: r.n for r in bucket_counts(df, column, width, buckets).collect()}
    gain = gains(counts(docs, text), counts(target, target_text), buckets)
    own = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.col(quoted(text)).alias("text")).withColumn("__tie", F.xxhash64("text"))
    scored = weights(own, "text", gain, width, ["doc_id", "__tie"])
    scored = cut_lineage(scored.withColumn("score", (F.col("__weight") + noise(F.col("doc_id").cast("string"), seed)).cast("long")))
    enough = F.col("__words") >= least_words
    drawn = percent * scored.where(enough).count() // 100
    first = ranked(scored.where(enough), [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("__tie")], "rank", drawn)
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    return first.unionByName(rest).select("doc_id", F.col("__features").alias("n_features"), F.col("__weight").alias("weight"), "score", "rank")
