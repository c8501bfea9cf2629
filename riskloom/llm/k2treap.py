"""Ranked lexical search: a K2-treap over the grid of terms and documents.

The grid has a row per term of the items and a column per document; a cell holds the
impact of the term in the document. A shard's grid is kept as a compressed quadtree: per
level only the cells that are not empty, each with a mask of its four quarters, the place
of its first quarter and the greatest impact inside (`Treap`). For one item all rows of its
terms are descended jointly: a state is a range of documents with one cell per term still
present, its bound is the sum of those cells' maxima. The states of the greatest bounds are
halved first, some at a time; a range of one document carries its exact score, and no state
is halved whose bound is below the k-th best score so far. What is left when no state reaches
it holds the k best, ties by ascending id.

One pass over the texts counts terms, lengths and document frequencies of the items' terms;
a second builds the shards, at most `SHARD` documents or `CELLS` cells at a time, inside the
task that reads the texts, and keeps the k best per item and task: no posting is shuffled.
A later shard of a task starts with the score it has to beat. The items go to all tasks,
in blocks of at most `block_terms` distinct (item, term) pairs: with more there is one more
pass over the documents per block, never a larger broadcast.

Terms are maximal runs of digits, letters A-Z (lower-cased), a-z and characters beyond ASCII.

Defined cases: a null or empty text has no terms, is in no count and in no result, but a
text without terms doesn't disturb others; a document with a null id counts and ranks, after
those with an id at equal scores; each row is a document of its own, also where ids repeat;
items are told apart by id, the terms of rows with one item id are taken together, an item
with a null id is left out; an item without terms that occur gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import wordspans
from riskloom.llm.batches import bounded_batches, quoted, slices

#: Documents and cells of one treap.
SHARD, CELLS = 4096, 2_000_000
#: Ranges halved at once, and levels by which a cell is down to one term before it is down to one document.
STEP, LEAD = 128, 4
#: Distinct (item, term) pairs sent to all tasks at once.
BLOCK_TERMS = 500_000
#: How many of the quarters before quarter q are present in a mask.
_EARLIER = np.array([[bin(mask & ((1 << q) - 1)).count("1") for q in range(4)] for mask in range(16)], np.int64)


def _spread(x: np.ndarray) -> np.ndarray:
    """Bit i of a number below 2^32 moved to bit 2i."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Treap:
    """Quadtree of a sparse grid of positive whole numbers, with the maximum of every cell.

    Cells of all levels lie in one row of arrays, the whole grid first: `mask` says which
    quarters of a cell are not empty, `first` where the first of them is, `greatest` the
    maximum inside. Rows are spread by 2^lead, so that a cell narrows to one row `lead` levels
    before it narrows to one column. Each (row, column) is given once.
    """

    def __init__(self, rows: np.ndarray, cols: np.ndarray, values: np.ndarray, lead: int = LEAD):
        rows = rows.astype(np.int64) << lead
        self.lead, self.height = lead, max(int(max(rows.max(initial=0), cols.max(initial=0))).bit_length(), 1)
        code = (_spread(rows) << np.uint64(1)) | _spread(cols)
        order = np.argsort(code)
        code = code[order]
        greatest, first, mask = [values[order].astype(np.int64)], [np.zeros(len(order), np.int64)], [np.zeros(len(order), np.uint8)]
        for _ in range(self.height if len(order) else 0):
            upper = code >> np.uint64(2)
            begins = np.flatnonzero(np.diff(upper, prepend=np.uint64(1 << 63)))
            mask.append(np.bitwise_or.reduceat(np.left_shift(1, (code & np.uint64(3)).astype(np.int64)), begins).astype(np.uint8))
            greatest.append(np.maximum.reduceat(greatest[-1], begins))
            first.append(begins)
            code = upper[begins]
        begin = 0
        for level in reversed(range(1, len(first))):
            begin += len(first[level])
            first[level] += begin
        self.greatest, self.first, self.mask = (np.concatenate(levels[::-1]) for levels in (greatest, first, mask))

    def best(self, rows: np.ndarray, k: int, floor: int = 1, tie: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Sums over the given rows of the k columns where they are greatest, and these columns.

        Equal sums go to the smaller `tie` of the column (the column itself, if not given);
        sums below `floor` are left out.
        """
        sums, columns = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(self.greatest) or not len(rows):
            return sums, columns
        rows = np.asarray(rows, np.int64) << self.lead
        frontier = _Frontier(np.zeros(len(rows), np.int64), rows, int(self.greatest[0]) * len(rows))
        while len(taken := frontier.take(floor)):
            state, cells, row = frontier.cells(taken)
            level, column = frontier.level[taken], frontier.column[taken]
            down = self.height - 1 - level
            quarter = 2 * ((row >> down[state]) & 1)
            mask, first = self.mask[cells].astype(np.int64), self.first[cells]
            for side in (0, 1):
                there = np.flatnonzero((mask >> (quarter + side)) & 1)
                if not len(there):
                    continue
                place = first[there] + _EARLIER[mask[there], quarter[there] + side]
                begins = np.flatnonzero(np.diff(state[there], prepend=-1))
                bound = np.add.reduceat(self.greatest[place], begins)
                parent = state[there[begins]]
                to = column[parent] + (np.int64(side) << down[parent])
                single = (down[parent] == 0) & (bound >= floor)
                sums, columns = np.concatenate([sums, bound[single]]), np.concatenate([columns, to[single]])
                frontier.add(bound, level[parent] + 1, to, begins, place, row[there], (down[parent] > 0) & (bound >= floor))
            if len(sums) >= k:
                floor = max(floor, int(np.partition(sums, len(sums) - k)[len(sums) - k]))
        order = np.lexsort((columns if tie is None else tie[columns], -sums))[:k]
        return sums[order], columns[order]


class _Frontier:
    """Ranges of columns still to be halved, each with its cells: place in the treap and row, one cell per row present."""

    def __init__(self, place: np.ndarray, row: np.ndarray, bound: int):
        self.place, self.row, self.filled = place, row, len(place)
        self.bound, self.level, self.column, self.begin, self.size = (np.array([x], np.int64) for x in (bound, 0, 0, 0, len(place)))

    def take(self, floor: int) -> np.ndarray:
        """The STEP states of the greatest bounds that reach the floor; they leave the frontier."""
        live = np.flatnonzero(self.bound >= floor)
        if len(live) > STEP:
            live = live[np.argpartition(-self.bound[live], STEP)[:STEP]]
        self.bound[live] = -1
        return live

    def cells(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = self.size[states]
        at = np.repeat(self.begin[states] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        return np.repeat(np.arange(len(states)), size), self.place[at], self.row[at]

    def add(self, bound: np.ndarray, level: np.ndarray, column: np.ndarray, begins: np.ndarray, place: np.ndarray, row: np.ndarray, wanted: np.ndarray) -> None:
        if not wanted.any():
            return
        while self.filled + len(place) > len(self.place):
            self.place, self.row = (np.concatenate([x, np.empty_like(x)]) for x in (self.place, self.row))
        self.place[self.filled : self.filled + len(place)], self.row[self.filled : self.filled + len(place)] = place, row
        size = np.diff(begins, append=len(place))
        for name, values in (("bound", bound), ("level", level), ("column", column), ("begin", begins + self.filled), ("size", size)):
            setattr(self, name, np.concatenate([getattr(self, name), values[wanted]]))
        self.filled += len(place)


class Vocabulary:
    """The items' terms as sorted XXH64 hashes, confirmed byte by byte."""

    def __init__(self, terms: list[bytes]):
        lengths = np.array([len(t) for t in terms], np.int64)
        data, starts = np.frombuffer(b"".join(terms), np.uint8), np.cumsum(lengths) - lengths
        for seed in range(64):
            hashes = wordspans.xxh64(data, starts, lengths, seed)
            if len(np.unique(hashes)) == len(terms):
                break
        order = np.argsort(hashes)
        self.data, self.seed, self.hashes, self.number, self.starts, self.lengths = data, seed, hashes[order], order, starts[order], lengths[order]

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The number of the term in each byte range, -1 where it is none."""
        out = np.full(len(starts), -1, np.int64)
        if not len(self) or not len(starts):
            return out
        hashes = wordspans.xxh64(data, starts, lengths, self.seed)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self) - 1)
        like = np.flatnonzero((self.hashes[at] == hashes) & (self.lengths[at] == lengths))
        like = like[wordspans.same_bytes(self.data, self.starts[at[like]], data, starts[like], lengths[like])] if len(like) else like
        out[like] = self.number[at[like]]
        return out


def term_counts(texts: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of every text; then text, term number and occurrences of the vocabulary's terms, by text and term."""
    data, offsets = wordspans.joined_bytes(texts)
    data = wordspans.LOWER[data]
    starts, lengths, owner = wordspans.words_of(data, offsets, wordspans.ALNUM)
    size = np.bincount(owner, minlength=len(texts))
    number = vocabulary.find(data, starts, lengths)
    known = number >= 0
    pairs, tf = np.unique(owner[known] * max(len(vocabulary), 1) + number[known], return_counts=True)
    return size, pairs // max(len(vocabulary), 1), pairs % max(len(vocabulary), 1), tf


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def impacts(weight: np.ndarray, tf: np.ndarray, size: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """w * ((10^9 tf) div (1000 tf + 20 m)), m = 50 + (50 n N) div L, in 64-bit whole numbers."""
    # n * N leaves 64 bits only where the corpus itself would; Python's whole numbers are used there.
    product = 50 * size.astype(object) * documents if int(size.max(initial=0)) * 50 * documents >= 1 << 63 else 50 * size.astype(np.int64) * documents
    m = 50 + (product // max(terms, 1)).astype(np.int64)
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


@dataclass(frozen=True)
class Statistics:
    documents: int
    terms: int
    frequency: dict[int, int]


def statistics(docs: DataFrame, text: str, vocabulary: Vocabulary) -> Statistics:
    """Documents with a term, all their terms, and the document frequency of the vocabulary's terms, from one pass."""
    schema = pa.schema([("term", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary) + 2, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                size, _, term, _ = term_counts(part.column(0), vocabulary)
                total[:-2] += np.bincount(term, minlength=len(vocabulary))
                total[-2:] += (int((size > 0).sum()), int(size.sum()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-2, len(vocabulary))), pa.array(np.roll(total, 2))], schema=schema).filter(pa.array(np.roll(total, 2) > 0))

    own = bounded_batches(docs.select(F.col(quoted(text)).alias("__text")))
    rows = {r.term: r.n for r in own.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return Statistics(rows.pop(-2, 0), rows.pop(-1, 0), rows)


def _shard_best(treap_parts: list, weights: np.ndarray, row_of: np.ndarray, items: dict, known: Statistics, k: int, best: dict) -> None:
    """Search one shard for every item; `best` keeps each item's k best of the task as (score, null id, id)."""
    ids, nulls = np.concatenate([p[0] for p in treap_parts]), np.concatenate([p[1] for p in treap_parts])
    size = np.concatenate([p[2] for p in treap_parts])
    shift = np.cumsum([0, *[len(p[0]) for p in treap_parts[:-1]]])
    text = np.concatenate([p[3] + s for p, s in zip(treap_parts, shift)])
    term, tf = np.concatenate([p[4] for p in treap_parts]), np.concatenate([p[5] for p in treap_parts])
    by_id = np.lexsort((ids, nulls))
    # Columns go by length, so that impacts in neighbouring columns are of one size; ties are told by id.
    order = np.argsort(size, kind="stable")
    column, tie = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    column[order] = np.arange(len(order))
    tie[column[by_id]] = np.arange(len(order))
    value = impacts(weights[term], tf, size[text], known.documents, known.terms)
    treap = Treap(row_of[term[value > 0]], column[text[value > 0]], value[value > 0])
    for item, rows in items.items():
        own = best.setdefault(item, [])
        scores, columns = treap.best(rows, k, own[-1][0] if len(own) == k else 1, tie)
        found = order[columns]
        own += zip(scores.tolist(), nulls[found].tolist(), ids[found].tolist())
        own.sort(key=lambda x: (-x[0], x[1], x[2]))
        del own[k:]


def _search_block(docs: DataFrame, id_col: str, text: str, pairs: list, k: int, shard: int, cells: int) -> DataFrame:
    terms = sorted({t for _, t in pairs})
    number = {t: i for i, t in enumerate(terms)}
    vocabulary = Vocabulary([t.encode("utf-8", "surrogatepass") for t in terms])
    known = statistics(docs, text, vocabulary)
    weights = np.array([term_weight(known.documents, known.frequency[i]) if i in known.frequency else 0 for i in range(len(terms))], np.int64)
    own: dict[int, list] = {}
    for item, term in pairs:
        if weights[number[term]] > 0:
            own.setdefault(item, []).append(number[term])
    # Rows of like weight lie together, and of one item where weights are equal: bounds of their common cells are then close.
    first_item = np.zeros(len(terms), np.int64)
    for i, item in enumerate(sorted(own, reverse=True)):
        first_item[own[item]] = len(own) - i
    row_of = np.empty(len(terms), np.int64)
    row_of[np.lexsort((first_item, -weights))] = np.arange(len(terms))
    items = {item: np.sort(row_of[np.array(t)]) for item, t in own.items()}
    schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list] = {}
        parts, n, filled = [], 0, 0
        for batch in batches:
            for part in slices(batch, 1):
                for start in range(0, part.num_rows, shard):
                    some = part.slice(start, shard)
                    size, owner, term, tf = term_counts(some.column(1), vocabulary)
                    if n and (n + some.num_rows > shard or filled + len(term) > cells):
                        _shard_best(parts, weights, row_of, items, known, k, best)
                        parts, n, filled = [], 0, 0
                    ids = some.column(0)
                    nulls = ids.is_null().to_numpy(zero_copy_only=False)
                    parts.append((ids.fill_null(0).to_numpy(), nulls, size, owner, term, tf))
                    n, filled = n + some.num_rows, filled + len(term)
        if parts:
            _shard_best(parts, weights, row_of, items, known, k, best)
        rows = [(item, None if null else doc, score) for item, found in best.items() for score, null, doc in found]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)

    source = docs.select(F.col(quoted(id_col)).cast("long").alias("__id"), F.col(quoted(text)).alias("__text"))
    return bounded_batches(source).mapInArrow(run, "item_id long, doc_id long, score long")


def item_terms(items: DataFrame, id_col: str, text: str) -> DataFrame:
    """The distinct (item_id, term) pairs."""
    low = F.translate(F.col(quoted(text)), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(low, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))
    return (items.select(F.col(quoted(id_col)).cast("long").alias("item_id"), F.explode(words).alias("term"))
            .where(F.col("item_id").isNotNull()).distinct())


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id", item_text: str = "text",
           k: int = 50, shard: int = SHARD, cells: int = CELLS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id and score of the k highest-scoring documents of every item."""
    pairs = item_terms(items, item_col, item_text)
    total = pairs.count()
    blocks = max(1, -(-2 * total // block_terms)) if total > block_terms else 1
    found = None
    for block in range(blocks):
        some = pairs if blocks == 1 else pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        part = _search_block(docs, id_col, text, [(r.item_id, r.term) for r in some.collect()], k, shard, cells)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
