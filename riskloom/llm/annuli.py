"""Exact top-k inner products through a pivot-distance index.

Vectors are made whole numbers, floor(scale * x). One more coordinate, sqrt(M^2 - |x|^2) with M
the greatest length, puts all of them on one sphere; a query is brought to length M with 0
there. Its inner product with x then falls as their distance grows, so the best scores are the
nearest points and the triangle inequality holds.

Index: every vector is keyed by its nearest pivot and by the ring (`annulus`) of its distance to
that pivot, `block` rows a ring as far as distances spread. Pivots are the centres of a few
rounds of k-means on a bounded sample; they decide the work, not the result. A query orders all
rings by the least distance that the triangle inequality leaves open,
max(0, r_low - d(q, p), d(q, p) - r_high), and visits them in steps of growing size. After each
step its k-th best score gives a radius; it is done when the next ring lies beyond. The last
step visits every ring that the radius still reaches, so the result is exact.

A ring with many rows (copies of one vector) is split over tasks by a hash of the id, one with
many queries likewise, and a task returns at most k rows a query. The work grows with queries x
rings within the radius x block: pivots help where vectors form groups; where they lie evenly in
many dimensions, nearly all rings are within reach and the search is a blocked full one.

Defined cases: rows with a null id and vectors that are null, empty or hold a null or non-finite
component take no part, nor do those with a component whose multiple leaves 2^53; only vectors
of equal length are compared; zero vectors take part (score 0); scores are exact in 64 bits;
an id given more than once counts once, with its best vector; rows with the query's id are not
its neighbours; equal scores go to the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.batches import bounded_batches, quoted
from riskloom.session import cut_lineage

RING = ["dim", "pivot", "ring"]
#: Rings a query has visited after each step but the last.
STEPS = (4, 48)
#: Keys over which the rows of one ring are spread before they are dealt.
SALTS = 32
#: Share of M that rounding may shift a distance by, far above what it does.
SLACK = 1e-5
_PLACED = "id long, dim int, pivot int, ring long, vec binary"
_ASKED = "id long, dim int, pivot int, ring long, vec binary, floor long"
_FOUND = "query_id long, vec_id long, score long"


@dataclass(frozen=True)
class Index:
    """What all tasks know: the sphere's radius, and per dimension the pivots (rows) with ring width and last ring."""

    radius: float
    pivots: dict[int, np.ndarray]
    widths: dict[int, np.ndarray]
    spans: dict[int, np.ndarray]


def whole_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """id and vec (whole numbers as doubles) of the rows that take part."""
    raw = F.transform(F.col(quoted(vec_col)), lambda x: x.cast("double"))
    sound = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * scale < float(1 << 53)))
    return (df.select(F.col(quoted(id_col)).cast("long").alias("id"), raw.alias("raw"))
            .where(F.col("id").isNotNull() & (F.size("raw") > 0) & sound)
            .select("id", F.transform("raw", lambda x: F.floor(x * scale).cast("double")).alias("vec")))


def _lifted(x: np.ndarray, radius: float) -> np.ndarray:
    """Points on the sphere: one more coordinate."""
    return np.concatenate([x, np.sqrt(np.maximum(radius**2 - (x**2).sum(axis=1), 0))[:, None]], axis=1)


def _aimed(q: np.ndarray, radius: float) -> np.ndarray:
    """Queries on the sphere: brought to its radius, 0 in the new coordinate; a zero query stays."""
    length = np.sqrt((q**2).sum(axis=1, keepdims=True))
    return np.concatenate([np.divide(q * radius, length, out=np.zeros_like(q), where=length > 0), np.zeros((len(q), 1))], axis=1)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def _centres(x: np.ndarray, count: int, rounds: int = 6) -> np.ndarray:
    """k-means centres, from rows spread evenly over the sample."""
    centres = x[np.linspace(0, len(x) - 1, count).astype(int)].copy()
    for _ in range(rounds):
        near = distances(x, centres).argmin(axis=1)
        for p in np.unique(near):
            centres[p] = x[near == p].mean(axis=0)
    return np.unique(centres, axis=0)


def _by_dim(batches: Iterator[pa.RecordBatch], part: int = 2048) -> Iterator[tuple]:
    """(dim, row numbers, matrix, batch) for the vectors of equal length of each part of a batch; column 1 holds them."""
    for batch in batches:
        for start in range(0, batch.num_rows, part):
            some = batch.slice(start, part)
            vecs = some.column(1)
            flat, sizes = vecs.flatten().to_numpy(zero_copy_only=False), np.diff(np.asarray(vecs.offsets))
            begins = np.cumsum(sizes) - sizes
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                yield int(dim), rows, flat[begins[rows][:, None] + np.arange(dim)], some


def _packed(x: np.ndarray) -> pa.Array:
    """One binary value per row: 64-bit whole numbers, or 16-bit ones where that is enough (told by the length)."""
    small = np.abs(x).max(initial=0) < 1 << 15
    rows = np.ascontiguousarray(x.astype("<i2" if small else "<i8"))
    size = rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * size), pa.py_buffer(rows)])


def _unpacked(values: pa.Array, dim: int) -> np.ndarray:
    out = np.empty((len(values), dim), np.int64)
    sizes = np.asarray(pc.binary_length(values))
    for kind in ("<i2", "<i8"):
        own = np.flatnonzero(sizes == dim * np.dtype(kind).itemsize)
        if len(own):
            out[own] = np.frombuffer(b"".join(values.take(pa.array(own)).to_pylist()), kind).reshape(-1, dim)
    return out


def fit(points: DataFrame, pivots: int, sample_rows: int, block: int) -> Index:
    """Pivots and ring widths from about `sample_rows` vectors chosen by a hash; ring spans from all."""
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    rows, longest, most = points.agg(F.count("*"), F.max(square), F.max(F.size("vec"))).first()
    if not rows:
        return Index(0.0, {}, {}, {})
    radius = math.sqrt(longest) * (1 + 1e-9)
    # Sampled values are bounded as well: 16 million components at most.
    share = min(1.0, min(sample_rows, (1 << 24) // most + 1) / rows)
    sample = points.where(F.pmod(F.xxhash64("id", "vec"), F.lit(1 << 32)) < int(share * (1 << 32))).select("vec").collect()
    own: dict[int, list] = {}
    for r in sample:
        own.setdefault(len(r.vec), []).append(r.vec)
    centres, widths = {}, {}
    for dim, vecs in own.items():
        x = _lifted(np.array(vecs), radius)
        x = x[np.lexsort(x.T[::-1])]
        centres[dim] = _centres(x, min(pivots, max(1, len(x) // 32)))
        away = distances(x, centres[dim])
        near, own_distance = away.argmin(axis=1), away.min(axis=1)
        width = []
        for p in range(len(centres[dim])):
            at = own_distance[near == p]
            spread = float(at.max() - at.min()) if len(at) else 0.0
            rings = max(1.0, len(at) * (rows / len(sample)) / block)
            width.append(max(spread / rings, radius * 1e-6, 1e-9))
        widths[dim] = np.array(width)
    index = Index(radius, centres, widths, {})
    spans = {dim: np.full((len(c), 2), [1, 0], np.int64) for dim, c in centres.items()}
    known = F.col("dim").isin(*centres) if centres else F.lit(False)
    for r in place(points, index).where(known).groupBy("dim", "pivot").agg(F.min("ring").alias("low"), F.max("ring").alias("high")).collect():
        spans[r.dim][r.pivot] = (r.low, r.high)
    return Index(radius, centres, widths, spans)


def place(points: DataFrame, index: Index) -> DataFrame:
    """One row per vector: dim, pivot, ring and the packed vector. A dimension that the sample missed is one ring."""
    schema = pa.schema([("id", pa.int64()), ("dim", pa.int32()), ("pivot", pa.int32()), ("ring", pa.int64()), ("vec", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, rows, x, some in _by_dim(batches):
            near, ring = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
            if dim in index.pivots:
                away = distances(_lifted(x, index.radius), index.pivots[dim])
                near = away.argmin(axis=1)
                ring = np.floor(away[np.arange(len(rows)), near] / index.widths[dim][near]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [some.column(0).take(pa.array(rows)), pa.array(np.full(len(rows), dim, np.int32)), pa.array(near.astype(np.int32)), pa.array(ring), _packed(x)], schema=schema)

    return bounded_batches(points).mapInArrow(run, _PLACED)


def rings_in_order(q: np.ndarray, index: Index, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pivot, ring and least possible distance of every ring that may hold rows, nearest first."""
    spans, widths = index.spans[dim], index.widths[dim]
    sizes = np.maximum(spans[:, 1] - spans[:, 0] + 1, 0)
    pivot = np.repeat(np.arange(len(sizes)), sizes)
    ring = np.arange(len(pivot)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + spans[pivot, 0]
    away = distances(q[None], index.pivots[dim])[0][pivot]
    low, high = ring * widths[pivot], (ring + 1) * widths[pivot]
    least = np.maximum(np.maximum(low - away, away - high), 0)
    # Rings that hold the query's own distance are all at 0; the nearest pivot goes first.
    order = np.lexsort((ring, away, least))
    return pivot[order], ring[order], least[order]


def _ask(queries: DataFrame, index: Index, begin: int, end: int | None) -> DataFrame:
    """A row per query (id, vec, floor) and ring in places [begin, end) of its order, as far as its radius reaches."""
    schema = pa.schema([("id", pa.int64()), ("dim", pa.int32()), ("pivot", pa.int32()), ("ring", pa.int64()), ("vec", pa.binary()), ("floor", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, rows, q, some in _by_dim(batches, 256):
            ids, floors = some.column(0).to_numpy()[rows], some.column(2).take(pa.array(rows)).to_pylist()
            packed = _packed(q)
            aimed = _aimed(q, index.radius)
            for i in range(len(rows)):
                if dim not in index.pivots:
                    pivot, ring = (np.zeros(1 if begin == 0 else 0, np.int64),) * 2
                else:
                    pivot, ring, least = rings_in_order(aimed[i], index, dim)
                    pivot, ring, least = pivot[begin:end], ring[begin:end], least[begin:end]
                    length = math.sqrt((q[i] ** 2).sum())
                    if floors[i] is not None and length > 0:
                        # Scores of at least the floor are within this distance on the sphere.
                        square = 2 * index.radius**2 - 2 * index.radius / length * floors[i]
                        reach = math.sqrt(max(square, 0.0)) + SLACK * index.radius
                        pivot, ring = pivot[least <= reach], ring[least <= reach]
                n = len(pivot)
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, ids[i])), pa.array(np.full(n, dim, np.int32)), pa.array(pivot.astype(np.int32)), pa.array(ring),
                         packed.take(pa.array(np.full(n, i))), pa.array([floors[i]] * n, pa.int64())], schema=schema)

    return bounded_batches(queries).mapInArrow(run, _ASKED)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: in doubles as long as every sum stays below 2^53."""
    if float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1] < 1 << 53:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    return q @ x.T


def _compare(k: int, budget: int = 1 << 22):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(points: pa.Table, queries: pa.Table) -> pa.Table:
        if not points.num_rows or not queries.num_rows:
            return schema.empty_table()
        dim = points["dim"][0].as_py()
        ids, asked = points["id"].to_numpy(), queries["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], _unpacked(points["vec"].combine_chunks(), dim)[order]
        q, floors = _unpacked(queries["vec"].combine_chunks(), dim), queries["floor"].fill_null(-(1 << 63)).to_numpy()
        found, distinct = [], len(np.unique(ids)) == len(ids)
        step = max(1, budget // len(ids))
        for start in range(0, len(asked), step):
            score = products(q[start : start + step], x)
            for row, query, floor in zip(score, asked[start : start + step], floors[start : start + step]):
                good = np.flatnonzero((row >= floor) & (ids != query))
                if distinct and len(good) > k:
                    good = good[row[good] >= np.partition(row[good], len(good) - k)[len(good) - k]]
                good = good[np.argsort(-row[good], kind="stable")]
                if not distinct:
                    good = good[np.sort(np.unique(ids[good], return_index=True)[1])]
                good = good[:k]
                found.append((np.full(len(good), query), ids[good], row[good]))
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], schema=schema)

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def _visit(placed: DataFrame, asked: DataFrame, k: int, block: int, together: int) -> DataFrame:
    """Compare the asked queries with the rings' rows; both sides of a crowded ring are dealt over several tasks."""
    parts = lambda df, name, size: df.groupBy(*RING).agg(F.ceil(F.count("*") / size).cast("int").alias(name))
    # Rows meet their ring's numbers under one of SALTS keys, so that a crowded ring isn't one task here either.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    dealt = parts(placed, "blocks", block).join(parts(asked, "groups", together), RING).select("*", salts)
    code = F.xxhash64("id", "vec")
    numbered = lambda df: df.withColumn("salt", F.pmod(F.shiftright(code, 32), SALTS).cast("int")).join(dealt, [*RING, "salt"])
    part = lambda of: F.pmod(code, of).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    left = numbered(placed).select(*RING, part("blocks").alias("block"), every("groups").alias("group"), "id", "vec")
    right = numbered(asked).select(*RING, every("blocks").alias("block"), part("groups").alias("group"), "id", "vec", "floor")
    keys = [*RING, "block", "group"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_compare(k), _FOUND)


def top_products(points: DataFrame, queries: DataFrame, id_col: str, vec_col: str, k: int = 10, scale: int = 1024, pivots: int = 64,
                 sample_rows: int = 8192, block: int = 4096, together: int = 2048, steps: tuple[int, ...] = STEPS) -> DataFrame:
    """query_id, rank, vec_id and score of the k points with the greatest inner product with each query."""
    points, queries = whole_vectors(points, id_col, vec_col, scale), whole_vectors(queries, id_col, vec_col, scale)
    index = fit(points, pivots, sample_rows, block)
    placed = cut_lineage(place(points, index))
    waiting = queries.withColumn("floor", F.lit(None).cast("long"))
    found, begin = None, 0
    for end in (*steps, None):
        asked = cut_lineage(_ask(waiting, index, begin, end))
        if begin and asked.isEmpty():
            break
        more = _visit(placed, asked, k, block, together)
        found = cut_lineage(_best(more if found is None else found.select("query_id", "vec_id", "score").unionByName(more), k))
        kth = found.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
        waiting = queries.join(kth, "id", "left").select("id", "vec", "floor")
        begin = end
    return found
