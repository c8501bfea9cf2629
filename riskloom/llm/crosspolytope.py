"""Approximate nearest neighbours by cross-polytope hashing.

Each of `tables` hash functions rotates a unit vector by three rounds of random signs
and a fast Hadamard transform; its bucket is the nearest signed axis. A query looks
into the `probes` nearest axes of every table; what lies there is compared exactly.

Recall holds for vectors of similar length (the hash sees directions only). Work grows
with queries x tables x probes / axes x rows; points meet a query in blocks of at most
`block` rows, so a crowded bucket (copies of one vector) is spread over many tasks, and
each block returns at most k rows for a query. Every candidate is compared, none capped.

Defined cases: rows with a null id, and vectors that are null, empty, zero or hold a
null or non-finite component take no part; only vectors of equal length are compared;
an id given more than once counts once, at its nearest vector; rows with the query's id
are not its neighbours; equal distances go to the smaller id; a query that finds fewer
than k rows looks into all buckets of one table, which is exhaustive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.batches import bounded_batches, quoted
from riskloom.session import cut_lineage

KEYS = ["dim", "table", "bucket", "block"]
_PLACED = "id long, dim int, table int, bucket int, vec binary"


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform along the last axis (a power of two), orthonormal."""
    n, half = rows.shape[1], 1
    while half < n:
        pairs = rows.reshape(len(rows), -1, 2, half)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(rows), n)
        half *= 2
    return rows / np.sqrt(n)


def rotations(dim: int, tables: int, seed: int) -> np.ndarray:
    """Random signs, tables x 3 x (dim rounded up to a power of two)."""
    width = 1 << max(dim - 1, 1).bit_length()
    return np.random.default_rng([seed, dim]).choice([-1.0, 1.0], (tables, 3, width))


def rotate(vectors: np.ndarray, signs: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(vectors), signs.shape[1]))
    wide[:, : vectors.shape[1]] = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    for sign in signs:
        wide = hadamard(wide * sign)
    return wide


def _axes(rotated: np.ndarray, probes: int) -> np.ndarray:
    """The `probes` nearest signed axes of each row, nearest first."""
    signed = np.concatenate([rotated, -rotated], axis=1)
    return np.argsort(-signed, axis=1, kind="stable")[:, :probes]


def _valid(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    vec = F.transform(F.col(quoted(vec_col)), lambda x: x.cast("double"))
    usable = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (df.select(F.col(quoted(id_col)).cast("long").alias("id"), vec.alias("vec"))
            .where(F.col("id").isNotNull() & (F.size("vec") > 0) & usable & F.exists("vec", lambda x: x != 0)))


def _placed(valid: DataFrame, tables: int, probes: int | None, seed: int) -> DataFrame:
    """One row per vector, table and probed bucket; probes=None: all buckets."""
    schema = pa.schema([("id", pa.int64()), ("dim", pa.int32()), ("table", pa.int32()), ("bucket", pa.int32()), ("vec", pa.binary())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                ids, vecs = part.column(0).to_numpy(), part.column(1)
                flat, sizes = vecs.flatten().to_numpy(zero_copy_only=False), np.diff(np.asarray(vecs.offsets))
                begins = np.cumsum(sizes) - sizes
                for dim in np.unique(sizes):
                    rows = np.flatnonzero(sizes == dim)
                    x = flat[begins[rows][:, None] + np.arange(dim)]
                    packed = np.array([r.tobytes() for r in x], dtype=object)
                    for t, signs in enumerate(rotations(int(dim), tables, seed)):
                        axes = _axes(rotate(x, signs), 2 * signs.shape[1] if probes is None else probes)
                        n = axes.size
                        again = np.repeat(np.arange(len(rows)), axes.shape[1])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids[rows][again]), pa.array(np.full(n, dim, np.int32)), pa.array(np.full(n, t, np.int32)),
                             pa.array(axes.ravel().astype(np.int32)), pa.array(packed[again], pa.binary())], schema=schema)

    return bounded_batches(valid).mapInArrow(place, _PLACED)


def _nearest(k: int, budget: int = 1 << 21):
    """The k nearest points of a block for each query in it, distances in double precision."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def compare(points: pa.Table, queries: pa.Table) -> pa.Table:
        if not points.num_rows or not queries.num_rows:
            return schema.empty_table()
        ids = points["id"].to_numpy()
        x = np.frombuffer(b"".join(points["vec"].to_pylist())).reshape(len(ids), -1)
        asked = queries["id"].to_numpy()
        q = np.frombuffer(b"".join(queries["vec"].to_pylist())).reshape(len(asked), -1)
        found, distinct = [], len(np.unique(ids)) == len(ids)
        step = max(1, budget // x.size)
        for start in range(0, len(asked), step):
            score = np.sqrt(((q[start : start + step, None] - x[None]) ** 2).sum(axis=-1))
            for row, query in zip(score, asked[start : start + step]):
                near = np.flatnonzero(ids != query)
                if distinct and len(near) > k:
                    near = near[row[near] <= np.partition(row[near], k - 1)[k - 1]]
                near = near[np.lexsort((ids[near], row[near]))]
                if not distinct:
                    near = near[np.sort(np.unique(ids[near], return_index=True)[1])]
                near = near[:k]
                found.append((np.full(len(near), query), ids[near], row[near]))
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], schema=schema)

    return compare


def _search(points: DataFrame, queries: DataFrame, k: int, tables: int, probes: int | None, seed: int, block: int) -> DataFrame:
    placed = _placed(points, tables, 1, seed)
    blocks = placed.groupBy("dim", "table", "bucket").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    keys = ["dim", "table", "bucket"]
    left = placed.join(blocks, keys).select(*keys, F.pmod(F.xxhash64("id", "vec"), "blocks").cast("int").alias("block"), "id", "vec")
    right = (_placed(queries, tables, probes, seed).join(blocks, keys)
             .select(*keys, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "id", "vec"))
    near = left.groupBy(*KEYS).cogroup(right.groupBy(*KEYS)).applyInArrow(_nearest(k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def nearest_neighbours(points: DataFrame, queries: DataFrame, id_col: str, vec_col: str, k: int = 10,
                       tables: int = 12, probes: int = 10, seed: int = 7, block: int = 4096) -> DataFrame:
    """The k nearest found points of each query: query_id, rank, vec_id, score (Euclidean distance)."""
    points, queries = _valid(points, id_col, vec_col), _valid(queries, id_col, vec_col)
    found = cut_lineage(_search(points, queries, k, tables, probes, seed, block))
    enough = found.where(F.col("rank") == k).select(F.col("query_id").alias("id"))
    short = cut_lineage(queries.join(enough, "id", "left_anti"))
    if short.isEmpty():
        return found
    again = _search(points, short, k, 1, None, seed, block)
    return found.join(short.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(again)
