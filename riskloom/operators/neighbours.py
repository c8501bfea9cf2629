"""Exact nearest neighbours of dense vectors, block by block.

Rows belong to the ball of their nearest pivot and, inside it, to a ring of their distance
to that pivot; a ring with more rows than a block is dealt by a hash. A block first searches
itself, which bounds each row's search radius. A row then has to look into another ring only
if the triangle inequality leaves room for a nearer row:

* the ring's distances to its pivot come within the radius of the row's own distance;
* the plane half way between its own pivot and the other one comes within the radius
  (every row of a ball is nearest to its pivot, so a ball lies on its pivot's side);
* for none of several reference pivots the block's span of distances is farther from the
  row's distance than the radius;
* the box around the block's rows comes within the radius.

Blocks meet as whole packed rows, so a pair of blocks is one matrix product; blocks travel in tiles, so
that what is shuffled grows with the pairs of tiles. A product only
selects, in single precision with its error bound added, distances come from differences. A visit returns at most k rows for a row, and no row
is left out: every skipped block is proven to hold no nearer one. Rows that lie evenly in many
dimensions leave little to skip; the work is then that of all pairs of blocks.

Rows with a null ID or vector take no part. Ties go to the smaller ID.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import cut_lineage

# tasks get these functions by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 4096
#: pivots at most, rows they are chosen from, and how many of them bound a block from all sides
PIVOTS, SAMPLE_ROWS, REFERENCES = 256, 8192, 16
#: blocks that meet blocks of another tile in one task, at most
TILE_BLOCKS = 32
#: products of two blocks are formed for this many rows at once
_CHUNK = 512
#: rounding may move a computed distance by this share of the largest vector's length
_ROUNDING = 1e-7
_BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20)}
_FOUND = "ID long, neighbour long, distance double"


@dataclass(frozen=True)
class Pivots:
    """Centres (one a row), ring width per centre, and the length of the longest vector."""

    centres: np.ndarray
    widths: np.ndarray
    longest: float

    @property
    def slack(self) -> float:
        return _ROUNDING * self.longest + 1e-12


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All distances by one product; good to about 1e-8 of the vectors' length."""
    square = (x ** 2).sum(axis=1)[:, None] + (y ** 2).sum(axis=1)[None, :] - 2 * x @ y.T
    return np.sqrt(np.maximum(square, 0))


def choose_pivots(x: np.ndarray, count: int, rounds: int = 5) -> np.ndarray:
    """Centres of a few rounds of k-means, the first starts spread over the sample."""
    centres = x[np.linspace(0, len(x) - 1, count).astype(int)].copy()
    for _ in range(rounds):
        nearest = distances(x, centres).argmin(axis=1)
        for p in np.unique(nearest):
            centres[p] = x[nearest == p].mean(axis=0)
    return np.unique(centres, axis=0)


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int64()), pa.array([np.einsum("ij,ij->i", x, x).max()])], names=["rows", "longest"])


def fit_pivots(vectors: DataFrame, rows_per_block: int, sample_rows: int = SAMPLE_ROWS) -> Pivots:
    """Pivots from a hash sample of bounded size; as many as there are blocks, at most PIVOTS."""
    rows, longest = vectors.select("x").mapInArrow(_lengths, "rows long, longest double").agg(F.sum("rows"), F.max("longest")).first()
    if not rows:
        return Pivots(np.zeros((1, 1)), np.ones(1), 0.0)
    share = min(1.0, sample_rows / rows)
    code = F.pmod(F.xxhash64("ID"), F.lit(1 << 32))
    sample = np.array([r["x"] for r in vectors.filter(code < int(share * (1 << 32))).select("x").collect()] or
                      [r["x"] for r in vectors.select("x").limit(1).collect()], dtype=float)
    sample = sample[np.lexsort(sample.T[::-1])]
    longest = math.sqrt(longest)
    centres = choose_pivots(sample, min(PIVOTS, len(sample), max(1, math.ceil(rows / rows_per_block))))
    away = distances(sample, centres)
    nearest, own = away.argmin(axis=1), away.min(axis=1)
    widths = []
    for p in range(len(centres)):
        inside = own[nearest == p]
        rings = max(1.0, len(inside) * rows / len(sample) / rows_per_block)
        widths.append(max((inside.max() if len(inside) else 0.0) / rings, longest * 1e-6, 1e-9))
    return Pivots(centres, np.array(widths), longest)


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of arrays of one length as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _place(vectors: DataFrame, pivots: Pivots) -> DataFrame:
    schema = pa.schema([("ID", pa.int64()), ("x", pa.list_(pa.float64())), ("ball", pa.int32()), ("ring", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                away = distances(_matrix(batch.column(1)), pivots.centres)
                ball = away.argmin(axis=1)
                ring = np.floor(away.min(axis=1) / pivots.widths[ball]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(ball.astype(np.int32)), pa.array(ring)], schema=schema)

    return vectors.mapInArrow(run, "ID long, x array<double>, ball int, ring long")


@dataclass(frozen=True)
class Targets:
    """Rows to search in: as they are, and for single products moved to their centre, with two more entries a column."""

    ids: np.ndarray
    x: np.ndarray
    centre: np.ndarray
    columns: np.ndarray
    length: float

    @classmethod
    def of(cls, ids: np.ndarray, x: np.ndarray) -> Targets:
        with np.errstate(all="ignore"):
            centre = x.mean(axis=0)
            moved = (x - centre).T
            square = (moved ** 2).sum(axis=0)
            columns = np.vstack([moved, -square / 2, np.ones(len(x))]).astype("float32")
        return cls(ids, x, centre, columns, math.sqrt(square.max(initial=0)))

    def scores(self, part: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Per pair half of (reach^2 - distance^2), raised by the bound of its rounding, and that bound per row;
        None where single numbers don't hold the values."""
        with np.errstate(all="ignore"):
            moved = part - self.centre
            square = (moved ** 2).sum(axis=1)
            far = np.sqrt(square) + self.length
            if len(far) and not (far.min() > 1e-12 and far.max() < 1e15):
                return None
            reach = np.minimum(reach, far)
            error = (part.shape[1] + 8) * 2.0 ** -23 * (far ** 2 + reach ** 2)
            rows = np.column_stack([moved, np.ones(len(part)), (reach ** 2 - square) / 2 + error]).astype("float32")
        return rows @ self.columns, error


def _candidates(part: np.ndarray, targets: Targets, k: int, reach: np.ndarray, own: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of every pair within `reach` that may be among the k nearest of its row; `own` is the column of the first row itself."""
    diagonal = (np.arange(len(part)), np.arange(len(part)) + (own or 0))
    width = len(targets.ids)
    made = targets.scores(part, reach)
    if made is not None:
        score, error = made
        if own is not None:
            score[diagonal] = -np.inf
        hit = score >= 0
        if width > k and np.count_nonzero(hit) > 4 * k * len(part):
            hit &= score >= (np.partition(score, width - k, axis=1)[:, width - k] - 2 * error).astype("float32")[:, None]
        return np.divmod(np.flatnonzero(hit), width)
    gap = distances(part, targets.x)
    if own is not None:
        gap[diagonal] = np.inf
    slack = 1e-7 * math.sqrt(max((part ** 2).sum(axis=1).max(initial=0), (targets.x ** 2).sum(axis=1).max(initial=0))) + 1e-12
    if width > k:
        reach = np.minimum(reach, np.partition(gap, k - 1, axis=1)[:, k - 1])
    return np.nonzero((gap <= (reach + slack)[:, None]) & np.isfinite(gap))


def closest(x: np.ndarray, targets: Targets, k: int, reach: np.ndarray | None = None, same: bool = False):
    """Targets among the k nearest of each row of `x`, within `reach`: (row of x, ID, distance), ties by ID.

    Products pick the candidates, a little more than needed; their distances are then
    computed from differences, so equal vectors get exactly equal distances.
    """
    found = []
    for start in range(0, len(x), _CHUNK):
        part = x[start:start + _CHUNK]
        limit = np.full(len(part), np.inf) if reach is None else reach[start:start + _CHUNK]
        row, column = _candidates(part, targets, k, limit, start if same else None)
        exact = np.empty(len(row))
        for some in range(0, len(row), 1 << 16):
            piece = slice(some, some + (1 << 16))
            exact[piece] = np.sqrt(((part[row[piece]] - targets.x[column[piece]]) ** 2).sum(axis=1))
        ids = targets.ids[column]
        keep, row = _best(row, ids, exact, k)
        found.append((row + start, ids[keep], exact[keep]))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, "int64"), np.zeros(0))


def _best(row: np.ndarray, ids: np.ndarray, gap: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the k nearest of each row, ties by ID, in that order, and their rows."""
    order = np.lexsort((ids, gap, row))
    row = row[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return order[keep], row[keep]


_PACKED = "block long, ball int, ring long, n int, ids binary, x binary, reach binary, low array<double>, high array<double>, near array<struct<ID:long,neighbour:long,distance:double>>"


def pack_blocks(vectors: DataFrame, k: int, rows_per_block: int, pivots: Pivots) -> DataFrame:
    """One row per block: its rows packed, their neighbours inside it, and how far each still has to look."""
    placed = cut_lineage(_place(vectors, pivots))
    sizes = placed.groupBy("ball", "ring").agg(F.ceil(F.count(F.lit(1)) / rows_per_block).cast("int").alias("parts"))
    # a crowded ring is spread over several keys before it meets its size
    salt = F.pmod(F.xxhash64("ID", F.lit(1)), F.lit(32)).cast("int")
    sizes = sizes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(31))))
    dealt = placed.withColumn("_salt", salt).join(sizes, ["ball", "ring", "_salt"]).select(
        "ID", "x", "ball", "ring", F.pmod(F.xxhash64("ID"), "parts").cast("int").alias("part"))
    references = pivots.centres[:REFERENCES]

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("ID")
        ids, x = table["ID"].to_numpy(), _matrix(table["x"])
        row, near, gap = closest(x, Targets.of(ids, x), k, same=True)
        full = np.bincount(row, minlength=len(ids)) >= k
        reach = np.full(len(ids), np.inf)
        last = np.searchsorted(row, np.arange(len(ids)), side="right") - 1
        reach[full] = gap[last[full]]
        away = distances(x, references)
        ball, ring, part = (table[c][0].as_py() for c in ("ball", "ring", "part"))
        return pa.Table.from_pylist([{
            "block": int(ids[0]), "ball": ball, "ring": ring, "n": len(ids), "ids": ids.tobytes(), "x": x.tobytes(),
            "reach": reach.tobytes(), "low": away.min(axis=0).tolist(), "high": away.max(axis=0).tolist(),
            "near": [{"ID": a, "neighbour": b, "distance": c} for a, b, c in zip(ids[row].tolist(), near.tolist(), gap.tolist())],
        }], schema=pa.schema([
            ("block", pa.int64()), ("ball", pa.int32()), ("ring", pa.int64()), ("n", pa.int32()), ("ids", pa.binary()), ("x", pa.binary()),
            ("reach", pa.binary()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())),
            ("near", pa.list_(pa.struct([("ID", pa.int64()), ("neighbour", pa.int64()), ("distance", pa.float64())])))]))

    return cut_lineage(dealt.groupBy("ball", "ring", "part").applyInArrow(pack, _PACKED))


def _unpack(ids: pa.Scalar, x: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(ids.as_buffer(), "int64")
    return numbers, np.frombuffer(x.as_buffer(), "float64").reshape(len(numbers), -1)


def ball_radii(blocks: DataFrame, pivots: Pivots, k: int) -> np.ndarray:
    """Per pivot a distance within which its ball holds more than k rows; infinite where it holds fewer."""
    order = Window.partitionBy("ball").orderBy("ring")
    reached = blocks.groupBy("ball", "ring").agg(F.sum("n").alias("n")).withColumn("n", F.sum("n").over(order))
    radii = np.full(len(pivots.centres), np.inf)
    for r in reached.filter(F.col("n") > k).groupBy("ball").agg(F.min("ring").alias("ring")).collect():  # one row per pivot
        radii[r["ball"]] = (r["ring"] + 1) * pivots.widths[r["ball"]]
    return radii


def _bounded(reach: np.ndarray, x: np.ndarray, pivots: Pivots, radii: np.ndarray) -> np.ndarray:
    """A row that found too few rows in its block still has k within its way to a pivot and on to that ball's rows."""
    reach = reach.copy()
    short = np.isinf(reach)
    if short.any():
        reach[short] = (distances(x[short], pivots.centres) + radii).min(axis=1)
    return reach + pivots.slack


def _planes(away: np.ndarray, home: int, pivots: Pivots) -> np.ndarray:
    """Per row of the ball `home` and other ball: no row of that ball is nearer than this, the distance of the plane between
    both pivots. A ball was told by rounded distances; what that may move the plane is taken off."""
    apart = distances(pivots.centres[home:home + 1], pivots.centres)[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        least = (away ** 2 - away[:, home:home + 1] ** 2 - 16 * pivots.slack * (pivots.longest + pivots.slack)) / (2 * apart)
    least[:, ~(apart > 4 * pivots.slack)] = 0.0
    return least


def block_pairs(blocks: DataFrame, pivots: Pivots, radii: np.ndarray) -> DataFrame:
    """(caller, target) for every pair of blocks where some row of the caller may have a nearer row in the target."""
    spans = {r["ball"]: (r["low"], r["high"]) for r in blocks.groupBy("ball").agg(
        F.min("ring").alias("low"), F.max("ring").alias("high")).collect()}  # one row per pivot
    schema = pa.schema([("caller", pa.int64()), ("ball", pa.int32()), ("ring", pa.int64())])

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, home = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                _, x = _unpack(batch.column(2)[i], batch.column(3)[i])
                reach = _bounded(np.frombuffer(batch.column(4)[i].as_buffer(), "float64"), x, pivots, radii)
                away = distances(x, pivots.centres)
                least = _planes(away, home, pivots)
                for ball, (low, high) in spans.items():
                    near = least[:, ball] <= reach
                    first = np.floor(np.maximum(away[near, ball] - reach[near], 0) / pivots.widths[ball])
                    last = np.floor((away[near, ball] + reach[near]) / pivots.widths[ball])
                    first, last = np.clip(first, low, high + 1).astype(np.int64), np.clip(last, low - 1, high).astype(np.int64)
                    # rings covered by any row's stretch
                    step = np.zeros(high - low + 3, np.int64)
                    np.add.at(step, first[first <= last] - low, 1)
                    np.add.at(step, last[first <= last] - low + 1, -1)
                    rings = np.flatnonzero(np.cumsum(step)[:high - low + 1] > 0) + low
                    if len(rings):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(rings), block)), pa.array(np.full(len(rings), ball, np.int32)), pa.array(rings)], schema=schema)

    called = blocks.select("block", "ball", "ids", "x", "reach").mapInArrow(call, "caller long, ball int, ring long")
    return called.join(blocks.select("ball", "ring", F.col("block").alias("target")), ["ball", "ring"]).filter(
        F.col("caller") != F.col("target")).select("caller", "target")


def _tiles(blocks: DataFrame) -> DataFrame:
    """(block, tile): neighbouring balls and rings share a tile of at most TILE_BLOCKS full blocks, an eighth of the rows if that is less."""
    sizes = blocks.select("block", "ball", "ring", "n")  # one short row per block
    rows = sizes.agg(F.sum("n")).first()[0] or 1
    before = Window.orderBy("ball", "ring", "block").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("block", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / F.lit(min(TILE_BLOCKS * BLOCK_ROWS, math.ceil(rows / 8)))).alias("tile"))


def _across(pairs: DataFrame, blocks: DataFrame, pivots: Pivots, radii: np.ndarray, k: int) -> DataFrame:
    """Neighbours found in other blocks. Blocks travel once per pair of tiles, not once per pair of blocks,
    and a row leaves a pair of tiles with its k best there."""
    schema = pa.schema([("ID", pa.int64()), ("neighbour", pa.int64()), ("distance", pa.float64())])

    def meet(callers: pa.Table, targets: pa.Table) -> pa.Table:
        others = {}
        for i in range(targets.num_rows):
            span = tuple(np.array(targets[c][i].as_py()) for c in ("t_low", "t_high"))
            other = Targets.of(*_unpack(targets["t_ids"][i], targets["t_x"][i]))
            others[targets["t_block"][i].as_py()] = (other, targets["t_ball"][i].as_py(), *span, other.x.min(axis=0), other.x.max(axis=0))
        tables = []
        for i in range(callers.num_rows):
            ids, x = _unpack(callers["ids"][i], callers["x"][i])
            reach = _bounded(np.frombuffer(callers["reach"][i].as_buffer(), "float64"), x, pivots, radii)
            away = distances(x, pivots.centres)
            least = _planes(away, callers["ball"][i].as_py(), pivots)
            away = away[:, :REFERENCES]
            row, neighbour, gap = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
            middle = x.mean(axis=0)
            # the blocks nearby come first, they shorten the reach
            for target in sorted(callers["targets"][i].as_py(), key=lambda t: ((others[t][0].centre - middle) ** 2).sum()):
                other, ball, low, high, bottom, top = others[target]
                near = np.flatnonzero(least[:, ball] <= reach)
                near = near[np.maximum(low - away[near], away[near] - high).max(axis=1) <= reach[near]]
                outside = np.maximum(np.maximum(bottom - x[near], x[near] - top), 0)
                near = near[np.sqrt((outside ** 2).sum(axis=1)) <= reach[near]]
                if not len(near):
                    continue
                found, ID, distance = closest(x[near], other, k, reach[near])
                if not len(found):
                    continue
                found = near[found]
                touched = np.zeros(len(ids), bool)
                touched[found] = True
                old = touched[row]
                new_row, new_ID, new_gap = np.r_[row[old], found], np.r_[neighbour[old], ID], np.r_[gap[old], distance]
                keep, new_row = _best(new_row, new_ID, new_gap, k)
                new_ID, new_gap = new_ID[keep], new_gap[keep]
                last = np.arange(len(new_row)) - np.searchsorted(new_row, new_row) == k - 1
                reach[new_row[last]] = np.minimum(reach[new_row[last]], new_gap[last] + pivots.slack)
                row, neighbour, gap = np.r_[row[~old], new_row], np.r_[neighbour[~old], new_ID], np.r_[gap[~old], new_gap]
            tables.append(pa.Table.from_arrays([pa.array(ids[row]), pa.array(neighbour), pa.array(gap)], schema=schema))
        return pa.concat_tables(tables) if tables else schema.empty_table()

    tiles = _tiles(blocks)
    calls = cut_lineage(pairs.join(tiles.select(F.col("block").alias("caller"), F.col("tile").alias("c_tile")), "caller").join(
        tiles.select(F.col("block").alias("target"), F.col("tile").alias("t_tile")), "target"))
    lists = calls.groupBy("c_tile", "t_tile", "caller").agg(F.collect_list("target").alias("targets"))  # the blocks of one tile
    callers = lists.join(blocks.select(F.col("block").alias("caller"), "ball", "ids", "x", "reach"), "caller")
    # the two sides come from the same tables, so the columns of one are named anew
    targets = calls.select(F.col("c_tile").alias("to_c"), F.col("t_tile").alias("to_t"), F.col("target").alias("t_block")).distinct().join(
        blocks.select(F.col("block").alias("t_block"), F.col("ball").alias("t_ball"), F.col("ids").alias("t_ids"), F.col("x").alias("t_x"),
                      F.col("low").alias("t_low"), F.col("high").alias("t_high")), "t_block")
    return callers.groupBy("c_tile", "t_tile").cogroup(targets.groupBy("to_c", "to_t")).applyInArrow(meet, _FOUND)


def nearest_neighbours(vectors: DataFrame, k: int = 5, rows_per_block: int = BLOCK_ROWS) -> DataFrame:
    """(ID, rank, neighbour, distance) for the k nearest other rows of each row.

    `vectors` has a unique long `ID` and an array<double> `x` of one length.
    """
    for name, value in _BATCH.items():
        vectors.sparkSession.conf.set(name, value)
    vectors = vectors.select("ID", "x").filter(F.col("ID").isNotNull() & F.col("x").isNotNull())
    pivots = fit_pivots(vectors, rows_per_block)
    blocks = pack_blocks(vectors, k, rows_per_block, pivots)
    inside = blocks.select(F.inline("near"))
    radii = ball_radii(blocks, pivots, k)
    far = _across(block_pairs(blocks, pivots, radii), blocks, pivots, radii, k)
    best = Window.partitionBy("ID").orderBy("distance", "neighbour")
    return inside.unionByName(far).withColumn("rank", F.row_number().over(best)).filter(
        F.col("rank") <= k).select("ID", "rank", "neighbour", "distance")
