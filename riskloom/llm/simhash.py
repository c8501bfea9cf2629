"""SimHash near-duplicates, found by Golay-code fuzzy hashing.

A text's fingerprint has a bit set where over half of its word shingles' hashes have it.
Texts are linked when their fingerprints differ in at most two bits. The 64 bits fall into
three segments (23, 23, 18); of at most two errors one segment has none. A fingerprint's
keys therefore are, for each segment, the segment itself with the indices of the Golay
codewords near the next segment: one or six, and two segments that differ in at most two
bits share one. Fingerprints that share a key are compared.

Equal fingerprints are one node. A key's members are sorted to one place and compared in
numpy; where more than `FEW` share a key they are linked through the words one bit from
each (two fingerprints within two bits share such a word, and all that share one are
within two bits of each other), so work is linear and links are stars, not pairs. A key
with more than `crowd` members is not gathered at all: keys are counted with partial
counts, and a crowded key's members are linked through the same words by a grouped
minimum over the cluster. All ways give the same components.

Defined cases: texts without words (null and empty ones too) have fingerprint zero and are
linked like any other; fewer words than a shingle has make one shingle; a null id is kept,
and is never a component's id unless all its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import golay
from riskloom.llm.batches import append_columns, bounded_batches, fresh_name, quoted
from riskloom.llm.components import components
from riskloom.session import cut_lineage

SEED, SEGMENTS = 42, ((0, 23), (23, 23), (46, 18))
FEW = 8
#: Crowded keys sent to all tasks at most; more of them meet their members under SALTS keys each.
SENT, SALTS = 100_000, 32


def fingerprint(text: bytes | None, width: int) -> int:
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        line, at = b" ".join(words), 0
        begins, ends = [], []
        for word in words:
            begins.append(at)
            ends.append(at + len(word))
            at += len(word) + 1
        shingles = [line[b:e] for b, e in zip(begins, ends[width - 1 :])]
    hashes = np.array([xxh64_intdigest(s, SEED) for s in shingles], ">u8").view(np.uint8).reshape(-1, 8)
    votes = sum(np.unpackbits(hashes[i : i + 65536], axis=1).sum(axis=0, dtype=np.int64) for i in range(0, len(hashes), 65536))
    return int.from_bytes(np.packbits(votes * 2 > len(shingles)).tobytes(), "big", signed=True)


def fingerprints(df: DataFrame, text: str, keep: list[str], width: int = 3, name: str = "fp") -> DataFrame:
    """The kept columns and the fingerprint, as a signed long."""
    return append_columns(df, text, lambda: lambda texts: [[fingerprint(t, width) for t in texts]], f"{quoted(name)} long", keep, as_bytes=True)


def keys_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of each fingerprint's keys; a key holds the segment's number, its bits and an index."""
    rows, keys = [], []
    segments = [(fps >> np.uint64(shift) & np.uint64((1 << size) - 1)).astype(np.int64) for shift, size in SEGMENTS]
    for i, exact in enumerate(segments):
        near = golay.nearby_indices(segments[(i + 1) % 3])
        row, at = np.nonzero(near >= 0)
        rows.append(row)
        keys.append((exact[row] << golay.DATA | near[row, at]) << 2 | i)
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(distinct: DataFrame) -> DataFrame:
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy()
            rows, keys = keys_of(fps.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[rows])], schema=schema)

    return bounded_batches(distinct.select("fp")).mapInArrow(run, "key long, fp long")


#: A word itself and those one bit from it.
BALL = np.r_[np.uint64(0), np.uint64(1) << np.arange(64, dtype=np.uint64)]


def stars(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all fingerprints within two bits of each other, through words one bit from each."""
    centers = (fps.view(np.uint64)[:, None] ^ BALL).ravel()
    member = np.repeat(np.arange(len(fps)), len(BALL))
    order = np.argsort(centers, kind="stable")
    centers, member = centers[order], member[order]
    first = np.r_[True, centers[1:] != centers[:-1]]
    head = member[np.flatnonzero(first)][np.cumsum(first) - 1]
    pairs = np.unique(np.c_[member, head][member != head], axis=0)
    return fps[pairs[:, 0]], fps[pairs[:, 1]]


def _links_of(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows sorted by key."""
    left, right = [], []
    begins = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[begins, len(keys)])
    few = np.repeat(sizes <= FEW, sizes)
    for lag in range(1, FEW):
        near = np.flatnonzero((keys[lag:] == keys[:-lag]) & few[lag:] & (np.bitwise_count(fps[lag:] ^ fps[:-lag]) <= 2))
        left.append(fps[near])
        right.append(fps[near + lag])
    for begin, size in zip(begins[sizes > FEW], sizes[sizes > FEW]):
        a, b = stars(fps[begin : begin + size])
        left.append(a)
        right.append(b)
    u, v = np.concatenate([np.zeros(0, np.int64), *left]), np.concatenate([np.zeros(0, np.int64), *right])
    pairs = np.unique(np.c_[np.maximum(u, v), np.minimum(u, v)], axis=0)
    return pairs[:, 0], pairs[:, 1]


def _link_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each key's members, from batches sorted by key; a key that a batch cuts waits for the next."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    keys, fps = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        keys = np.r_[keys, batch.column(0).to_numpy()]
        fps = np.r_[fps, batch.column(1).to_numpy()]
        done = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _links_of(keys[:done], fps[:done])], schema=schema)
            keys, fps = keys[done:], fps[done:]
    if len(keys):
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _links_of(keys, fps)], schema=schema)


def links(distinct: DataFrame, crowd: int = 4096) -> DataFrame:
    """Links (u, v) that connect all fingerprints within two bits of each other."""
    keyed = _keyed(distinct)
    crowds = cut_lineage(keyed.groupBy("key").count().where(F.col("count") > crowd).select("key"))
    if crowds.limit(SENT + 1).count() <= SENT:
        table, on = F.broadcast(crowds), ["key"]
    else:
        keyed = keyed.withColumn("salt", F.pmod(F.hash("fp"), F.lit(SALTS)))
        table, on = crowds.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["key", "salt"]
    shared = keyed.join(table, on, "left_anti").select("key", "fp").repartition("key")
    near = shared.sortWithinPartitions("key", "fp").mapInArrow(_link_sorted, "u long, v long")
    crowded = keyed.join(table, on, "left_semi").select("fp").distinct()
    ball = F.array(*[F.col("fp").bitwiseXOR(F.lit(int(np.int64(b)))) for b in BALL.view(np.int64)])
    around = crowded.select("fp", F.explode(ball).alias("center"))
    heads = around.groupBy("center").agg(F.min("fp").alias("v"), F.count("*").alias("n")).where("n > 1").select("center", "v")
    far = around.join(heads, "center").select(F.col("fp").alias("u"), "v").where("u != v").distinct()
    return near.unionByName(far)


def roots_of(distinct: DataFrame, crowd: int = 4096) -> DataFrame:
    """Each fingerprint and its component's root, the least fingerprint that links reach."""
    linked = components(links(distinct, crowd)).select(F.col("node").alias("fp"), "root")
    return distinct.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def classes(df: DataFrame, id_col: str, text_col: str, width: int = 3, crowd: int = 4096) -> DataFrame:
    """Each row's id, `fp` and `component_id`, the smallest id among the rows that links reach."""
    printed = cut_lineage(fingerprints(df, text_col, [id_col], width))
    least = printed.groupBy("fp").agg(F.min(quoted(id_col)).alias("least"))
    roots = components(links(least, crowd))
    linked = roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()
    nodes = linked.join(least, linked["node"] == least["fp"]).select("node", "root", "least")
    ids = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = nodes.join(ids, "root").select(F.col("node").alias("fp"), "component_id")
    of_print = least.join(named, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return printed.join(of_print, "fp").select(quoted(id_col), "fp", "component_id")


def one_of_each(df: DataFrame, id_col: str, text_col: str, width: int = 3, crowd: int = 4096) -> DataFrame:
    """One row of df per component: the smallest id (null ids last), then the smallest hash of the text and of the row.

    Rows are told apart by id, text and all columns, never by id alone.
    """
    at, row, fp = (fresh_name([*df.columns, "root"], x) for x in ("at", "row", "fp"))
    columns = [F.col(quoted(c)) for c in df.columns]
    marked = df.withColumns({at: F.xxhash64(quoted(text_col)), row: F.xxhash64(*columns, *[c.isNull() for c in columns])})
    printed = cut_lineage(fingerprints(marked, text_col, [id_col, at, row], width, fp).select(F.col(quoted(id_col)).alias("id"), F.col(at).alias("at"), F.col(row).alias("row"), F.col(fp).alias("fp")))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "at", "row"))
    of_print = printed.groupBy("fp").agg(first.alias("first"))
    of_root = of_print.join(roots_of(of_print.select("fp"), crowd), "fp").groupBy("root").agg(F.min("first").alias("first")).select("first.id", "first.at", "first.row")
    same = marked[at].eqNullSafe(of_root["at"]) & marked[row].eqNullSafe(of_root["row"]) & marked[id_col].eqNullSafe(of_root["id"])
    return marked.join(of_root, same, "left_semi").dropDuplicates([id_col, at, row]).drop(at, row)
