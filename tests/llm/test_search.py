"""Operators 11 to 13 against plain Python versions of their contracts."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from riskloom.llm import annuli, importance, k2treap, queries, wordspans
from tests.llm import common

FOLDER = "/root/testdata/sf0.001"
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def terms(text):
    return LETTERS.findall(lowered(text))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def items(spark):
    return spark.read.parquet(f"{FOLDER}/benchmark.parquet")


# words as places


def test_words_and_hashes_are_those_of_the_library():
    texts = [r[1] for r in common.ODD] + ["aé", "éa", "", "Ab1-c\x00d", None, "x"]
    data, offsets = wordspans.joined_bytes(pa.array(texts, pa.string()).slice(1))
    data = wordspans.LOWER[data]
    starts, lengths, owner = wordspans.words_of(data, offsets, wordspans.ALNUM)
    found = defaultdict(list)
    for s, n, k in zip(starts, lengths, owner):
        found[k].append(data[s : s + n].tobytes().decode())
    assert [found[k] for k in range(len(texts) - 1)] == [terms(t) for t in texts[1:]]
    ends = np.arange(200)
    ranges = [np.zeros(200, np.int64), ends]
    assert wordspans.xxh64(data, *ranges, 42).tolist() == [xxhash.xxh64_intdigest(data[:n].tobytes(), 42) for n in ends]


# 11 ranked search


def ranking(rows, wanted, k=50):
    counts = [(i, Counter(terms(t))) for i, t in rows]
    counts = [(i, c) for i, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item in sorted({i for i, _ in wanted if i is not None}):
        asked = {t for i, text in wanted if i == item for t in terms(text)}
        scored = []
        for doc, c in counts:
            m = 50 + 50 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in asked & c.keys())
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scored)[:k])]
    return out


def searched(found):
    return sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect())


def test_search_equals_brute_force_in_any_cut(spark, docs, items):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    wanted = [(r.item_id, r.text) for r in items.collect()]
    truth = ranking(rows, wanted)
    assert searched(queries.ranked_search(spark, FOLDER)) == truth
    # Small shards, and more passes than one over the items.
    assert searched(k2treap.search(docs.repartition(3), items, shard=7, cells=300, block_terms=200)) == truth


def test_search_odd_rows(spark):
    rows = [(i, t) for i, t, *_ in common.ODD] + [(30 + i, "gleich gleich text") for i in range(80)] + [(None, "gleich gleich text")]
    wanted = [(1, "Gleich TEXT same here"), (1, "wort5 日本語"), (2, None), (3, ""), (4, "nowhere-to-be-found"), (None, "text"), (5, "X " * 10), (6, "wort1 wort2 ab x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit("clash"), "__text": F.lit(1), "item_id": F.lit(0)})
    asked = spark.createDataFrame(wanted, "item_id long, text string").withColumn("term", F.lit(2))
    assert searched(k2treap.search(df, asked)) == ranking(rows, wanted)
    assert searched(k2treap.search(df, asked, k=200, shard=16)) == ranking(rows, wanted, 200)
    assert k2treap.search(df.limit(0), asked).count() == 0 and k2treap.search(df, asked.limit(0)).count() == 0


@pytest.mark.parametrize("lead", [0, 1, 4, 9])
def test_treap_finds_the_greatest_columns(lead):
    draw = np.random.default_rng(lead)
    grid = np.where(draw.random((37, 150)) < 0.15, draw.integers(1, 9, (37, 150)), 0)
    rows, cols = np.nonzero(grid)
    treap = k2treap.Treap(rows, cols, grid[rows, cols], lead)
    assert treap.greatest[0] == grid.max()
    tie = draw.permutation(150)
    for size in (0, 1, 5, 37):
        for floor in (1, 6):
            own = np.sort(draw.choice(37, size, replace=False))
            sums = grid[own].sum(axis=0)
            order = [c for c in np.lexsort((tie, -sums)) if sums[c] >= floor][:12]
            found = treap.best(own, 12, floor, tie)
            assert found[1].tolist() == order and found[0].tolist() == sums[order].tolist()
    assert len(k2treap.Treap(rows[:0], cols[:0], rows[:0], lead).best(np.arange(3), 5)[0]) == 0


def test_treap_leaves_most_ranges_untouched_where_one_document_stands_out():
    grid = np.ones((8, 4096), np.int64)
    grid[:, 1234] = 1000
    rows, cols = np.nonzero(grid)
    treap, taken = k2treap.Treap(rows, cols, grid[rows, cols]), []
    original = k2treap._Frontier.take
    k2treap._Frontier.take = lambda self, floor: taken.append(original(self, floor)) or taken[-1]
    try:
        assert treap.best(np.arange(8), 1)[1].tolist() == [1234]
    finally:
        k2treap._Frontier.take = original
    assert sum(map(len, taken)) < 2000


# 12 importance resampling


def resampling(rows, target, width=1, buckets=10_000, seed=2024, least=20, percent=10):
    grams = lambda t: [" ".join(w[i : i + n]) for w in [terms(t)] for n in range(1, width + 1) for i in range(len(w) - n + 1)]
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = (Counter(bucket(g) for x in texts for g in grams(x)) for texts in ([x for _, x in rows], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for i, x in rows:
        own = [gain(bucket(g)) for g in grams(x)]
        weight = sum(own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(terms(x))])
    enough = [r for r in out if r[5] >= least]
    enough.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(enough[: percent * len(enough) // 100]):
        r[4] = place + 1
    return sorted(map(repr, (tuple(r[:5]) for r in out)))


def drawn(df):
    return sorted(repr((r.doc_id, r.n_features, r.weight, r.score, r["rank"])) for r in df.collect())


@pytest.mark.parametrize("width", [1, 3])
def test_resampling_equals_plain_python(docs, items, width):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    target = [r.text for r in items.collect()]
    found = importance.resample(docs.repartition(5), items, "doc_id", "text", "text", width=width, percent=30)
    assert drawn(found) == resampling(rows, target, width, percent=30)


def test_resampling_odd_rows(spark, items):
    rows = [(i, t) for i, t, *_ in common.ODD]
    for odd in (common.odd(spark), common.odd(spark).withColumns({"__words": F.lit(1), "rank": F.lit("x"), "__at": F.lit(2), "weight": F.lit(3)})):
        found = importance.resample(odd, items.limit(0), "doc_id", "text", "text", percent=60)
        assert drawn(found) == resampling(rows, [], percent=60)
    assert importance.resample(common.empty(spark), items, "doc_id", "text", "text").count() == 0


def test_interned_places_tell_equal_hashes_apart():
    words = [f"w{i * i % 91}" for i in range(700)]
    lengths = np.array([len(w) for w in words])
    data, starts = np.frombuffer("".join(words).encode(), np.uint8), np.cumsum(lengths) - lengths
    for hashes in (None, np.zeros(700, np.uint64), np.full(700, (1 << 64) - 1, np.uint64)):
        table = importance.Interned(data, starts, lengths, hashes)
        groups = defaultdict(set)
        for place, word in zip(table.slot, words):
            groups[place].add(word)
        assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(words)) == len(table.used)
        assert {words[table.owner[p]]: table.count[p] for p in table.used} == Counter(words)


# 13 exact top products


def products(rows, wanted, k=10, scale=1024):
    usable = lambda v: v and all(x is not None and math.isfinite(x) for x in v)
    whole = [(i, [math.floor(x * scale) for x in v]) for i, v in rows if i is not None and usable(v)]
    out = []
    for query in sorted(set(wanted)):
        best = {}
        for _, q in [r for r in whole if r[0] == query]:
            for i, v in whole:
                if i != query and len(v) == len(q):
                    best[i] = max(best.get(i, -(1 << 63)), sum(a * b for a, b in zip(q, v)))
        out += [(query, r + 1, i, s) for r, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k])]
    return out


def found_products(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_products_of_groups_copies_and_lengths(spark):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(12, 6)) * 3
    rows = [(i, (centres[i % 12] + draw.normal(size=6) * 0.2).tolist()) for i in range(900)]
    rows += [(1000 + i, centres[0].tolist()) for i in range(300)] + [(2000 + i, draw.normal(size=4).tolist()) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    wanted = [i for i, _ in rows if i % 100 == 0]
    truth = products(rows, wanted)
    for options in ({}, {"block": 32, "together": 2, "pivots": 12, "sample_rows": 600}, {"pivots": 1, "steps": ()}, {"block": 16, "sample_rows": 20, "steps": (1, 2, 3)}):
        assert found_products(annuli.top_products(df, df.where("vec_id % 100 = 0"), "vec_id", "v", **options)) == truth


def test_annuli_beyond_the_radius_are_not_visited(spark):
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(20, 16)) * 4
    rows = [(i, (centres[i % 20] + draw.normal(size=16) * 0.1).tolist()) for i in range(4000)]
    points = annuli.whole_vectors(spark.createDataFrame(rows, "vec_id long, v array<double>"), "vec_id", "v", 1024)
    index = annuli.fit(points, 40, 4000, 50)
    placed = annuli.place(points, index).cache()
    sizes = {(r.pivot, r.ring): r["count"] for r in placed.groupBy("pivot", "ring").count().collect()}
    queries_ = points.where("id % 100 = 0")
    floors = {i: s for i, r, _, s in products(rows, [i for i, _ in rows if i % 100 == 0]) if r == 10}
    known = queries_.join(spark.createDataFrame(list(floors.items()), "id long, floor long"), "id").select("id", "vec", "floor")
    visited = sum(sizes.get((r.pivot, r.ring), 0) for r in annuli._ask(known, index, 0, None).collect())
    assert visited < 0.25 * len(rows) * len(floors)


def test_products_odd_rows(spark):
    nan, one = float("nan"), [1.0, 0.0, 0.0]
    rows = [(0, one), (1, [0.0, 1.0, 0.0]), (2, [0.0, -1.0, 0.0]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [nan, 1.0, 0.0]), (6, [None, 1.0, 0.0]), (7, [math.inf, 0.0, 1.0]),
            (None, one), (8, [1.0, 0.0]), (9, []), (10, [2.0, 0.0, 0.0]), (10, [-9.0, 0.0, 0.0]), (11, one), (11, one), (100, [0.0, 0.0, 0.0]), (200, [-0.0005, 1e6, 3.0]), (100, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>").withColumns({"ring": F.lit(1), "id": F.lit("x"), "vec": F.lit("y"), "raw": F.lit(0)})
    wanted = [i for i, _ in rows if i is not None]
    assert found_products(annuli.top_products(df, df, "vec_id", "v")) == products(rows, wanted)
    assert annuli.top_products(df.limit(0), df.limit(0), "vec_id", "v").count() == 0
    assert annuli.top_products(df, df.limit(0), "vec_id", "v").count() == 0


def test_products_of_large_numbers_stay_exact():
    q, x = np.array([[3_000_000_001, 7]]), np.array([[2_999_999_999, -5], [1, 1]])
    assert annuli.products(q, x).tolist() == [[3_000_000_001 * 2_999_999_999 - 35, 3_000_000_008]]
    packed = annuli._packed(q.astype(float))
    assert annuli._unpacked(pa.concat_arrays([packed, annuli._packed(np.array([[-5.0, 1024.0]]))]), 2).tolist() == [[3_000_000_001, 7], [-5, 1024]]


# 7 letters


def test_number_signs_are_no_letters():
    from riskloom.llm import bytegru

    assert [bytegru._has_letter(w) for w in ("½", "²", "①", "Ⅷ", "1st", "日本", "é", "_", "३")] == [False] * 4 + [True, True, True, False, False]
