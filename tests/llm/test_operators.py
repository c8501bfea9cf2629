import math
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm import bytegru, chat, components, crosspolytope, golay, lattice, packing, quality, queries, secret_scan, simhash, tokencount, toxicity
from tests.llm import common

FOLDER = "/root/testdata/sf0.001"
PIECES, BYTES, WORDS = map(public_tokenizers.path, ("piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").toPandas()


# 1 neighbours


def test_neighbours_recall_order_and_distance(spark):
    found = queries.neighbours(spark, "/root/testdata/sf0.01").toPandas()
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").toPandas()
    x, ids, hits = np.array(rows.embedding.tolist(), float), rows.vec_id.to_numpy(), 0
    for query, own in found.groupby("query_id"):
        own = own.sort_values("rank")
        d = np.sqrt(((x - x[ids == query][0]) ** 2).sum(axis=1))
        assert own["rank"].tolist() == list(range(1, 11)) and query not in set(own.vec_id)
        assert np.allclose(own.score, [d[ids == v][0] for v in own.vec_id], rtol=1e-12)
        assert list(zip(own.score, own.vec_id)) == sorted(zip(own.score, own.vec_id))
        hits += len(set(own.vec_id) & set(ids[np.lexsort((ids, np.where(ids == query, np.inf, d)))][:10]))
    assert found.query_id.nunique() == (ids % 100 == 0).sum() and hits / len(found) >= 0.9


def test_neighbours_odd_rows(spark):
    nan, one = float("nan"), [1.0, 0.0, 0.0]
    rows = [(0, one), (1, [0.0, 1.0, 0.0]), (2, [0.0, 1.0, 0.0]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [nan, 1.0, 0.0]), (6, [None, 1.0, 0.0]),
            (7, [math.inf, 0.0, 1.0]), (None, one), (8, [1.0, 0.0]), (9, []), (10, [2.0, 0.0, 0.0]), (10, [9.0, 0.0, 0.0]), (11, one), (11, one)]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>").withColumns({"bucket": F.lit(1), "id": F.lit("x"), "vec": F.lit("y")})
    found = crosspolytope.nearest_neighbours(df, df.where("vec_id in (0, 3, 4, 5, 8)"), "vec_id", "v").orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in found] == [(0, 1, 11, 0.0), (0, 2, 10, 1.0), (0, 3, 1, 1.414214), (0, 4, 2, 1.414214)]
    assert crosspolytope.nearest_neighbours(df.limit(0), df.limit(0), "vec_id", "v").count() == 0


def test_crowded_bucket_is_split_and_whole(spark):
    rows = [(i, [1.0, 0.0, 0.0, 0.0]) for i in range(300)] + [(1000, [1.0, 0.1, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    found = crosspolytope.nearest_neighbours(df, df.where("vec_id = 1000"), "vec_id", "v", block=16).orderBy("rank").collect()
    assert [r.vec_id for r in found] == list(range(10))


# 2 toxicity


def test_toxicity_on_held_out_rows(spark):
    out = queries.toxic(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").toPandas()
    held = out[out.held_out]
    assert (held.held_out == (held.doc_id.map(common.crc) % 4 == 2)).all() and out.score.between(0, 1).all()
    assert (out.predicted == (out.score >= 0.3)).all()
    toxic = held[held.toxic == 1]
    # Measured 0.57: at this size most insults outside English are too rare in the training texts (README).
    assert (toxic.predicted == 1).mean() >= 0.5 and (held[held.toxic == 0].predicted == 0).mean() >= 0.93


def test_kernel_is_the_count_of_common_subsequences():
    decay = toxicity.DECAY
    wanted = defaultdict(float)
    for i, j, k in [(0, 1, 2), (0, 1, 3), (0, 2, 3), (1, 2, 3)]:
        wanted["abab"[i] + "abab"[j] + "abab"[k]] += decay ** (k - i + 1)
    assert np.isclose(toxicity.norms(["abab"])[0] ** 2, sum(v * v for v in wanted.values()))
    rows, table = toxicity.landmark_table(["abab", "xyzw"])
    same = toxicity._by_length(["abab", "axbab"], lambda c, n: toxicity.gathered(c, n, table, rows), (2,)) / toxicity.norms(["abab", "axbab"])[:, None]
    assert np.isclose(same[0, 0], 1) and 0.2 < same[1, 0] < 1 and same[0, 1] == 0


def test_toxicity_finds_disturbed_insults(spark):
    model = toxicity.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))
    texts = [(1, "that stupid thing"), (2, "that s t u p i d thing"), (3, "that stu.pid thing"), (4, "what a pathxetic thing"), (5, "the thing and that one")]
    scores = dict(toxicity.score_texts(spark.createDataFrame(texts, "doc_id long, text string"), model, keep=["doc_id"]).collect())
    assert min(scores[i] for i in (1, 2, 3, 4)) > 5 * scores[5]


def test_toxicity_odd_rows(spark):
    labels = spark.createDataFrame([(4, 1, 1), (6, 1, 0), (6, None, None), (None, 0, 1), (99, 0, 0)], "doc_id long, quality int, toxic int")
    for truth in (labels, labels.limit(0)):
        model = toxicity.train(common.odd(spark), truth)
        out = toxicity.score_texts(common.odd(spark), model, keep=["doc_id"]).collect()
        assert len(out) == len(common.ODD) and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score_texts(common.empty(spark), model, keep=["doc_id"]).count() == 0


# 3 chat


def test_layouts_become_canonical_turns(spark):
    rows = ['{"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": null}]}', '{"prompt": 1, "response": "x"}',
            '{"instruction": "i", "input": "", "output": "o"}', '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}]}', '{"other": 1}', None]
    df = spark.createDataFrame(list(enumerate(rows)), "id long, j string").select("id", F.parse_json("j").alias("rec"), F.lit(0).alias("role"), F.lit(0).alias("position"))
    turns = defaultdict(list)
    for r in chat.canonical_turns(df, "rec").orderBy("id", "position").collect():
        turns[r.id].append((r.role, r.text))
    assert turns == {0: [("user", "a"), ("assistant", "")], 1: [("user", "1"), ("assistant", "x")], 2: [("user", "i"), ("assistant", "o")],
                     3: [("user", "q"), ("assistant", "r")], 4: [(None, None)], 5: [(None, None)]}


def test_template_is_reversible(spark):
    texts = ["", "<|end|>", "\\", "\\<|", "<\\|user|>", "a<", "|>b", "<|user|>x<|end|>", "\n", "</s>[INST] ok [/INST]", "<<|end|", "\\\\|", "𝄞<|"]
    rows = [(i, k, role, t) for i, role in enumerate(["user", "assistant", "", "a|", "x|>y", "<|end|>", "b\\", "c<"]) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id long, o int, role string, text string")
    formatted = chat.format_conversations(df, "id", ["o"])
    read = formatted.select("id", chat.read_back(F.col("formatted")).alias("t"), chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("m"))
    for r in read.collect():
        assert [(t.role, t.text) for t in r.t] == [(x[2], x[3]) for x in rows if x[0] == r.id]
        assert r.m == ("".join(texts) if r.id == 1 else "")
    assert chat.digest(chat.format_conversations(df.limit(0), "id", ["o"]), "id").count() == 0


def test_chat_query_against_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.sql(f"create view conversations as from '{FOLDER}/conversations.parquet'")
    wanted = sorted(con.sql(queries.ORACLE["op3_chat"]).fetchall())
    assert sorted(map(tuple, queries.conversations(spark, FOLDER).collect())) == wanted


def test_long_conversations_go_in_chunks(spark):
    """One conversation with most of all rows, one of a single turn, one without an id, repeated turns; extra columns clash."""
    long = spark.range(100_000).select(F.lit(1).cast("long").alias("id"), F.col("id").alias("o"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                       F.concat(F.lit("<|"), F.col("id").cast("string"), F.lit("\\𝄞")).alias("text"))
    others = spark.createDataFrame([(2, 0, "assistant", "x"), (None, 0, "user", "a"), (None, 0, "user", "a"), (None, None, "assistant", "b")], "id long, o long, role string, text string")
    turns = long.unionByName(others).repartition(7).selectExpr("*", "'clash' as chunk", "'clash' as start", "'clash' as part", "'clash' as formatted")
    chunks = chat.in_chunks(turns, "id", ["o"]).cache()
    found = {r.id: r for r in chat.digest(chunks, "id").collect()}
    texts = [f"<|{i}\\𝄞" for i in range(100_000)]
    trained = "".join(texts[1::2])
    assert found[1].n_turns == 100_000 and found[1].turns_sha256 == common.sha("".join(f"{('user', 'assistant')[i % 2]}\n{t}\n" for i, t in enumerate(texts)))
    assert found[1].loss_chars == len(trained) and found[1].loss_sha256 == common.sha(trained)
    assert found[None].turns_sha256 == common.sha("assistant\nb\nuser\na\nuser\na\n") and found[None].loss_chars == 1 and found[2].n_turns == 1
    rows = sorted((r for r in chunks.where("id = 1").collect()), key=lambda r: r.chunk)
    whole = "".join(r.formatted for r in rows)
    assert max(r.formatted.count(chat.CLOSE) for r in rows) <= chat.CHUNK and [r.start for r in rows] == [0, *np.cumsum([len(r.formatted) for r in rows])[:-1]]
    spans = [whole[s.start : s.start + s.length] for r in rows for s in r.loss_spans]
    assert spans == [t.replace("\\", "\\\\").replace("<|", "<\\|") for t in texts[1::2]]
    one = chat.format_conversations(turns.where("id = 1"), "id", ["o"]).first()
    assert one.formatted == whole and len(one.loss_spans) == 50_000
    chunks.unpersist()


# 4 pieces


def test_pieces_are_lossless_and_reproducible(spark):
    rows = common.odd(spark)
    encoded = lattice.encode_rows(rows, "doc_id", "text", PIECES)
    texts = lattice.decode_rows(encoded, "ids", PIECES, ["doc_id"]).collect()
    assert sorted((r.doc_id or 0, r.text) for r in texts) == sorted((x[0] or 0, x[1] or "") for x in common.ODD)
    assert sorted(map(str, encoded.collect())) == sorted(map(str, lattice.encode_rows(rows.repartition(5), "doc_id", "text", PIECES).collect()))
    assert lattice.encode_rows(common.empty(spark), "doc_id", "text", PIECES).count() == 0


def test_pieces_query_decodes_every_text(spark, docs):
    out = queries.pieces(spark, FOLDER).toPandas().set_index("doc_id")
    assert all(out.decoded_sha256[i] == common.sha(t) for i, t in docs.itertuples(index=False)) and len(out) == len(docs)


def test_samples_follow_the_lattice_distribution():
    encoder = lattice.Encoder(PIECES, 1.0, 0)
    weight = {encoder.lattices.ids[i]: w for i, w in enumerate(encoder.lattices.weights)}
    model = lattice.load(PIECES)

    def ways(text):
        if not text:
            yield (), 1.0
        for n in range(1, len(text) + 1):
            i = model.piece_to_id(text[:n])
            if i != model.unk_id():
                for rest, w in ways(text[n:]):
                    yield (i, *rest), w * weight[i]

    exact = dict(ways("▁there"))
    total, n = sum(exact.values()), 20_000
    ids, offsets = encoder(list(range(n)), ["there"] * n)
    seen = defaultdict(int)
    for a, b in zip(offsets, offsets[1:]):
        seen[tuple(int(i) for i in ids[a:b])] += 1
    assert set(seen) <= set(exact)
    for way, w in exact.items():
        p = w / total
        assert abs(seen[way] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_long_runs_have_one_lattice():
    encoder = lattice.Encoder(PIECES, 1.0, 0)
    weight = {int(encoder.lattices.ids[i]): w for i, w in enumerate(encoder.lattices.weights) if i}
    model, text, n = lattice.load(PIECES), "▁" + "theretransfer" * 39, 3000
    edge = {(a, b): weight[i] * 10.0 ** (b - a) for a in range(len(text)) for b in range(a + 1, min(a + 16, len(text)) + 1) if (i := model.piece_to_id(text[a:b])) in weight}
    before, after = [1.0] + [0.0] * len(text), [0.0] * len(text) + [1.0]
    for b in range(1, len(text) + 1):
        before[b] = sum(before[a] * edge.get((a, b), 0) for a in range(max(0, b - 16), b))
    for a in range(len(text) - 1, -1, -1):
        after[a] = sum(edge.get((a, b), 0) * after[b] for b in range(a + 1, min(a + 16, len(text)) + 1))
    exact = [math.exp(math.log(x) + math.log(y) - math.log(before[-1])) if x and y else 0.0 for x, y in zip(before, after)]
    ids, offsets = encoder(list(range(n)), [text[1:]] * n)
    seen = defaultdict(int)
    for a, b in zip(offsets, offsets[1:]):
        at = 0
        for i in ids[a:b]:
            at += len(model.id_to_piece(int(i)))
            seen[at] += 1
        assert at == len(text)
    for k in range(1, len(text)):
        assert abs(seen[k] / n - exact[k]) < 6 * math.sqrt(max(exact[k] * (1 - exact[k]), 0) / n) + 2e-3


def test_windows_and_filling_change_no_sample(monkeypatch):
    texts = ["x".join(f"there{i * k}" for i in range(k)) for k in (9, 10, 11, 12, 13, 60)]
    whole = lattice.Encoder(PIECES, 1.0, 0)([1] * len(texts), texts)
    alone = [lattice.Encoder(PIECES, 1.0, 0)([1], [t])[0].tolist() for t in texts]
    assert [whole[0][a:b].tolist() for a, b in zip(whole[1], whole[1][1:])] == alone
    monkeypatch.setattr(lattice, "WINDOW", 7)
    assert lattice.Encoder(PIECES, 1.0, 0)([1] * len(texts), texts)[0].tolist() == whole[0].tolist()


def test_literal_blank_signs_and_long_words_are_lossless():
    texts = ["a ▁b▁▁ c", "▁", "  ▁ ", "日本語▁" * 300, " " * 70 + "end", "▁ " * 40]
    ids, offsets = lattice.Encoder(PIECES, 1.0, 0)(list(range(len(texts))), texts)
    assert lattice.Spelling(PIECES)(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))).to_pylist() == texts


# 5 secrets


def test_base_spans_against_regular_expressions(spark, docs):
    more = ["token=token=abcdefgh", "token: token:abcdefgh", "API_KEY : 'Abc/def+9", "ſecret=abcdefg", "AKIAAKIA" + "B" * 20, "0" * 23, "é" * 9 + "f" * 24, "apikey=a.b=c-d\npasswd='12345"]
    rows = [*zip(range(10_000, 10_100), more), *docs.itertuples(index=False, name=None), *((x[0], x[1]) for x in common.ODD)]
    df = spark.createDataFrame([(i, d, t) for i, (d, t) in enumerate(rows)], "i long, base long, text string")
    model = secret_scan.train(secret_scan.labelled_tokens(df))
    out = secret_scan.find_spans(df, model, base="b", found="f").select("i", secret_scan.joined(F.col("b")).alias("b"), "f", secret_scan.redacted(F.col("text"), F.col("f")).alias("r"))
    for r in out.collect():
        text = rows[r.i][1]
        assert [x for x in r.b.split(",") if x] == common.base_spans(text)
        masked, end = "", 0
        for s in r.f:
            if s.start >= end:
                masked += (text or "")[end : s.start] + "[SECRET]"
            end = max(end, s.stop)
        assert r.r == (masked + text[end:] if r.f else text)
    assert secret_scan.find_spans(common.empty(spark), model).count() == 0


def test_markov_model_tells_keys_from_words(spark):
    import random

    rng = random.Random(4)
    key = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    words = ["customer", "account", "transfer", "balance", "statement", "interest", "payment", "record", "number", "total", "file", "reader"]
    name = lambda: "_".join(rng.choice(words) for _ in range(3)) + str(rng.randrange(10))
    sample = [(key(24), True) for _ in range(500)] + [(name(), False) for _ in range(1500)]
    model = secret_scan.train(spark.createDataFrame(sample, "token string, random boolean"))
    texts = [(f"see {key(24)} now", 1) for _ in range(200)] + [(f"see {name()} now", 0) for _ in range(200)]
    out = secret_scan.find_spans(spark.createDataFrame(texts, "text string, y int"), model).select("y", F.size("found").alias("n")).collect()
    assert sum(r.n == r.y for r in out) >= 360


def test_keys_of_letters_or_digits_only_are_judged(spark):
    import random

    rng = random.Random(5)
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text")
    model = secret_scan.train(secret_scan.labelled_tokens(docs))
    letters, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "0123456789"
    texts = [("see " + "".join(rng.choice(a) for _ in range(n)) + " now", 1) for a in (letters, digits, letters + digits) for n in (16, 20) for _ in range(50)]
    texts += [(f"see {sign * 40} now", 0) for sign in "-_=+/"] + [("see ungheiterieenach now", 0), ("see thretithestioner now", 0)]
    out = secret_scan.find_spans(spark.createDataFrame(texts, "text string, y int"), model).select("text", "y", F.size("found").alias("n")).collect()
    assert [r.text for r in out if r.y == 0 and r.n] == []
    assert sum(r.n for r in out if r.y == 1) >= 297


def test_one_very_long_token_is_read_once(spark):
    import random

    rng = random.Random(6)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    sample = [("".join(rng.choice(letters) for _ in range(24)), True) for _ in range(3000)] + [("customer_account_total", False)] * 300
    model = secret_scan.train(spark.createDataFrame(sample, "token string, random boolean"), threshold=0.1)
    key = "".join(rng.choice(letters) for _ in range(1_000_000))
    text = spark.createDataFrame([(f"see {key} now",), ("x",), ("",)], "text string")
    began = time.monotonic()
    found = secret_scan.find_spans(text, model).select(secret_scan.joined(F.col("found"))).collect()
    assert [r[0] for r in found] == [f"markov:4:{4 + len(key)}", "", ""] and time.monotonic() - began < 60


# 6 quality


def test_quality_counts_against_plain_python(spark, docs):
    rows = [*docs.itertuples(index=False, name=None), *((x[0], x[1]) for x in common.ODD)]
    df = spark.createDataFrame([(i, d, t) for i, (d, t) in enumerate(rows)], "i long, kept long, text string")
    for r in quality.measured(df, "text", quality.RULES, ["i"]).collect():
        n, *rest = common.quality(rows[r.i][1])
        assert tuple(r)[1:6] == (n, *rest)
        assert r.base_failed == (n < 10 or 100 * rest[-1] > 20 * n) and not (r.base_failed and r.kept)
    assert quality.measured(common.empty(spark), "text", quality.RULES, ["doc_id"]).count() == 0


def test_cascade_order_changes_no_verdict(spark, docs):
    df = spark.createDataFrame(docs)
    order = quality.estimate(df, "text")
    rates = [e.rejected / max(e.seconds, 1e-9) for e in order]
    assert rates == sorted(rates, reverse=True) and {e.rule for e in order} == {r.name for r in quality.RULES}
    one = quality.first_rejection(df, "text", quality.ordered(quality.RULES, order), ["doc_id"], "why").toPandas()
    two = quality.first_rejection(df, "text", quality.RULES[::-1], ["doc_id"], "why").toPandas()
    assert one.set_index("doc_id").why.isna().equals(two.set_index("doc_id").why.isna())


# 7 language


def test_gru_gradients_through_time():
    p = {k: v.astype(float) for k, v in bytegru.initial(4, 3, 0).items()}
    codes, lengths = bytegru.padded([b"ab", b"hello", "größe".encode()])
    _, g = bytegru.gradients(codes, lengths, np.array([0, 1, 2]), p)
    for name in p:
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        change = []
        for e in (1e-4, -2e-4):
            p[name][at] += e
            change.append(bytegru.gradients(codes, lengths, np.array([0, 1, 2]), p)[0])
        p[name][at] += 1e-4
        assert np.isclose((change[0] - change[1]) / 2e-4, g[name][at], rtol=1e-2, atol=1e-5)


def test_language_on_held_out_rows_and_odd_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = bytegru.train(docs.where(~held), "text", "lang")
    out = bytegru.predict(docs.where(held), model, "text", ["doc_id", "lang"]).toPandas()
    assert (out.lang == out.lang_pred).mean() >= 0.95 and out.score.between(0, 1).all()
    odd = bytegru.predict(common.odd(spark), model, "text", ["doc_id"]).collect()
    assert len(odd) == len(common.ODD) and {r.lang_pred for r in odd if r.doc_id in (1, 2, 3)} == {"und"}
    nothing = bytegru.train(common.empty(spark), "text", "lang")
    assert {r.lang_pred for r in bytegru.predict(common.odd(spark), nothing, "text", ["doc_id"]).collect()} == {"und"}


# 8 near copies


def test_golay_keys_meet_within_two_errors():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 23, 20_000)
    for errors in (0, 1, 2):
        y = x.copy()
        for _ in range(errors):
            y ^= 1 << rng.integers(0, 23, len(x))
        a, b = golay.nearby_indices(x), golay.nearby_indices(y)
        assert ((a[:, :, None] == b[:, None, :]) & (a >= 0)[:, :, None]).any(axis=(1, 2)).all()


@pytest.mark.parametrize(("crowd", "sent"), [(4096, 100_000), (4, 100_000), (4, 0)])
def test_links_against_all_pairs(spark, crowd, sent, monkeypatch):
    monkeypatch.setattr(simhash, "SENT", sent)
    rng = np.random.default_rng(1)
    centers = rng.integers(0, 2**63, 20)
    prints = sorted({int(c) ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 4), replace=False)) for c in centers for _ in range(40)} | {0, 1, 7})
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = {r.node: r.root for r in components.components(simhash.links(df, crowd)).collect()}
    root, wanted = common.classes(prints), {}
    for i, r in enumerate(root):
        wanted.setdefault(r, []).append(prints[i])
    for group in wanted.values():
        assert {found.get(p, p) for p in group} == {min(group)}


def test_near_copy_query_against_brute_force(spark, docs):
    prints = [common.simhash(t) for t in docs.text]
    root, least = common.classes(prints), {}
    for r, i in zip(root, docs.doc_id):
        least[r] = min(least.get(r, i), i)
    wanted = sorted((i, f"{p:016x}", least[r]) for i, p, r in zip(docs.doc_id, prints, root))
    assert sorted(map(tuple, queries.near_copies(spark, FOLDER).collect())) == wanted


def test_near_copies_odd_rows(spark):
    out = sorted(((r.doc_id or 0, r.component_id) for r in simhash.classes(common.odd(spark), "doc_id", "text").collect()))
    assert [x for x in out if x[0] in (1, 2, 3, 4, 5)] == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (5, 4)] and (0, None) in out
    assert simhash.classes(common.empty(spark), "doc_id", "text").count() == 0


# 9 packing


def check_packing(rows, pieces):
    model = Tokenizer.from_file(BYTES)
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        of_doc[p.doc_id].append(p)
        of_sequence[p.sequence_id].append(p)
    for own in of_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at == 2048 or (at < 2048 and at & (at - 1) == 0)
    for doc, text in rows.items():
        ids, at = [*model.encode(text or "", add_special_tokens=False).ids, 1], 0
        for p in sorted(of_doc[doc], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    assert set(of_doc) == set(rows)


def test_packing_holds_every_token_once(spark, docs):
    check_packing(dict(docs.itertuples(index=False, name=None)), queries.sequences(spark, FOLDER).collect())


def test_token_ids_equal_the_library():
    rng = np.random.default_rng(8)
    signs = [" ", "  ", "   ", "\n", "\n\n", "\r\n", "\t", "\xa0", "\u3000", "\x85", "\x1c", "a", "Ab", "'s", "'LL", "don't", "12", "½", "é", "e\u0301", "漢字", "🙂", "\u200d", "…", "<|", "<|endoftext|>", "|>", "_", "()"]
    tokens, model = packing.Tokens(BYTES), Tokenizer.from_file(BYTES)
    texts = ["".join(rng.choice(signs, rng.integers(1, 14))) for _ in range(4000)] + ["", None, " ", "  ", "a  ", "a \n", "\n\n\na", "word " * 300_000]
    for text, ids in zip(texts, tokens(texts), strict=True):
        assert ids.dtype == np.uint32 and ids.tolist() == model.encode(text or "", add_special_tokens=False).ids


def test_packing_odd_rows(spark):
    rows = {x[0]: x[1] for x in common.ODD if x[0] is not None}
    once = common.odd(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    check_packing(rows, packing.pack(once, "doc_id", "text", BYTES).collect())
    twice = packing.pack(common.odd(spark), "doc_id", "text", BYTES).collect()
    assert sum(p.length for p in twice if p.doc_id == 5) == 2 * sum(p.length for p in twice if p.doc_id == 4) and any(p.doc_id is None for p in twice)
    assert packing.pack(common.empty(spark), "doc_id", "text", BYTES).count() == 0


def test_level_choice_minimises_the_sum_of_squares():
    rng, packer = np.random.default_rng(2), packing.Packer(20, most_open=50)
    for n in rng.integers(1, 20, 400):
        before = packer.levels.copy()
        costs = {}
        for level in range(0, 21 - n):
            if level == 0 or before[level]:
                after = before.copy()
                after[level] -= level > 0
                after[level + n] += level + n < 20
                costs[level] = (after[1:20].astype(int) ** 2).sum()
        count = packer.count
        done = list(packer.add(0, np.zeros(n, np.uint32)))
        if packer.count >= count - 1 and len(done) <= 1:
            assert (packer.levels[1:20].astype(int) ** 2).sum() == min(costs.values())
        assert all(sum(len(p[2]) for p in w) == 20 for w in done)
    assert [sum(len(p[2]) for p in w) for w in packer.refilled()[:-1]].count(20) >= 1


# 10 token counts


def test_counts_against_the_library(spark, docs):
    model = Tokenizer.from_file(WORDS)
    rows = [*docs.itertuples(index=False, name=None), *((x[0], x[1]) for x in common.ODD)]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "i long, text string").withColumn("n_bytes", F.lit("x"))
    for r in tokencount.count_texts(df, "text", WORDS, ["i", "n_bytes"]).collect():
        text = rows[r.i][1] or ""
        n = len(model.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 2048)
    assert tokencount.count_texts(common.empty(spark), "text", WORDS, ["doc_id"]).count() == 0


def test_counts_of_every_prefix():
    model, counts = Tokenizer.from_file(WORDS), tokencount.PrefixCounts(WORDS)
    n = lambda t: len(model.encode(t, add_special_tokens=False).ids)
    for word in ("internationalization", "thertionandlyes", "zzzzzzqqqq"):
        assert counts.of_prefixes(word) == [n(word[: i + 1]) for i in range(len(word))]
    text = "The quick brown foxes jumped over internationalization rules"
    stretches = text.split(" ")
    table = tokencount.prefix_table(stretches, dict(zip(stretches, counts.stretches(stretches))))
    for budget in range(n(text) + 2):
        best = tokencount.fitting(stretches, table, budget, counts)
        longest = max((text[:i].lower() for i in range(len(text) + 1) if n(text[:i]) <= budget), key=len)
        assert best.strip() == longest.strip()
