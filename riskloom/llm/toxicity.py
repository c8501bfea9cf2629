"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear SVM.

The kernel counts common subsequences of three characters, each weighted by DECAY to
the stretch it covers, so an insult still resembles itself when characters are put
between its own. The sentences of a labelled text carry its label; they are taken
apart into words, and a word's kernel values with a few landmark words, whitened by the
landmarks' own kernel matrix, are its features (Nyström). A squared-hinge SVM is linear
in them; its decision value therefore is a sum over a word's subsequences of one weight
each, and scoring needs no landmark. A text scores as its most insulting word, turned
into a probability fitted on the labelled texts.

Training takes about `max_texts` texts of either label, chosen by a hash of the text (each
distinct text once), at most `max_words` insults and 41 times as many other
words; both bounds are parameters. An insult is a word seen in toxic texts far more
often than elsewhere, and more often than chance would have it, by itself or with the
words that begin like it. A word counts by texts and distinct neighbourhoods, so that near copies of one
text don't lend weight to its rare words. Scoring reads whole texts.

Defined cases: null and empty texts score as a text without words; words of over WIDTH
characters are cut into overlapping windows; lone characters in a row ("s p a c e d")
are also read as one word, and a word with other signs inside also without them; null labels and labels of unknown rows are left out of
training; repeated labels of a row count by their largest; without a label of either
kind every text scores 0.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.batches import Memo, append_columns, quoted

DECAY, WIDTH, STRIDE, CLASSES, PENALTY, FIRST, CHANCE, STEM = 0.5, 24, 12, 64, 0.003, 4000, 0.3, 5
_SPACED = re.compile(r"(?<!\S)\S(?:\s\S){2,}(?!\S)")
_EDGES = ".,;:!?\"'()[]{}*#$%&|<>-_"


@dataclass
class ToxicityModel:
    weights: np.ndarray  # one per subsequence of three character classes
    bias: float
    slope: float
    offset: float


def char_class(char: str) -> int:
    """1 to 26 for a-z, else 27 to 63 by code point; 0 is padding."""
    code = ord(char)
    return code - 96 if 97 <= code <= 122 else 27 + code % 37


_ASCII = np.array([char_class(chr(c)) for c in range(128)])


def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Class codes of words of at most WIDTH characters, padded with 0, and their lengths."""
    lengths = np.array([len(w) for w in words])
    codes = np.zeros((len(words), WIDTH), np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    letter = (points >= 97) & (points <= 122)
    codes[np.arange(WIDTH) < lengths[:, None]] = np.where(letter, points - 96, 27 + points % 37)
    return codes, lengths


def windows(word: str) -> list[str]:
    return [word] if len(word) <= WIDTH else [word[i : i + WIDTH] for i in range(0, len(word) - STRIDE, STRIDE)]


def self_kernel(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The kernel of each word with itself, by the usual dynamic program."""
    n, width = codes.shape
    same = (codes[:, :, None] == codes[:, None, :]) & (codes > 0)[:, :, None]
    inner = np.ones((n, width + 1, width + 1))
    for order in range(3):
        ends = np.where(same, DECAY * DECAY * inner[:, :-1, :-1], 0.0)
        if order == 2:
            return ends.sum(axis=(1, 2))
        inner = np.zeros((n, width + 1, width + 1))
        for i in range(width):
            row = np.zeros(n)
            for j in range(width):
                row = DECAY * row + ends[:, i, j]
                inner[:, i + 1, j + 1] = DECAY * inner[:, i, j + 1] + row
    return np.zeros(n)


def gathered(codes: np.ndarray, lengths: np.ndarray, table: np.ndarray, rows_of: np.ndarray | None = None) -> np.ndarray:
    """Sum over each word's subsequences of three: DECAY ** stretch times table[..., subsequence]."""
    out = np.zeros((len(codes), *table.shape[1:]))
    longest = int(lengths.max(initial=0))
    for first, second in combinations(range(1, longest), 2):
        for start in range(longest - second):
            rows = np.flatnonzero(lengths > start + second)
            if not len(rows):
                break
            at = (codes[rows, start] * CLASSES + codes[rows, start + first]) * CLASSES + codes[rows, start + second]
            out[rows] += DECAY ** (second + 1) * table[at if rows_of is None else rows_of[at]]
    return out


def _by_length(words: list[str], function, shape: tuple = ()) -> np.ndarray:
    """Apply a function of (codes, lengths) to words in groups of similar length."""
    out = np.zeros((len(words), *shape))
    codes, lengths = encode(words)
    for low, high in ((0, 5), (5, 8), (8, 12), (12, 17), (17, WIDTH)):
        rows = np.flatnonzero((lengths > low) & (lengths <= high))
        for start in range(0, len(rows), 4096):
            part = rows[start : start + 4096]
            out[part] = function(codes[part, :high], lengths[part])
    return out


def norms(words: list[str]) -> np.ndarray:
    return np.sqrt(np.maximum(_by_length(words, self_kernel), 1e-12))


def decisions(words: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    sums = _by_length(words, lambda c, n: gathered(c, n, weights))
    return np.where([len(w) > 2 for w in words], sums / norms(words), 0.0) + bias


def landmark_table(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Explicit subsequence features of a few words: (the row of each subsequence, rows x words).

    Row 0 stands for all subsequences that no landmark has; columns are of unit length.
    """
    entries = [{} for _ in words]
    for own, code, n in zip(entries, *encode(words)):
        for i, j, m in combinations(range(n), 3):
            at = (code[i] * CLASSES + code[j]) * CLASSES + code[m]
            own[at] = own.get(at, 0.0) + DECAY ** (m - i + 1)
    known = sorted(set().union(*entries))
    rows = np.zeros(CLASSES**3, np.int32)
    rows[known] = np.arange(1, len(known) + 1)
    table = np.zeros((len(known) + 1, len(words)))
    for k, own in enumerate(entries):
        table[rows[list(own)], k] = list(own.values())
    return rows, table / norms(words)


def disturbed(words: list[str], rng: np.random.Generator, fill: str) -> list[str]:
    """Each word with characters put between its own, in one place or in all."""
    out = []
    for word in words:
        char = fill[rng.integers(len(fill))]
        at = int(rng.integers(1, max(len(word), 2)))
        out += [word[:at] + char + word[at:], char.join(word)[:WIDTH]]
    return out


def svm(features: np.ndarray, labels: np.ndarray, weights: np.ndarray, penalty: float) -> tuple[np.ndarray, float]:
    """Squared-hinge SVM by Newton steps on the rows inside the margin."""
    x = np.c_[features, np.ones(len(features))]
    ridge = penalty * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(30):
        inside = labels * (x @ w) < 1
        a, y, c = x[inside], labels[inside], weights[inside]
        new = np.linalg.solve(ridge + (a * c[:, None]).T @ a, (a * (c * y)[:, None]).sum(axis=0))
        if np.abs(new - w).max() < 1e-9:
            break
        w = new
    return w[:-1], float(w[-1])


def words_of(text: str | None) -> set[str]:
    if not text:
        return set()
    lowered = text.lower()
    words = set(lowered.split())
    for match in _SPACED.finditer(lowered) if _SPACED.search(lowered) else ():
        words.add("".join(match[0].split()))
    return words


def stripped(word: str) -> str:
    return word.strip(_EDGES)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_texts: int = 4000, max_words: int = 3000, landmarks: int = 384, seed: int = 11) -> ToxicityModel:
    """Fit on the labelled rows given; see the module text for the sample it takes."""
    known = (labels.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(label_col)).cast("int").alias("y"))
             .where("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y")))
    texts = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text")).where("text is not null and text != ''")
    distinct = texts.select("id", F.xxhash64("text").alias("h")).join(known, "id").groupBy("h").agg(F.min("id").alias("id"), F.max("y").alias("y"))
    found = dict(distinct.groupBy("y").count().collect())
    share = [int(min(1.0, max_texts / max(found.get(y, 0), 1)) * (1 << 32)) for y in (0, 1)]
    chosen = distinct.where(F.pmod("h", F.lit(1 << 32)) < F.when(F.col("y") == 1, share[1]).otherwise(share[0]))
    sample = texts.join(chosen.select("id", "y"), "id").select("y", F.lower("text").alias("text")).persist()
    held = [sample]
    try:
        words = F.split(F.trim(F.regexp_replace("text", r"[\s\p{Punct}]+", " ")), " ")
        shifted = F.arrays_zip(words.alias("word"), F.concat(F.array(F.lit("")), words).alias("before"), F.slice(words, 2, 1 << 30).alias("after"))
        near = (sample.select("y", F.xxhash64("text").alias("t"), F.inline(shifted)).where(F.length("word").between(3, WIDTH))
                .select("y", "t", "word", F.xxhash64("before", "after").alias("near")))
        counts = (near.groupBy("word", "near").agg(F.max("y").alias("y"), F.min("t").alias("t"))
                  .groupBy("word", "t").agg(F.max("y").alias("y")).groupBy("word")
                  .agg(F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("good")).persist())
        held.append(counts)
        stem = F.substring("word", 1, STEM)
        stems = counts.groupBy(stem.alias("stem")).agg(F.sum("bad").alias("stem_bad"), F.sum("good").alias("stem_good"))
        sizes = dict(sample.groupBy("y").count().collect())
        if not sizes.get(0) or not sizes.get(1):
            return ToxicityModel(np.zeros(CLASSES**3, np.float32), 0.0, 0.0, float("-inf"))
        # So often that fewer than CHANCE words would be seen in toxic texts alone by chance.
        odds, share = sizes[0] / sizes[1], sizes[1] / (sizes[0] + sizes[1])
        least = max(2.0, math.log(max(counts.count(), 1) / CHANCE) / -math.log(share))
        known = counts.join(stems, stem == F.col("stem")).persist()
        held.append(known)
        sure = lambda bad, good: (F.col(bad) >= least) & (F.col(bad) * odds >= 8 * F.col(good))
        odd = (F.col("bad") * odds >= 8 * F.col("good")) & (sure("bad", "good") | sure("stem_bad", "stem_good"))
        insults = [tuple(r) for r in known.where(odd).select("word", "bad").orderBy(F.desc("bad"), "word").limit(max_words).collect()]
        common = [r[0] for r in counts.where(F.col("good") >= 1).orderBy(F.desc("good"), "word").limit(max_words).collect()]
        rare = [r[0] for r in known.where(~odd).orderBy(F.xxhash64("word")).limit(40 * max_words).collect()]
        model = fit(insults, [w for w in {**dict.fromkeys(common), **dict.fromkeys(rare)} if w not in dict(insults)], landmarks, seed)
        if model is None:
            return ToxicityModel(np.zeros(CLASSES**3, np.float32), 0.0, 0.0, float("-inf"))
        scored = append_columns(sample, "text", lambda: _margins(model), "margin double", ["y"])
        seen = np.array(scored.collect(), dtype=float)  # the sample's rows
        seen = seen[np.lexsort((seen[:, 0], seen[:, 1]))]
    finally:
        for table in held:
            table.unpersist()
    model.slope, model.offset = _platt(seen[:, 1], seen[:, 0])
    return model


def fit(insults: list[tuple[str, int]], others: list[str], landmarks: int, seed: int) -> ToxicityModel | None:
    """SVM on words, fitted twice more with the most insult-like of the other words.

    Insults weigh by how often they were seen; some words of either kind also come with inserted characters.
    """
    if not insults or not others:
        return None
    rng = np.random.default_rng(seed)
    fill = "abcdefghijklmnopqrstuvwxyz.-_*0123456789"
    seen = dict(insults)
    pairs = [(w, seen[o] / 4) for o in list(seen)[:300] for w in disturbed([o], rng, fill) if len(w) <= WIDTH] + insults
    half = min(landmarks // 2, len(insults))
    stems: dict[str, str] = {}
    for word in seen:  # one landmark per beginning first, then the others
        stems.setdefault(word[:STEM], word)
    pivots = [*dict.fromkeys([*stems.values(), *seen])][:half]
    pivots = [*pivots, *[others[i] for i in rng.permutation(len(others))[: landmarks - half]]]
    rows_of, table = landmark_table(pivots)
    values, vectors = np.linalg.eigh(table.T @ table)
    white = vectors * np.where(values > 1e-6, 1 / np.sqrt(np.maximum(values, 1e-6)), 0.0)

    def features(words: list[str]) -> np.ndarray:
        kernel = _by_length(words, lambda c, n: gathered(c, n, table, rows_of), (len(pivots),))
        return kernel / norms(words)[:, None] @ white

    heavy = np.sqrt([n for _, n in pairs])
    bad = features([w for w, _ in pairs])
    good, rest = others[:FIRST] + [w for w in disturbed(others[:FIRST:8], rng, fill) if len(w) <= WIDTH], others[FIRST:]
    for last in (False, False, True):
        labels = np.r_[np.ones(len(bad)), -np.ones(len(good))]
        share = np.r_[heavy * (1 / heavy.sum()), np.full(len(good), 4 / len(good))]
        w, bias = svm(np.r_[bad, features(good)], labels, share * 1000, PENALTY)
        model = ToxicityModel((table @ (white @ w))[rows_of].astype(np.float32), bias, 1.0, 0.0)
        if last or not rest:
            return model
        order = np.argsort(-decisions(rest, model.weights, model.bias), kind="stable")
        good += [rest[i] for i in order[:FIRST]]
        rest = [rest[i] for i in order[FIRST:]]
    return model


def _platt(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic curve of the margins: both labels weigh as they occur, with Platt's softened targets."""
    good, bad = max((label == 0).sum(), 1), max((label == 1).sum(), 1)
    target = np.where(label == 1, (bad + 1) / (bad + 2), 1 / (good + 2))
    x, w = np.c_[margin, np.ones(len(margin))], np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (target - p) - 1e-3 * w)
        w = w + step * min(1.0, 5 / np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def _margins(model: ToxicityModel):
    def compute(words: list[str]) -> list[float]:
        pieces, owner = [], []
        for k, word in enumerate(words):
            own = stripped(word)
            for form in {own, own if own.isalnum() else "".join(filter(str.isalnum, own))}:
                pieces += (cut := windows(form))
                owner += [k] * len(cut)
        out = np.full(len(words), model.bias)
        np.maximum.at(out, owner, decisions(pieces, model.weights, model.bias) if pieces else [])
        return out.tolist()

    memo = Memo(compute)

    def function(texts: list[str | None]) -> list:
        own = [words_of(t) for t in texts]
        table = memo.of(set().union(*own))
        return [[max(map(table.__getitem__, words), default=model.bias) for words in own]]

    return function


def score_texts(docs: DataFrame, model: ToxicityModel, text_col: str = "text", keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """The kept columns and the probability that a text is toxic, in the column `name`."""
    def make():
        margins = _margins(model)

        def function(texts: list[str | None]) -> list:
            z = model.slope * np.array(margins(texts)[0]) + model.offset
            return [1 / (1 + np.exp(-np.clip(z, -700, 700)))]

        return function

    return append_columns(docs, text_col, make, f"{quoted(name)} double", docs.columns if keep is None else keep)
