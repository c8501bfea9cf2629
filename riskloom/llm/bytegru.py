"""Language identification by a bidirectional gated recurrent network over bytes.

Two GRUs read a word's bytes from either side; at every position a softmax over both
states gives the probabilities of the languages. A document's probabilities are the mean
over the positions of all its words that hold a letter. States begin anew with each word
(with its border bytes), so equal words have equal positions and are computed once while
they are remembered; every position of the text counts all the same.

Trained in numpy by backpropagation through time with Adam, on the words of about
`max_texts` distinct texts per language (by a hash); all bounds are parameters.

Defined cases: null texts and texts without a letter are "und" with score 0; words longer
than WIDTH bytes are read in parts; case is folded; ties go to the first language in
alphabetical order; without training rows everything is "und".
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.batches import Memo, append_columns, hashed_sample, quoted

WIDTH = 24
UNKNOWN = "und"
_ONE_HOT = np.eye(256, dtype=np.float32)


def _has_letter(word: str) -> bool:
    """Letters only: number signs such as fractions and Roman numerals are none."""
    return word.isalpha() or any(map(str.isalpha, word))


@dataclass
class ByteGru:
    languages: list[str]
    params: dict[str, np.ndarray]


def padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of words of at most WIDTH bytes between two border blanks, padded with 0, and their lengths."""
    lengths = np.array([len(w) for w in words], np.int64) + 2
    codes = np.zeros((len(words), int(lengths.max(initial=2))), np.int64)
    flat = np.frombuffer(b"".join(b" " + w + b" " for w in words), np.uint8)
    codes[np.arange(codes.shape[1]) < lengths[:, None]] = flat
    return codes, lengths


def initial(hidden: int, classes: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = {}
    for side in "fb":
        p["x" + side] = rng.normal(0, 0.3, (256, 3 * hidden))
        p["h" + side] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden))
    p["o"], p["c"] = rng.normal(0, 0.3, (2 * hidden, classes)), np.zeros(classes)
    return {k: v.astype(np.float32) for k, v in p.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _read(codes: np.ndarray, mask: np.ndarray, x: np.ndarray, h: np.ndarray, backward: bool, tape: list | None = None) -> np.ndarray:
    """States of one GRU at all positions; padding leaves the state as it is."""
    n, width = codes.shape
    hidden = len(h)
    state, out = np.zeros((n, hidden), np.float32), np.empty((n, width, hidden), np.float32)
    for t in range(width - 1, -1, -1) if backward else range(width):
        own, past = x[codes[:, t]], state @ h
        gates = _sigmoid(own[:, : 2 * hidden] + past[:, : 2 * hidden])
        keep, reset = gates[:, :hidden], gates[:, hidden:]
        new = np.tanh(own[:, 2 * hidden :] + reset * past[:, 2 * hidden :])
        m = mask[:, t, None]
        after = np.where(m, keep * state + (1 - keep) * new, state)
        if tape is not None:
            tape.append((t, state, past, keep, reset, new, m))
        state = out[:, t] = after
    return out


def positions(codes: np.ndarray, lengths: np.ndarray, p: dict[str, np.ndarray]) -> np.ndarray:
    """Probabilities of each language at each position, words x positions x languages."""
    mask = np.arange(codes.shape[1]) < lengths[:, None]
    states = np.concatenate([_read(codes, mask, p["xf"], p["hf"], False), _read(codes, mask, p["xb"], p["hb"], True)], axis=2)
    z = states @ p["o"] + p["c"]
    z = np.exp(z - z.max(axis=2, keepdims=True))
    return z / z.sum(axis=2, keepdims=True) * mask[:, :, None]


def gradients(codes: np.ndarray, lengths: np.ndarray, labels: np.ndarray, p: dict[str, np.ndarray]) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross entropy over all positions, and its gradient through time."""
    mask = np.arange(codes.shape[1]) < lengths[:, None]
    tapes, states = {"f": [], "b": []}, []
    for side in "fb":
        states.append(_read(codes, mask, p["x" + side], p["h" + side], side == "b", tapes[side]))
    both = np.concatenate(states, axis=2)
    z = both @ p["o"] + p["c"]
    z = np.exp(z - z.max(axis=2, keepdims=True))
    prob = z / z.sum(axis=2, keepdims=True)
    total = mask.sum()
    loss = -np.log(np.maximum(np.take_along_axis(prob, labels[:, None, None], 2)[:, :, 0], 1e-30))[mask].sum() / total
    d = prob.copy()
    d[np.arange(len(d)), :, labels] -= 1
    d = (d * mask[:, :, None] / total).astype(np.float32)
    g = {"o": np.tensordot(both, d, ((0, 1), (0, 1))), "c": d.sum(axis=(0, 1))}
    back = d @ p["o"].T
    hidden = len(p["hf"])
    for s, side in enumerate("fb"):
        x, h = "x" + side, "h" + side
        g[x], g[h] = np.zeros_like(p[x]), np.zeros_like(p[h])
        carry = np.zeros((len(codes), hidden), np.float32)
        for t, state, past, keep, reset, new, m in reversed(tapes[side]):
            dh = carry + back[:, t, s * hidden : (s + 1) * hidden]
            into = np.where(m, dh, 0)
            dnew = into * (1 - keep) * (1 - new * new)
            dkeep = into * (state - new) * keep * (1 - keep)
            dreset = dnew * past[:, 2 * hidden :] * reset * (1 - reset)
            down = np.concatenate([dkeep, dreset, dnew], axis=1)
            across = np.concatenate([dkeep, dreset, dnew * reset], axis=1)
            g[x] += _ONE_HOT[codes[:, t]].T @ down
            g[h] += state.T @ across
            carry = np.where(m, into * keep, dh) + across @ p[h].T
    return float(loss), g


def fit(words: list[bytes], labels: np.ndarray, classes: int, hidden: int = 16, steps: int = 800, batch: int = 256, rate: float = 0.01, seed: int = 3) -> dict[str, np.ndarray]:
    p = initial(hidden, classes, seed)
    rng = np.random.default_rng(seed)
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        some = rng.integers(0, len(words), batch)
        codes, lengths = padded([words[i] for i in some])
        _, g = gradients(codes, lengths, labels[some], p)
        scale = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k in p:
            first[k] += 0.1 * (g[k] - first[k])
            second[k] += 0.01 * (g[k] ** 2 - second[k])
            p[k] -= scale * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return p


def train(df: DataFrame, text: str, language: str, max_texts: int = 400, words_per_text: int = 60, steps: int = 800, hidden: int = 16) -> ByteGru:
    """Fit on the rows given: words at even distances of about `max_texts` texts per language."""
    own = df.select(F.col(quoted(text)).alias("t"), F.col(quoted(language)).alias("l")).where("t is not null and l is not null")
    languages = [r[0] for r in own.select("l").distinct().orderBy("l").collect()]
    lists, labels = [], []
    for k, name in enumerate(languages):
        split = F.filter(F.split(F.lower("t"), r"\s+"), lambda w: w.rlike(r"\p{L}"))
        rows = hashed_sample(own.where(F.col("l") == name), "t", max_texts).orderBy("t").select(split.alias("w")).select(
            F.filter("w", lambda w, i: i % F.greatest(F.ceil(F.size("w") / words_per_text), F.lit(1)) == 0).alias("w")).collect()
        words = [w.encode("utf-8", "surrogatepass")[:WIDTH] for r in rows for w in r[0]]
        lists.append(words)
        labels += [k] * len(words)
    every = [w for words in lists for w in words]
    if not every:
        return ByteGru([], {})
    weights = np.array(labels)
    # languages weigh alike: each is drawn from as often
    most = max(map(len, lists))
    again = np.concatenate([np.resize(np.flatnonzero(weights == k), most) for k in range(len(languages)) if lists[k]])
    return ByteGru(languages, fit([every[i] for i in again], weights[again], len(languages), hidden, steps))


def _document(model: ByteGru):
    """Pooled probabilities of a document, from remembered sums over each word's positions."""
    classes = len(model.languages)

    def compute(words: list[str]) -> list[int]:
        if not memo.table:
            store[0], store[1] = np.zeros((0, classes), np.float32), 0
        pieces, owner = [], []
        for k, word in enumerate(words):
            if classes and _has_letter(word):
                raw = word.encode("utf-8", "surrogatepass")
                for i in range(0, len(raw), WIDTH):
                    pieces.append(raw[i : i + WIDTH])
                    owner.append(k)
        sums = np.zeros((len(words), classes), np.float32)
        sizes = np.array([len(p) for p in pieces], np.int64)
        order, owner = np.argsort(sizes, kind="stable"), np.array(owner, np.int64)
        for start in range(0, len(order) if classes else 0, 2048):
            part = order[start : start + 2048]
            codes, lengths = padded([pieces[i] for i in part])
            np.add.at(sums, owner[part], positions(codes, lengths, model.params).sum(axis=1))
        begin = store[1]
        if begin + len(words) > len(store[0]):
            grown = np.zeros((max(2 * len(store[0]), begin + len(words)), classes), np.float32)
            grown[:begin] = store[0][:begin]
            store[0] = grown
        store[0][begin : begin + len(words)] = sums
        store[1] += len(words)
        return range(begin, begin + len(words))

    store = [np.zeros((0, classes), np.float32), 0]
    memo = Memo(compute, limit=500_000)

    def function(texts: list[str | None]) -> list:
        words = [t.lower().split() if t else [] for t in texts]
        table = memo.of(set().union(*words))
        counts = np.array([len(w) for w in words])
        sums = store[0][np.fromiter((table[w] for own in words for w in own), np.int64, counts.sum())]
        ends = np.r_[np.zeros((1, classes)), np.cumsum(sums, axis=0, dtype=float)][np.r_[0, np.cumsum(counts)]]
        pooled = np.diff(ends, axis=0)
        total = pooled.sum(axis=1)
        known = total > 1e-6
        best = pooled.argmax(axis=1) if classes else np.zeros(len(texts), int)
        score = np.where(known, pooled[np.arange(len(texts)), best] / np.maximum(total, 1e-6), 0.0) if classes else np.zeros(len(texts))
        return [[model.languages[b] if k else UNKNOWN for b, k in zip(best, known)], np.clip(score, 0, 1)]

    return function


def predict(df: DataFrame, model: ByteGru, text: str, keep: list[str]) -> DataFrame:
    """The kept columns, `lang_pred` and `score` (the mean probability of that language)."""
    return append_columns(df, text, lambda: _document(model), "lang_pred string, score double", keep)
