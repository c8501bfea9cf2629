"""Sampled segmentations of a SentencePiece model, reproducible by row key.

The lattice of a text holds every way to write it in pieces of the model; a segmentation
has probability proportional to the product of its pieces' weights, and forward filtering
followed by backward sampling draws from exactly that distribution. No piece of more than
blanks spans a word border (nor, in this model, one between ASCII signs and others), so
the lattice of a text is a chain of word lattices; each
distinct word is filtered once, and all its occurrences are sampled together, each
with random numbers of its own, hashed from (row key, place in the text, step).

A merge-ordered model has ranks, no probabilities; a piece's weight is
(1 + rank) ** -sharpness, after Zipf's law. Characters without a piece fall back to
their bytes. Encoding puts one blank before the text, as the model asks for, and decoding
takes it away again, so decoding gives the text back exactly.

A word of any length has one lattice. It is filtered with a band of as many nodes as the
longest piece has characters, in windows of `WINDOW` characters, so time and memory grow
with its length (its edges are kept until the samples are drawn).

Defined cases: null and empty texts have no pieces; a U+2581 in the text itself is spelled
in bytes, as the model writes blanks so; a null key counts as 0; equal keys and equal
texts give equal pieces.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame

from riskloom.llm.batches import Memo, append_columns, quoted

BLANK = "▁"
#: Stands for a U+2581 of the text itself until it is spelled; no text or piece has a lone surrogate.
LITERAL = "\udc00"
#: Words to `SHORT` characters are filtered with those of the same length, longer ones with those up to an eighth longer.
#: A worker's table is emptied beyond EDGES edges (28 bytes each) or 150,000 words.
SHORT, WINDOW, EDGES = 48, 1 << 14, 1 << 22
#: Words with the blanks before them; ASCII signs apart from other characters where no piece has both.
_SIGN = r"\x00-/:-@\[-`{-\x7f"
_WORDS = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
_PARTS = re.compile(f"{BLANK}*(?:[^{_SIGN}{BLANK}]+|[{_SIGN}]+)|{BLANK}+")
_MIXED = re.compile(f"[^{_SIGN}{BLANK}][{_SIGN}]|[{_SIGN}][^{_SIGN}{BLANK}]")


def load(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


class Lattices:
    """Edges of the word lattices seen so far, ready for backward sampling.

    State: the first edge of each node and, per edge, the cumulative probability among the
    node's edges (2 for the last), the piece, and the node it leads back to (-1 at the
    word's beginning). A negative piece is a character to be spelled in bytes.
    """

    def __init__(self, model, sharpness: float):
        size = model.get_piece_size()
        self.unknown = model.unk_id()
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        special = {*self.byte_ids, self.unknown} | {i for i in range(size) if model.is_control(i)}
        names, weights, pieces = [], [0.0], [0]
        for i in range(size):
            if i not in special:
                rank = max(-model.get_score(i), 0.0)
                names.append(model.id_to_piece(i))
                weights.append(float((1 + min(rank, size)) ** -sharpness))
                pieces.append(i)
        self.weights, self.ids = np.array(weights), np.array(pieces, np.int32)
        self.words = _WORDS if any(map(_MIXED.search, names)) else _PARTS
        self.rare, self.longest = min(weights[1:]), max(map(len, names))
        self._index(names)
        self.reset()

    def _index(self, names: list[str]) -> None:
        """Sorted hashes, found by their upper 16 bits: from a piece's hash to its row in `weights` and `ids`."""
        keys = np.zeros(len(names), np.uint64)
        for k, name in enumerate(names):
            h = np.zeros(1, np.uint64)
            for char in name:
                h = rolled(h, np.array([ord(char)], np.uint64))
            keys[k] = h[0]
        order = np.argsort(keys)
        self.keys, self.rows = keys[order], (order + 1).astype(np.int32)
        self.first = np.searchsorted(self.keys, np.arange(1 << 16, dtype=np.uint64) << np.uint64(48))
        self.deep = int(np.diff(np.r_[self.first, len(self.keys)]).max())
        self.keys = np.r_[self.keys, np.zeros(self.deep, np.uint64)]
        self.rows = np.r_[self.rows, np.zeros(self.deep, np.int32)]

    def _rows(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each hash, 0 if it is no piece's: a look into the few keys with the same upper 16 bits."""
        at = self.first[hashes >> np.uint64(48)]
        out = np.zeros(len(hashes), np.int32)
        for _ in range(self.deep):
            same = self.keys[at] == hashes
            out[same] = self.rows[at[same]]
            at = at + 1
        return out

    def reset(self) -> None:
        self.parts = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int32), np.zeros(0, np.int64))]
        self.nodes = self.edges = 0

    def add(self, words: list[str]) -> list[int]:
        """Filter words forward, those of like length together; the number of each word's last node."""
        lengths = np.array([len(w) for w in words])
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        begins = np.cumsum(lengths) - lengths
        lasts = np.zeros(len(words), np.int64)
        grade = 1 + np.floor(np.log(np.maximum(lengths, SHORT) / SHORT) / np.log(1.125)).astype(np.int64)
        group = np.where(lengths <= SHORT, lengths, SHORT + grade)
        for g in np.unique(group):
            of_group = np.flatnonzero(group == g)
            width = int(lengths[of_group].max())
            band = min(width, self.longest)
            for start in range(0, len(of_group), step := max(1, (1 << 19) // (min(width, WINDOW) * band))):
                rows = of_group[start : start + step]
                inside = np.arange(width) < lengths[rows][:, None]
                at = np.where(inside, begins[rows][:, None] + np.arange(width), 0)
                lasts[rows] = self._filter(np.where(inside, points[at], np.uint64(0)), lengths[rows])
        return lasts.tolist()

    def _filter(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Filter words given as rows of characters, filled up behind their ends; a word's node is its row's and its last character's."""
        n, width = codes.shape
        band = min(width, self.longest)
        forward = np.zeros((n, band))  # of the places from which a piece can reach the present end
        forward[:, -1] = 1
        found = []
        for first in range(0, width, WINDOW):
            last = min(first + WINDOW, width)
            share, piece = self._window(codes, first, last, band)
            piece[np.arange(first, last) >= lengths[:, None]] = 0
            for end in range(last - first):
                share[:, end] = np.cumsum(share[:, end] * forward, axis=1)
                total = share[:, end, -1:].copy()
                share[:, end] /= total
                forward[:, :-1] = forward[:, 1:] / total  # only ratios matter; this one becomes 1
                forward[:, -1] = 1
            word, end, slot = np.nonzero(piece)
            found.append((word, end + first, end + first + slot + 1 - band, share[word, end, slot], piece[word, end, slot]))
        word, end, begin, bounds, drawn = map(np.concatenate, zip(*found))
        if len(found) > 1:
            order = np.lexsort((begin, end, word))
            word, end, begin, bounds, drawn = (x[order] for x in (word, end, begin, bounds, drawn))
        counts = np.bincount(word * width + end, minlength=n * width)
        starts = np.cumsum(counts) - counts
        bounds[(starts + counts - 1)[counts > 0]] = 2.0
        back = np.where(begin == 0, -1, self.nodes + word * width + begin - 1)
        self.parts.append((starts + self.edges, bounds, drawn, back))
        lasts = self.nodes + np.arange(n) * width + lengths - 1
        self.nodes += n * width
        self.edges += len(bounds)
        return lasts

    def _window(self, codes: np.ndarray, first: int, last: int, band: int) -> tuple[np.ndarray, np.ndarray]:
        """Weights and pieces by (word, end from first to last, begin among the `band` places before the end)."""
        n = len(codes)
        share, piece = np.zeros((n, last - first, band)), np.zeros((n, last - first, band), np.int32)
        low = max(0, first + 1 - band)
        h = np.zeros((n, last - low), np.uint64)
        for size in range(1, min(band, last - low) + 1):
            h = rolled(h[:, : last - low - size + 1], codes[:, low + size - 1 : last])
            skip = max(0, first - (low + size - 1))
            own = h[:, skip:]
            row = self._rows(own.ravel()).reshape(own.shape)
            to = slice(low + size - 1 + skip - first, None)
            share[:, to, band - size], piece[:, to, band - size] = self.weights[row], self.ids[row]
        lone = piece[:, :, -1] == 0
        share[:, :, -1][lone] = self.rare
        piece[:, :, -1][lone] = -1 - codes[:, first:last][lone].astype(np.int32)
        return share, piece

    def sample(self, nodes: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward samples: (which of the nodes, step from the end, piece) of every piece drawn."""
        self.parts = [tuple(map(np.concatenate, zip(*self.parts)))]
        starts, bounds, pieces, back = self.parts[0]
        who, at, out, step = np.arange(len(nodes)), nodes, [], 0
        while len(who):
            edge, draw = starts[at], uniform(seeds[who], step)
            far = np.flatnonzero(draw >= bounds[edge])
            while len(far):
                edge[far] += 1
                far = far[draw[far] >= bounds[edge[far]]]
            out.append((who, np.full(len(who), step, np.int32), pieces[edge]))
            at = back[edge]
            who, at, step = who[at >= 0], at[at >= 0], step + 1
        return tuple(map(np.concatenate, zip(*out))) if out else (np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32))


def rolled(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of strings that are one character longer."""
    h = (hashes + codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the result depends on every bit of x."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(seeds: np.ndarray, step: int) -> np.ndarray:
    """Numbers in [0, 1) from seeds and step."""
    return (mixed(seeds + np.uint64((step + 1) * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(24)).astype(float) / 2.0**40


def row_seed(key: int | None, seed: int) -> int:
    return (zlib.crc32(str(key or 0).encode()) << 32 | zlib.crc32(f"{seed}:{key or 0}".encode())) & (2**64 - 1)


class Encoder:
    def __init__(self, path: str, sharpness: float, seed: int):
        self.lattices = Lattices(load(path), sharpness)
        self.seed = seed
        self.memo = Memo(self._add, limit=150_000)

    def _add(self, words: list[str]) -> list[int]:
        if not self.memo.table:
            self.lattices.reset()
        return self.lattices.add(words)

    def __call__(self, keys: list, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All rows' piece ids, one after the other, and where each row begins (one more at the end)."""
        words = [self.lattices.words.findall(BLANK + t.replace(BLANK, LITERAL).replace(" ", BLANK)) if t else [] for t in texts]
        counts = np.array([len(w) for w in words], np.int64)
        if self.lattices.edges > EDGES:  # long words: the table would not be full for long
            self.memo.table = {}
        table = self.memo.of(set().union(*words))
        nodes = np.fromiter((table[w] for own in words for w in own), np.int64, counts.sum())
        row = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(len(nodes)) - np.repeat(np.cumsum(counts) - counts, counts)
        seeds = mixed(np.array([row_seed(k, self.seed) for k in keys], np.uint64)[row] + place.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        who, step, piece = self.lattices.sample(nodes, seeds)
        # Pieces were drawn from the end of each word: put them in reading order.
        depth = np.bincount(who, minlength=len(nodes))
        first = np.cumsum(depth) - depth
        ids = np.empty(len(piece), np.int32)
        ids[first[who] + depth[who] - 1 - step] = piece
        widths = np.ones(len(ids), np.int64)
        odd = np.flatnonzero(ids < 0)
        if len(odd):  # a character without a piece: its bytes
            parts = [[self.lattices.byte_ids[b] for b in chr(-1 - ids[i]).replace(LITERAL, BLANK).encode("utf-8", "surrogatepass")] for i in odd]
            widths[odd] = [len(p) for p in parts]
            wide = np.repeat(ids, widths)
            begins = np.cumsum(widths) - widths
            for i, part in zip(odd, parts):
                wide[begins[i] : begins[i] + len(part)] = part
            ids = wide
        per_word = np.add.reduceat(widths, first) if len(nodes) else np.zeros(0, np.int64)
        per_row = np.bincount(row, per_word, len(texts)).astype(np.int64)
        return ids, np.r_[0, np.cumsum(per_row)]


def encode_rows(df: DataFrame, key: str, text: str, path: str, sharpness: float = 1.0, seed: int = 0, name: str = "ids") -> DataFrame:
    """The key and the sampled piece ids (array of int) of each row."""
    import pyarrow as pa

    from pyspark.sql import functions as F

    from riskloom.llm.batches import bounded_batches, slices

    source = bounded_batches(df.select(F.col(quoted(key)).cast("long").alias("__key"), F.col(quoted(text)).alias("__text")))
    schema = pa.schema([("key", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        encoder = Encoder(path, sharpness, seed)
        for batch in batches:
            for part in slices(batch, 1):
                ids, offsets = encoder(part.column(0).to_pylist(), part.column(1).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], schema=schema)

    out = source.mapInArrow(run, "key long, ids array<int>")
    return out.select(F.col("key").alias(key), F.col("ids").alias(name))


def decode_rows(df: DataFrame, ids: str, path: str, keep: list[str], name: str = "text") -> DataFrame:
    """The kept columns and the text that each row's piece ids stand for."""
    import pyarrow as pa

    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    from riskloom.llm.batches import bounded_batches

    source = bounded_batches(df.select(*[F.col(quoted(c)) for c in keep], F.col(quoted(ids)).alias("__ids")))
    schema = T.StructType([*(source.schema[c] for c in keep), T.StructField(name, T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        spell = Spelling(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = spell(part.column(len(keep)))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), texts], schema=arrow)

    return source.mapInArrow(run, schema)


class Spelling:
    """The bytes of every piece, in one row of memory, to put texts together by copying stretches."""

    def __init__(self, path: str):
        model = load(path)
        spelled = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                spelled.append(bytes([int(piece[3:-1], 16)]))
            else:
                spelled.append(b"" if model.is_control(i) else piece.replace(BLANK, " ").encode())
        self.sizes = np.array([len(s) for s in spelled], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)

    def __call__(self, lists):
        import pyarrow as pa

        ids = lists.flatten().to_numpy()
        offsets = np.asarray(lists.offsets, np.int64) - (lists.offsets[0].as_py() if len(lists.offsets) else 0)
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        spelled = self.bytes[np.repeat(self.begins[ids] - (ends - sizes), sizes) + np.arange(total)].tobytes()
        bounds = np.r_[0, ends][offsets]
        return pa.array([spelled[a + 1 : b].decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:])], pa.string())
