"""Sum-of-squares online packing of tokenized documents.

Documents come one after the other. Whole windows of a document's tokens are sequences of
their own; what is left goes to the open window of that fill level which makes the sum of
squared counts of partially filled windows, kept in an array by level, least. Each
partition of the input packs its own documents, so nothing is shuffled and nothing meets
in one task; a sequence's id holds its partition.

Windows still open at a partition's end (or when there are `most_open` of them) are
filled up from the emptiest ones, whose pieces are cut where needed; the last one is cut
into sequences whose lengths are powers of two, which need no padding.

Defined cases: a null text is empty, and has only the end token; repeated rows and null
ids are packed as any other; a lost task packs its partition again, with the same result
for the same rows in the same order.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.batches import bounded_batches, quoted, slices

LENGTH, END = 2048, 1
#: Ids of longer texts (in characters) come in a buffer, slower than a list and a ninth of its size.
LONG = 1 << 20
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: How byte-level vocabularies split text before merging (a fixed value of theirs).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same split for texts without long runs of white space.
PLAIN = r"""'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"""


def byte_characters() -> dict[str, int]:
    """The printable characters that stand for bytes in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Tokens:
    """Token ids of texts by a byte-level tokenizers file.

    tiktoken runs the vocabulary's merges on whole texts. It gives the same ids as the
    tokenizers library where a text has printable characters, line breaks and tabs only
    and no control strings; all other texts go to the tokenizers library itself. The
    vocabulary's split looks ahead from each run of white space; where no run is longer
    than two characters, and none of two ends the text, each white-space character that no
    word takes is a part of its own, and a pattern that never looks ahead splits alike in
    about half the time.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        special = [t["content"] for t in file["added_tokens"]]
        chars, vocabulary = byte_characters(), file["model"]["vocab"]
        spelled = {bytes(chars[c] for c in token): i for token, i in vocabulary.items() if token not in special}
        merged = [vocabulary[a + b] for a, b in file["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError("the vocabulary's ids are not in the order of its merges")
        self.special = special
        self.general, self.plain = (tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=spelled, special_tokens={})
                                    for name, pattern in (("general", PATTERN), ("plain", PLAIN)))

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        blank = text.replace("\n", " ").replace("\r", " ").replace("\t", " ")
        if not blank.isprintable() or any(x in text for x in self.special):
            return np.array(self.model.encode(text, add_special_tokens=False).ids, np.uint32)
        long_runs = "   " in blank or blank.endswith("  ")
        split = self.general if long_runs else self.plain
        return split.encode_to_numpy(text) if len(text) > LONG else np.array(split.encode_ordinary(text), np.uint32)

    def __call__(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        return map(self.ids, texts)


@lru_cache(1)
def _tokens(path: str) -> Tokens:
    """The tokens of a vocabulary file, kept by a Python worker from task to task."""
    return Tokens(path)


class Packer:
    """The level array and the open windows of one partition; pieces are (doc, start, tokens, doc_tokens)."""

    def __init__(self, length: int = LENGTH, most_open: int = 4096):
        self.length, self.most_open = length, most_open
        self.levels = np.zeros(length + 1, np.int64)
        self.open: list[list] = [[] for _ in range(length + 1)]  # by level, windows as lists of pieces
        self.count = 0

    def add(self, doc, ids: np.ndarray) -> Iterator[list[tuple]]:
        """The windows that this document's tokens complete."""
        total, at = len(ids), 0
        while total - at >= self.length:
            yield [(doc, at, ids[at : at + self.length], total)]
            at += self.length
        size = total - at
        if not size:
            return
        # Putting it on level h changes the sum of squares by 2 (N[h + size] - N[h]) + 2; a full
        # window doesn't count, and neither does an empty one.
        reach = self.length - size
        gain = self.levels[size : self.length + 1] - self.levels[: reach + 1]
        gain[reach] = -self.levels[reach]
        cost = 2 * gain + np.where(np.arange(reach + 1) == reach, 1, 2)
        cost[0] = 2 * self.levels[size] + 1 if reach else 0
        cost[1:][self.levels[1 : reach + 1] == 0] = np.iinfo(np.int64).max
        level = int(np.argmin(cost))
        window = []
        if level:
            window = self.open[level].pop()
            self.levels[level] -= 1
            self.count -= 1
        window.append((doc, at, ids[at:].copy(), total))
        if level + size == self.length:
            yield window
            return
        self.open[level + size].append(window)
        self.levels[level + size] += 1
        self.count += 1
        if self.count >= self.most_open:
            *full, rest = self.refilled()
            yield from full
            if sum(len(p[2]) for p in rest) == self.length:
                yield rest
            else:
                self._reopen(rest)

    def _reopen(self, window: list[tuple]) -> None:
        level = sum(len(p[2]) for p in window)
        self.open[level].append(window)
        self.levels[level] += 1
        self.count += 1

    def refilled(self) -> list[list[tuple]]:
        """The open windows as full ones and one rest: the fullest are filled up from the emptiest."""
        windows = [w for level in range(self.length, 0, -1) for w in self.open[level]]
        self.open = [[] for _ in range(self.length + 1)]
        self.levels[:], self.count = 0, 0
        out, low = [], len(windows) - 1
        high, giver = 0, []
        while high <= low or giver:
            if high <= low:
                window, high = windows[high], high + 1
            else:
                window, giver = giver, []
            room = self.length - sum(len(p[2]) for p in window)
            while room:
                if not giver:
                    if high > low:
                        break
                    giver, low = windows[low], low - 1
                doc, start, ids, total = giver.pop()
                window.append((doc, start, ids[:room], total))
                if len(ids) > room:
                    giver.append((doc, start + room, ids[room:], total))
                room -= len(window[-1][2])
            out.append(window)
        return out

    def finish(self) -> Iterator[list[tuple]]:
        """What is left, the last window cut into sequences of power-of-two lengths."""
        windows = self.refilled()
        yield from windows[:-1]
        rest = windows[-1] if windows else []
        left = sum(len(p[2]) for p in rest)
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            sequence = []
            while size:
                doc, start, ids, total = rest.pop(0)
                sequence.append((doc, start, ids[:size], total))
                if len(ids) > size:
                    rest.insert(0, (doc, start + size, ids[size:], total))
                size -= len(sequence[-1][2])
            yield sequence


def pack(df: DataFrame, id_col: str, text_col: str, path: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """One row per piece; see SCHEMA. start and offset count tokens from 0."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql import types as T

    source = df.select(F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(text_col)).alias("text"))
    arrow = to_arrow_schema(T.StructType.fromDDL(SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens, packer = _tokens(path), Packer(length)
        sequence = TaskContext.get().partitionId() << 40
        rows = []

        def emit(window: list[tuple]) -> None:
            nonlocal sequence
            offset = 0
            for doc, start, ids, total in window:
                rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, offset))
                offset += len(ids)
            sequence += 1

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)
            rows.clear()
            return out

        for batch in batches:
            for part in slices(batch, 1):
                for doc, ids in zip(part.column(0).to_pylist(), tokens(part.column(1).to_pylist())):
                    for window in packer.add(doc, np.append(ids, np.uint32(end))):
                        emit(window)
                    if len(rows) > 20_000:
                        yield flush()
        for window in packer.finish():
            emit(window)
        if rows:
            yield flush()

    return bounded_batches(source).mapInArrow(run, SCHEMA)
