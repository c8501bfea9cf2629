"""Running a numpy or tokenizer function over the texts of a table, batch by batch.

The functions here never hold more than one Arrow batch, and never more than
`SLICE_BYTES` of its text as Python objects (one longer text is a slice of its own).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SLICE_BYTES = 4 << 20
#: Upper bounds of what Spark sends to a Python worker at once.
BATCH_SETTINGS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "4096", "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20)}


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fresh_name(taken: Iterable[str], name: str) -> str:
    """`name`, with underscores before it until no column is called so."""
    lowered = {t.lower() for t in taken}
    while name.lower() in lowered:
        name = f"_{name}"
    return name


def bounded_batches(df: DataFrame) -> DataFrame:
    for name, value in BATCH_SETTINGS.items():
        df.sparkSession.conf.set(name, value)
    return df


def hashed_sample(df: DataFrame, text: str, rows: int) -> DataFrame:
    """About `rows` distinct values of a text column, as a table of that one column; all of them where there are fewer.

    Values whose hash lies below a share of its range, so nothing is sorted or gathered,
    and copies of one text collapse before the shuffle.
    """
    own = df.select(F.col(quoted(text)).alias(text)).where(F.col(quoted(text)).isNotNull())
    code = F.xxhash64(quoted(text))
    distinct = own.agg(F.approx_count_distinct(code)).first()[0]
    return own.where(F.pmod(code, F.lit(1 << 32)) < int(min(1.0, rows / max(distinct, 1)) * (1 << 32))).dropDuplicates([text])


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of the batch with about SLICE_BYTES of text each."""
    lengths = np.asarray(pc.binary_length(batch.column(column)).fill_null(0))
    part = (np.cumsum(lengths, dtype=np.int64) - lengths) // SLICE_BYTES
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    for start, end in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(start, end - start)


def append_columns(df: DataFrame, text: str, make: Callable, fields: str, keep: Sequence[str], as_bytes: bool = False) -> DataFrame:
    """The columns `keep` of df, and those that a function computes from the texts.

    `make()` runs once per task and returns a function from a list of texts (str, or
    UTF-8 bytes; None for null) to one sequence per field. A kept column that is
    called like a field (given as DDL) gives way to it.
    """
    fields = T.StructType.fromDDL(fields)
    names = {f.name.lower() for f in fields.fields}
    kept = [c for c in keep if c.lower() not in names]
    own = text in kept
    source = df.select(*[F.col(quoted(c)) for c in kept], *([] if own else [F.col(quoted(text)).alias("__text")]))
    at = kept.index(text) if own else len(kept)
    schema = T.StructType([*(source.schema[c] for c in kept), *fields.fields])
    arrow = to_arrow_schema(schema)
    count = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for part in slices(batch, at):
                texts = part.column(at)
                values = function((texts.cast(pa.binary()) if as_bytes else texts).to_pylist())
                columns = [part.column(i) for i in range(count)]
                columns += [v if isinstance(v, pa.Array) else pa.array(v, arrow.field(count + i).type) for i, v in enumerate(values)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return bounded_batches(source).mapInArrow(run, schema)


class Memo:
    """Values of words, computed once per task for words not seen lately.

    `compute` takes a list of words and returns their values in order. Beyond `limit`
    entries the table is emptied, so its memory is bounded; values never depend on it.
    """

    def __init__(self, compute: Callable, limit: int = 300_000):
        self.compute, self.limit, self.table = compute, limit, {}

    def of(self, words: set) -> dict:
        missing = [w for w in words if w not in self.table]
        if len(self.table) + len(missing) > self.limit:
            self.table = {}
            missing = list(words)
        for start in range(0, len(missing), 50_000):
            some = missing[start : start + 50_000]
            self.table.update(zip(some, self.compute(some)))
        return self.table
