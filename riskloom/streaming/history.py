"""Monitoring with state: exact rank metrics per time window, and triggers across windows.

Two operators keep their own state. `ScoreCounts` holds, per window and stretch of scores, how
many positives and negatives each score has; `BandHistory` holds, per risk band, the sums of the
periods that are still open and of the last one that closed. Both write what changed in a
micro-batch, with totals so far, and a last word when the watermark passes the window's end.
The written tables are upserts: counts only grow and versions are part of the state, so a
replayed batch writes the same rows again and readers take the newest. The last windows are
in the tables too, marked as open.

Rows that arrive after the watermark has passed their time are left out, as in any stream.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from riskloom.functions.numbers import to_long
from riskloom.operators import drift
from riskloom.operators.metrics import metrics_of_counts
from riskloom.operators.ranking import cuts_passed

# tasks get these classes by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: State of `transformWithState` lives in this store.
STATE_SETTINGS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
#: Scores in [0, 1] fall into this many stretches, each a key of its own.
CELLS = 1024
COUNTS = "window_start long, window_end long, cell int, score double, pos long, neg long, closed boolean"
BANDS = "risk_band string, period_start long, n long, pd double, actual double, twice boolean, closed boolean, version long"


def with_state(spark: SparkSession) -> SparkSession:
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def _micros(values: pd.Series) -> int:
    return int(values.iloc[0])


class ScoreCounts(StatefulProcessor):
    """Positives and negatives per distinct score of one window and stretch, merged as rows arrive."""

    def init(self, handle: Any) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", "score binary, pos binary, neg binary")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        start, end, cell = (int(k) for k in key)
        parts = [(f["score"].to_numpy("float64"), f["positive"].to_numpy("int64")) for f in rows]
        score, positive = (np.concatenate(c) for c in zip(*parts))
        seen = np.unique(score)
        state = self.counts.get() if self.counts.exists() else None
        old = [np.frombuffer(b, t) for b, t in zip(state, ("float64", "int64", "int64"))] if state else [np.zeros(0), *[np.zeros(0, "int64")] * 2]
        values = np.union1d(old[0], seen)
        pos, neg = np.zeros(len(values), "int64"), np.zeros(len(values), "int64")
        at = np.searchsorted(values, old[0])
        pos[at], neg[at] = old[1], old[2]
        np.add.at(pos, np.searchsorted(values, score), positive)
        np.add.at(neg, np.searchsorted(values, score), 1 - positive)
        self.counts.update((values.tobytes(), pos.tobytes(), neg.tobytes()))
        self.handle.registerTimer(end // 1000)
        changed = np.searchsorted(values, seen)
        yield self._rows(start, end, cell, seen, pos[changed], neg[changed], False)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        start, end, cell = (int(k) for k in key)
        self.counts.clear()
        yield self._rows(start, end, cell, np.array([np.nan]), np.zeros(1, "int64"), np.zeros(1, "int64"), True)

    @staticmethod
    def _rows(start, end, cell, score, pos, neg, closed) -> pd.DataFrame:
        return pd.DataFrame({"window_start": start, "window_end": end, "cell": np.int32(cell), "score": score, "pos": pos, "neg": neg, "closed": closed})

    def close(self) -> None:
        pass


def score_counts(stream: DataFrame, time: str, score: str, outcome: str, length: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Changed (window, score) counts of every micro-batch."""
    p, window = F.col(score).cast("double"), F.window(time, length)
    rows = stream.filter(p.isNotNull() & F.col(outcome).isin(0, 1)).withWatermark(time, late).select(
        F.unix_micros(window["start"]).alias("window_start"), F.unix_micros(window["end"]).alias("window_end"),
        F.least(F.greatest(F.floor(p * CELLS), F.lit(0)), F.lit(CELLS - 1)).cast("int").alias("cell"),
        p.alias("score"), F.col(outcome).cast("long").alias("positive"), F.col(time).alias("_time"))
    return rows.groupBy("window_start", "window_end", "cell").transformWithStateInPandas(
        statefulProcessor=ScoreCounts(), outputStructType=COUNTS, outputMode="Append", timeMode="EventTime")


def newest_counts(written: DataFrame) -> DataFrame:
    """(window_start, score, pos, neg) as of the last batch."""
    return written.filter(~F.col("closed")).groupBy("window_start", "score").agg(F.max("pos").alias("pos"), F.max("neg").alias("neg"))


def window_rank_metrics(written: DataFrame) -> DataFrame:
    """A full metric row per window, `open` for windows that may still grow."""
    rows = metrics_of_counts(newest_counts(written), ["window_start"])
    closed = written.groupBy("window_start").agg((1 - F.max(F.col("closed").cast("int"))).alias("open"))
    return rows.join(closed, "window_start").withColumn("window_start", F.timestamp_micros("window_start"))


def band_sums(stream: DataFrame, time: str, length: str) -> DataFrame:
    """Sums per band and period of each Arrow batch: what a hot band sends on is a few rows a batch."""
    window = F.window(time, length)
    rows = stream.filter(F.col("risk_band").isNotNull()).select(
        "risk_band", F.unix_micros(window["start"]).alias("start"), F.unix_micros(window["end"]).alias("end"),
        F.col("predicted_pd").cast("double").alias("pd"), F.col("actual_default").cast("double").alias("actual"), F.col(time).alias("_time"))
    schema = "risk_band string, start long, end long, n long, pd double, actual double, _time timestamp"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            summed = pa.table(batch).group_by(["risk_band", "start", "end"]).aggregate(
                [("pd", "count"), ("pd", "sum"), ("actual", "sum"), ("_time", "max")])
            names = ["risk_band", "start", "end", "pd_count", "pd_sum", "actual_sum", "_time_max"]
            yield from summed.select(names).rename_columns(["risk_band", "start", "end", "n", "pd", "actual", "_time"]).to_batches()

    return rows.mapInArrow(add, schema)


class BandHistory(StatefulProcessor):
    """Observed against predicted rate of one band, period after period."""

    def __init__(self, tolerance: float):
        self.tolerance = tolerance

    def init(self, handle: Any) -> None:
        self.handle = handle
        self.periods = handle.getListState("periods", "start long, end long, n long, pd double, actual double, closed boolean")
        self.version = handle.getValueState("version", "n long")

    def _load(self) -> dict:
        return {int(r[0]): [int(r[1]), int(r[2]), float(r[3]), float(r[4]), bool(r[5])] for r in self.periods.get()}

    def _save(self, known: dict) -> int:
        self.periods.put([(start, *known[start]) for start in sorted(known)])
        number = (int(self.version.get()[0]) if self.version.exists() else 0) + 1
        self.version.update((number,))
        return number

    def _apart(self, period: list) -> bool:
        _, _, predicted, actual, _ = period
        return predicted != 0 and abs(actual - predicted) / abs(predicted) > self.tolerance

    def _rows(self, band: str, known: dict, starts: set, version: int) -> pd.DataFrame:
        order = sorted(known)
        rows = []
        for before, start in zip([None, *order], order):
            if start in starts or before in starts:
                _, n, predicted, actual, closed = known[start]
                twice = before is not None and self._apart(known[start]) and self._apart(known[before])
                rows.append((band, start, n, predicted, actual, twice, closed, version))
        return pd.DataFrame(rows, columns=["risk_band", "period_start", "n", "pd", "actual", "twice", "closed", "version"])

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        known, touched = self._load(), set()
        for frame in rows:
            for r in frame.itertuples(index=False):
                period = known.setdefault(int(r.start), [int(r.end), 0, 0.0, 0.0, False])
                period[1] += int(r.n)
                period[2] += float(r.pd)
                period[3] += float(r.actual)
                touched.add(int(r.start))
                self.handle.registerTimer(int(r.end) // 1000)
        yield self._rows(key[0], known, touched, self._save(known))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        known, now = self._load(), int(expiredTimerInfo.getExpiryTimeInMs())
        done = {start for start, period in known.items() if period[0] // 1000 <= now and not period[4]}
        for start in done:
            known[start][4] = True
        version = self._save(known)
        yield self._rows(key[0], known, done, version)
        # Of the closed periods only the newest is still somebody's predecessor.
        closed = sorted(start for start, period in known.items() if period[4])
        for start in closed[:-1]:
            del known[start]
        self.periods.put([(start, *known[start]) for start in sorted(known)])

    def close(self) -> None:
        pass


def band_history(stream: DataFrame, time: str, length: str, late: str = "1 hour", tolerance: float = 0.30) -> DataFrame:
    """Changed periods of every band, and whether the band was off in two periods running."""
    sums = band_sums(stream, time, length).withWatermark("_time", late)
    return sums.groupBy("risk_band").transformWithStateInPandas(
        statefulProcessor=BandHistory(tolerance), outputStructType=BANDS, outputMode="Append", timeMode="EventTime")


def newest_bands(written: DataFrame) -> DataFrame:
    """One row per band and period, as written last."""
    names = ["n", "pd", "actual", "twice", "closed"]
    return written.groupBy("risk_band", "period_start").agg(F.max_by(F.struct(*names), "version").alias("_last")).select(
        "risk_band", "period_start", *[F.col(f"_last.{c}").alias(c) for c in names])


def feature_counts(stream: DataFrame, time: str, features: list[str], edges: DataFrame, length: str, late: str = "1 hour") -> DataFrame:
    """Rows per window, feature and bin of the reference, totals so far; run in update mode."""
    long = to_long(stream.withWatermark(time, late), features, keep=[time]).filter(F.col("value").isNotNull())
    placed = long.join(F.broadcast(edges), "feature")  # one row per column
    return placed.groupBy(F.window(time, length).alias("_w"), "feature", cuts_passed(F.col("value"), len(drift.EDGES), True).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")).select(F.unix_micros(F.col("_w.start")).alias("window_start"), "feature", "bin", "n")


def upserts(sink: str) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` function: each batch in a folder of its own, so a replayed one replaces itself."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/number={number}")

    return write


def run_upserts(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> None:
    """Drain the waiting input into upsert rows and stop."""
    query = (stream.writeStream.foreachBatch(upserts(sink)).outputMode(mode).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def replayed_triggers(scores: DataFrame, bands: DataFrame, bins: DataFrame, edges: DataFrame, expected: DataFrame,
                      validated: DataFrame, brier_margin: float = 0.01) -> DataFrame:
    """Retraining triggers per window from the three written tables.

    `expected` holds the reference's (feature, bin, n), `validated` the metric row of the test fold.
    """
    period = "window_start"
    counts = bins.groupBy(period, "feature", "bin").agg(F.max("n").alias("n"))
    index = drift.index_of_counts(edges, expected, counts, [period])
    periods = metrics_of_counts(newest_counts(scores), [period])
    twice = newest_bands(bands).groupBy(F.col("period_start").alias(period)).agg(F.max(F.col("twice").cast("int")).alias("twice"))
    return drift.trigger_rows(index, validated, periods, twice, period, brier_margin)
