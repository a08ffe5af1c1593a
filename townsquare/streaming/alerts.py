"""The daily monitor with its running figures and alerts as a stream (K1, K2 and E7 live, on K5).

Two stateful steps. Spark's windowed aggregation counts the posts of each open (day, source), so that a busy
source is summed map-side and its posts never meet in one task. What closes, one row per day and source, goes to keyed state:
the last closed day, running count statistics and the last days' sentiment of each source. Days without posts are
closed too, by the next day that has some or, where a source falls silent, by an event-time timer.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from townsquare.plans.monitor import SENTIMENT_DROP, VOLUME_MIN_DAYS, VOLUME_SIGMA, WATCH_SCHEMA
from townsquare.streaming.daily import daily_stream, start_daily

DAY = dt.timedelta(days=1)
_PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _millis(day: dt.date) -> int:
    """The start of a UTC day."""
    return int(dt.datetime(day.year, day.month, day.day, tzinfo=dt.UTC).timestamp() * 1000)


class DailyWatch(StatefulProcessor):
    """Closes the days of one source in order; state is a few numbers per source."""

    def __init__(self, drop: float, sigma: float, min_days: int) -> None:
        self.drop, self.sigma, self.min_days = drop, sigma, min_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Sums of whole numbers are exact in doubles up to 2**53.
        self.state = handle.getValueState("closed", "day date, days long, total double, squares double, before double, last double")

    def _close(self, source: str, state: tuple | None, day: dt.date, count: int, sentiment: float | None) -> tuple[tuple, Row]:
        _, days, total, squares, before, last = state or (None, 0, 0.0, 0.0, None, None)
        days, total, squares = days + 1, total + count, squares + float(count) ** 2
        recent = [v for v in (before, last, sentiment) if v is not None]
        limit = None
        if days > 1:
            limit = total / days + self.sigma * math.sqrt(max(0.0, (squares - total * total / days) / (days - 1)))
        row = Row(
            data_source=source, day=day, count=count, mean_sentiment=sentiment,
            recent_sentiment=sum(recent) / len(recent) if recent else None, limit=limit,
            volume_alert=days > self.min_days and limit is not None and count > limit,
            sentiment_alert=sentiment is not None and sentiment < self.drop,
        )
        return (day, days, total, squares, last, sentiment), row

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state = tuple(self.state.get()) if self.state.exists() else None
        out = []
        for r in sorted(rows, key=lambda r: r["day"]):
            while state is not None and state[0] + DAY < r["day"]:
                state, row = self._close(key[0], state, state[0] + DAY, 0, None)
                out.append(row)
            state, row = self._close(key[0], state, r["day"], r["count"], r["mean_sentiment"])
            out.append(row)
        if state is not None:
            self._keep(state)
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = tuple(self.state.get())
        out = []
        while _millis(state[0] + 2 * DAY) <= timerValues.getCurrentWatermarkInMs():
            state, row = self._close(key[0], state, state[0] + DAY, 0, None)
            out.append(row)
        self._keep(state)
        return iter(out)

    def _keep(self, state: tuple) -> None:
        self.state.update(state)
        # The day after the last closed one is over when the watermark passes its end.
        self.handle.registerTimer(_millis(state[0] + 2 * DAY))

    def close(self) -> None:
        pass


def watch_stream(
    posts: DataFrame,
    lateness: str = "2 days",
    drop: float = SENTIMENT_DROP,
    sigma: float = VOLUME_SIGMA,
    min_days: int = VOLUME_MIN_DAYS,
) -> DataFrame:
    """Closed days of each source as ``plans.monitor.daily_watch`` has them, as a stream.

    ``posts`` streams ``created_at``, ``data_source`` and ``sentiment_compound``. A day closes when the newest time
    seen less ``lateness`` passes its end; posts that come later still are dropped. Posts without a time or source are no part
    of any day.
    """
    known = posts.filter("created_at is not null and data_source is not null")
    closed = daily_stream(known, lateness, keep_time=True).select("data_source", "closed_at", "day", "count", "mean_sentiment")
    return closed.groupBy("data_source").transformWithState(
        statefulProcessor=DailyWatch(drop, sigma, min_days), outputStructType=WATCH_SCHEMA, outputMode="Append", timeMode="EventTime"
    )


@contextmanager
def _keyed_state(spark: SparkSession) -> Iterator[None]:
    """Keyed state with timers needs the RocksDB store; a query keeps the setting it started with."""
    before = spark.conf.get(_PROVIDER_CONF)
    spark.conf.set(_PROVIDER_CONF, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER_CONF, before)


def start_watch(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the watched days to a Parquet table, taking the input at hand and then stopping."""
    with _keyed_state(stream.sparkSession):
        return start_daily(stream, path, checkpoint)
