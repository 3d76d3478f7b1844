"""Streams of arriving files through the batch operators."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

from textquarry.functions.hashing import content_hash


def stream_documents(
    spark: SparkSession, path: str, schema: str, kind: str = "json", files_per_batch: int = 1000
) -> DataFrame:
    """New files below ``path`` as a stream; the schema is declared, never inferred."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.format(kind).load(path)


def run_to_parquet(df: DataFrame, path: str, checkpoint: str, **settings: str) -> list[dict]:
    """Process everything that has arrived, append the result once, and stop.

    Finished files are recorded in the checkpoint. A second run, or a run after a
    failure, handles only what is new, and the file sink's log makes each batch
    visible exactly once. ``settings`` hold while the query starts, which then keeps
    them; the result is its progress, batch by batch.
    """
    conf = df.sparkSession.conf
    before = {k: conf.get(k, None) for k in settings}
    for k, v in settings.items():
        conf.set(k, v)
    try:
        query = (
            df.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)
    query.awaitTermination()
    return [json.loads(p.json) for p in query.recentProgress]


# What ``stream_merge_chunks`` needs: state that is written by the key, not as a whole.
KEYED_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}


def stream_dedup(df: DataFrame, content: Column, event_time: str, within: str) -> DataFrame:
    """Rows of a stream whose content has not come before, as long as it is remembered.

    A content is known by its hash and remembered until the watermark, ``within`` behind the
    latest event time, has passed its first row by ``within``: a repetition up to then is
    dropped, one that comes after its hash was forgotten is new. So the state holds one hash
    for each content of the time span, however long the stream runs. Rows later than the
    watermark are dropped. A NULL content is a content.
    """
    keyed = df.withWatermark(event_time, within).withColumn("_content", F.coalesce(content_hash(content), F.lit("")))
    return keyed.dropDuplicatesWithinWatermark(["_content"]).drop("_content")


class _ChunkMerger(StatefulProcessor):
    """Chunks of one document by number, until all have come or its timer expires."""

    def __init__(self, sep: str, patience_ms: int):
        self.sep, self.patience_ms = sep, patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getMapState("chunks", "chunk_id int", "text string, finish_reason string")
        self.known = handle.getValueState("known", "have int, total int, stopped boolean, until bigint")

    def _row(self, key, outcome: str) -> pd.DataFrame:
        ordered = sorted((k[0], v[0]) for k, v in self.chunks.iterator())
        text = self.sep.join(x for _, x in ordered)
        self.chunks.clear()
        self.known.clear()
        return pd.DataFrame({"id": [key[0]], "text": [text], "outcome": [outcome]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        have, total, stopped, until = self.known.get() or (0, None, True, None)
        come, latest = 0, None
        for pdf in rows:
            pdf = pdf[pdf["chunk_id"] >= 0]
            for chunk_id, text, finish, number, at in zip(
                *(pdf[c] for c in ("chunk_id", "text", "finish_reason", "num_chunks", "at_ms"))
            ):
                come += 1
                if not self.chunks.containsKey((int(chunk_id),)):
                    self.chunks.updateValue((int(chunk_id),), (text, finish))
                    have, stopped = have + 1, bool(stopped and finish == "stop")
                total, latest = int(number), max(int(at), latest or 0)
        if not come:
            return
        if until is not None:
            self.handle.deleteTimer(until)
        if have == total:
            yield self._row(key, "merged" if stopped else "rejected")
        else:
            until = max(latest + self.patience_ms, timerValues.getCurrentWatermarkInMs() + 1)
            self.handle.registerTimer(until)
            self.known.update((have, total, stopped, until))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._row(key, "incomplete")

    def close(self) -> None:
        pass


def stream_merge_chunks(
    df: DataFrame, sep: str = "\n\n", event_time: str = "arrived_at", late: str = "1 hour", patience_ms: int = 3_600_000
) -> DataFrame:
    """Hold the chunks of each document until all have come, then emit the text.

    The outcome is ``merged``, ``rejected`` if a chunk did not finish with ``stop``, or
    ``incomplete`` for a document whose last chunk lies ``patience_ms`` behind the watermark: its
    timer then gives up what it has. Chunks are kept in a map by their number, so a batch
    writes its own chunks only, and a chunk that comes twice counts once. A row with a
    negative ``chunk_id`` moves the clock and nothing else. Run it with ``KEYED_STATE``.
    """
    timed = df.withWatermark(event_time, late).withColumn("at_ms", F.unix_millis(event_time))
    return timed.groupBy("id").transformWithStateInPandas(
        _ChunkMerger(sep, patience_ms), "id string, text string, outcome string", "append", "EventTime"
    )


def stream_step_stats(df: DataFrame, window: str = "5 minutes", late: str = "10 minutes", limit: float | None = None) -> DataFrame:
    """Step times per run and time window while a run is going on.

    A window is emitted once, when the watermark has passed it, and its state is dropped.
    With a ``limit`` the result tells in which windows a step took longer; ``StopAtLimit``
    ends the stream there.
    """
    over = F.col("step_seconds") > limit if limit is not None else F.lit(False)
    return (
        df.withWatermark("logged_at", late)
        .groupBy("run", F.window("logged_at", window))
        .agg(
            F.count("step_seconds").alias("steps"),
            F.avg("step_seconds").alias("mean_step_seconds"),
            F.max("step_seconds").alias("max_step_seconds"),
            F.bool_or(over).alias("over_limit"),
        )
        .select("run", F.col("window.start").alias("window_start"), "steps", "mean_step_seconds", "max_step_seconds", "over_limit")
    )


class StopAtLimit(StreamingQueryListener):
    """Stops every stream whose batches report a step over the limit.

    The stream says so itself: ``watched`` adds the largest step time of each batch to its
    progress. Add the listener with ``spark.streams.addListener``; ``stopped`` holds the
    run ids it has ended and the step time that ended each.
    """

    METRIC = "step_limit"

    def __init__(self, spark: SparkSession, limit: float):
        self.spark, self.limit, self.stopped = spark, limit, {}

    @classmethod
    def watched(cls, df: DataFrame, step_seconds: str = "step_seconds") -> DataFrame:
        return df.observe(cls.METRIC, F.max(step_seconds).alias("most"))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.METRIC)
        if seen is None or seen.most is None or seen.most <= self.limit:
            return
        run, query = str(event.progress.runId), self.spark.streams.get(str(event.progress.id))
        if query is not None and run not in self.stopped:
            self.stopped[run] = seen.most
            # Stopping waits for the query, whose progress this call still holds up.
            threading.Thread(target=query.stop, daemon=True).start()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def compose(df: DataFrame, steps: list[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Chain batch operators; they work unchanged on a stream if they keep no global order."""
    for step in steps:
        df = df.transform(step)
    return df
