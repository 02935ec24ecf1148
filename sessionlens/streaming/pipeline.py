"""The chain over two streams (STR-1 to STR-13): checks, time-to-live dedup and batch-local conflicts up to the clean messages;
then storage, which takes a key's first clean message ever and logs the others.

Late records are told by their arrival, not by the stream's progress. Dedup keeps one number a key and forgets it by the
clock (STR-4) or, given `disorder`, by a watermark over arrivals (STR-1), which stands still while a stream is down; the
keys ever stored are kept for good (JOIN-4). No watermark is declared otherwise, so no record is ever dropped for it.
Conflicts are judged within a micro-batch, so their counts depend on how the stream is cut; a batch run is one batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle

from sessionlens.operators import conflict, dedup, late, report, serving, swap, validate
from sessionlens.schemas import CLEAN
from sessionlens.sources.files import decode, delete, materialised
from sessionlens.sources.sinks import clean_projection, to_messages, write_clean
from sessionlens.streaming.commits import CommitLog, Snapshots, at_batch


#: STR-1: seconds by which arrivals may be out of order, where state goes by arrival.
DISORDER = 86_400


class LastAccepted(StatefulProcessor):
    """STR-3: per key the event time of the last accepted record; rows of a batch are taken in event-time order.

    State lives in the state store (STR-5), so restarts keep it. It expires keep_ms of the clock after its last change
    (STR-4). With keep_ms of ttl and the late threshold together that changes nothing in a live stream: a record that comes
    so much later and is on time is more than ttl past the last accepted one.

    by_arrival: it expires keep_ms after the last accepted event time instead, by the watermark over arrivals, so neither an
    outage nor the pace of a replay matters. A change leaves a timer; one that fires after a newer change does nothing.
    """

    def __init__(self, ttl: int, order: str, keep_ms: int, by_arrival: bool = False) -> None:
        self.ttl, self.order, self.keep_ms, self.by_arrival = ttl, order, keep_ms, by_arrival

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", T.StructType([T.StructField("at", T.LongType())]), None if self.by_arrival else self.keep_ms)

    def expiry(self, last: int) -> int:
        """Arrivals from here on that are on time are more than ttl past `last`, a whole second."""
        return (last + 1) * 1000 + self.keep_ms

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.last.exists() and self.expiry(self.last.get()[0]) <= expiredTimerInfo.getExpiryTimeInMs():
            self.last.clear()
        return iter([])

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        last = before = self.last.get()[0] if self.last.exists() else None
        held: pd.DataFrame | None = None
        for pdf in rows:
            untimed = pdf["event_epoch"].isna()
            yield pdf[untimed]
            # Of equal times only the first in order can be accepted, so a key's distinct seconds are held and no more.
            held = pd.concat([x for x in (held, pdf[~untimed]) if x is not None]).sort_values(["event_epoch", self.order]).drop_duplicates("event_epoch")
        keep = []
        for at in held["event_epoch"] if held is not None else []:
            fresh = last is None or at - last > self.ttl
            keep.append(fresh)
            last = int(at) if fresh else last
        if last != before:
            self.last.update((last,))
            if self.by_arrival:
                self.handle.registerTimer(self.expiry(last))
        if keep:
            yield held[keep]

    def close(self) -> None:
        pass


class EverSeen(StatefulProcessor):
    """JOIN-4: rows of a key plus is_duplicate: all but its first ever, in order of event time and arrival. The key stays."""

    def __init__(self, order: str) -> None:
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", T.StructType([T.StructField("yes", T.BooleanType())]))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        known, first = self.seen.exists(), None
        for pdf in rows:
            if not known:  # the first row so far is held back
                pdf = pd.concat([x for x in (first, pdf) if x is not None]).sort_values(["event_timestamp", self.order], na_position="first")
                first, pdf = pdf.iloc[:1], pdf.iloc[1:]
            yield pdf.assign(is_duplicate=True)
        if first is not None:
            self.seen.update((True,))
            yield first.assign(is_duplicate=False)

    def close(self) -> None:
        pass


def dedup_stream(records: DataFrame, ttl: int = dedup.TTL, order: str = "seq", keep_ms: int | None = None, disorder: int | None = None) -> DataFrame:
    """Valid records of a stream without duplicates within ttl; adds event_epoch. keep_ms: see LastAccepted.

    disorder (seconds): state goes by arrival, not by the clock; a replay finds then what a batch run finds, whenever it is
    read. Spark drops rows that arrived longer than this before the latest arrival of earlier batches; the progress log
    counts them as `dropped`, and DISORDER leaves a day for partitions that are read at different speeds. Rows without an
    arrival are never dropped. A checkpoint keeps to the choice it was made with.
    """
    timed = records.withColumn("event_epoch", F.unix_seconds("event_ts"))
    keep_ms = (ttl + late.THRESHOLD) * 1000 if keep_ms is None else keep_ms
    by_arrival = disorder is not None
    processor = LastAccepted(ttl, order, keep_ms, by_arrival)
    rows = timed.withWatermark("ingest_ts", f"{disorder} seconds") if by_arrival else timed
    return rows.groupBy(*dedup.KEY).transformWithStateInPandas(processor, timed.schema, "Append", "EventTime" if by_arrival else "ProcessingTime")


def annotated_stream(raw: DataFrame, dims: validate.Dims) -> DataFrame:
    """Normalised, validated and late-marked records: stateless, with stream-static joins that reread small tables each batch."""
    return late.mark_late(validate.annotate(validate.normalised(raw), dims))


def batch_writer(path: str, sim_history: DataFrame | Snapshots, device_history: DataFrame | Snapshots) -> Callable[[DataFrame, int], None]:
    """STR-7: a foreachBatch function whose sinks appear together, once a batch (see commits). Histories given as Snapshots are
    read as the batch first met them. A sink that fails fails the batch: nothing is swallowed, and the batch is run again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        once = f"{path}/_once/batch={batch_id}"
        batch.write.mode("overwrite").parquet(once)  # the stream's state moves once; what follows reads the batch several times
        marked = materialised(conflict.mark_conflicts(spark.read.schema(batch.schema).parquet(once)), "marked")
        histories = [at_batch(x, "swaps", batch_id) for x in (sim_history, device_history)]
        rows = {"marked": marked, "clean": clean_projection(conflict.clean(marked)), "conflict_log": conflict.conflict_log(marked), "counts": report.batch_counts(marked), "sessions": serving.session_delta(marked)}
        rows["swap_event"] = swaps = swap.swap_events(marked, *histories)
        rows["latest_swaps"] = serving.latest_swaps(swaps)
        sinks = {name: df.write.parquet for name, df in rows.items()}
        sinks["clean_messages"] = to_messages(clean_projection(conflict.clean(marked), "seq")).write.json
        CommitLog(spark, path).write(batch_id, sinks, streamed=["clean_messages"])
        delete(spark, once)
        delete(spark, marked.scratch_path)

    return write


def check_writer(path: str, dims: dict[str, DataFrame | Snapshots], late_after: int = late.THRESHOLD) -> Callable[[DataFrame, int], None]:
    """SRC-10: a foreachBatch function that checks raw records against the reference tables as the batch first met them.

    dims: Dims' tables by name. Sinks: invalid_log, and valid records as files that the next stage streams.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = validate.Dims(**{k: at_batch(x, "checks", batch_id) for k, x in dims.items()})
        annotated = materialised(late.mark_late(validate.annotate(validate.normalised(batch), own), late_after), "annotated")
        valid = validate.valid(annotated).drop("error_code", "error_details", "warn_code")
        sinks = {"invalid_log": validate.invalid_log(annotated, F.col("ingest_ts")).write.parquet, "valid": valid.write.parquet}
        CommitLog(spark, path).write(batch_id, sinks, streamed=["valid"])
        delete(spark, annotated.scratch_path)

    return write


def start_checked(raw: DataFrame, dims: dict[str, DataFrame | Snapshots], path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """The first of two stages with pinned reference tables; start_valid is the second."""
    return raw.writeStream.foreachBatch(check_writer(path, dims)).option("checkpointLocation", f"{checkpoint}/checks").queryName("checks").trigger(**(trigger or {"availableNow": True})).start()


def start_valid(spark: SparkSession, path: str, schema: T.StructType, sim_history: DataFrame | Snapshots, device_history: DataFrame | Snapshots, checkpoint: str, ttl: int = dedup.TTL, trigger: dict | None = None, disorder: int | None = None) -> StreamingQuery:
    """Duplicates, conflicts and swaps of what start_checked let through under path. schema: of its valid records."""
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")  # see session.py
    valid = spark.readStream.schema(schema).parquet(f"{path}/valid").drop("batch")
    return dedup_stream(valid, ttl, disorder=disorder).drop("event_epoch").writeStream.foreachBatch(batch_writer(path + "/chain", sim_history, device_history)).option("checkpointLocation", f"{checkpoint}/chain").queryName("chain").trigger(**(trigger or {"availableNow": True})).start()


def start(raw: DataFrame, dims: validate.Dims, sim_history: DataFrame, device_history: DataFrame, path: str, checkpoint: str, ttl: int = dedup.TTL, trigger: dict | None = None, disorder: int | None = None) -> list[StreamingQuery]:
    """STR-6, STR-9: two queries, one for invalid records and one for the rest; trigger as in DataStreamWriter.trigger.

    raw: the raw columns and seq, as the stream readers give them. The reference tables are read anew each batch (SRC-10);
    start_checked and start_valid pin them. disorder: see dedup_stream.
    """
    trigger = trigger or {"availableNow": True}
    raw.sparkSession.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")  # see session.py
    annotated = annotated_stream(raw, dims)
    bad = validate.invalid_log(annotated, F.col("ingest_ts")).writeStream.format("parquet").option("path", f"{path}/invalid_log")
    good = dedup_stream(validate.valid(annotated), ttl, disorder=disorder).drop("event_epoch").writeStream.foreachBatch(batch_writer(path, sim_history, device_history))
    return [q.option("checkpointLocation", f"{checkpoint}/{n}").trigger(**trigger).start() for n, q in (("invalid", bad), ("valid", good))]


def clean_message_stream(spark: SparkSession, path: str) -> DataFrame:
    """The clean messages that start() writes under path, as a stream of records with seq. A topic of them is decoded alike."""
    messages = spark.readStream.schema("value STRING").json(f"{path}/clean_messages")
    return decode(messages, T.StructType([*CLEAN.fields, T.StructField("seq", T.StringType())]))


def storage_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Stored records by month and the log of long-term duplicates, in a commit log; path is its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, once = batch.sparkSession, f"{path}/_keyed/batch={batch_id}"
        batch.write.mode("overwrite").parquet(once)
        marked = spark.read.schema(batch.schema).parquet(once)
        stored = marked.where(~F.col("is_duplicate")).select(*CLEAN.fieldNames())
        log = dedup.duplicate_log(marked, F.col("ingest_timestamp"))
        CommitLog(spark, path).write(batch_id, {"stored": lambda folder: write_clean(stored, folder), "duplicate_log": log.write.parquet})
        delete(spark, once)

    return write


def start_storage(messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """The second stage: clean records with seq into storage. Messages of a batch that the first stage had to write again
    come twice and count as duplicates, as with any at-least-once topic."""
    schema = T.StructType([*messages.schema.fields, T.StructField("is_duplicate", T.BooleanType())])
    marked = messages.groupBy(*dedup.KEY).transformWithStateInPandas(EverSeen("seq"), schema, "Append", "None")
    return marked.writeStream.foreachBatch(storage_writer(path)).option("checkpointLocation", f"{checkpoint}/storage").trigger(**(trigger or {"availableNow": True})).start()


def progress(query: StreamingQuery) -> dict:
    """STR-12, STR-13: rows a second in and done, batch time, and rows still to read by source where the source knows."""
    last = query.lastProgress
    if not last:
        return {"status": "INACTIVE"}
    lag = [s["metrics"] for s in last["sources"] if s.get("metrics")]
    return {"status": "ACTIVE" if query.isActive else "STOPPED", "input_rows_per_second": last.get("inputRowsPerSecond"), "processed_rows_per_second": last.get("processedRowsPerSecond"), "batch_ms": last["durationMs"].get("triggerExecution"), "lag": lag}


def observed(annotated: DataFrame, name: str = "records") -> tuple[DataFrame, Observation]:
    """Counts of a batch that come with its own run."""
    seen = Observation(name)
    code = F.col("error_code")
    return annotated.observe(seen, F.count(F.lit(1)).alias("total"), F.count_if(code.isNotNull()).alias("invalid"), F.count_if(code == "ERR_LATE_ARRIVAL").alias("late")), seen
