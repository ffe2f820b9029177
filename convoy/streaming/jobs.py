"""Structured Streaming jobs for the three handlers.

Sources are ``readStream`` DataFrames (a parquet file source here; a message
bus in production). Sinks:

* delivery verification: responses appended by the file sink (its commit log
  makes replays exactly-once);
* ETA: ``foreachBatch`` writing the micro-batch to
  ``vehicle_tracking/batch_id=<id>`` with overwrite, so a replayed batch id
  replaces its own output; readers take the newest row per
  ``(vehicle_id, ts)`` with :func:`read_keyed`;
* route deviation: ``foreachBatch`` with two sinks keyed by batch id - the
  alert history table and the JSON message outbox.

Retried pings are made harmless by the keys, not by dropping input: the
alert and tracking tables are keyed by ``(vehicle_id, ts)`` and read with
:func:`read_keyed` (newest write per key), which is the keyed-put semantics
of the source. ``dedupe_delay`` opts into ``dropDuplicatesWithinWatermark``
as well; note that a watermark also drops events that arrive later than the
delay, so it is off by default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from convoy.operators.merge import latest_per_key
from convoy.sources.schemas import STATUS
from convoy.sources.sinks import list_names, path_exists
from convoy.streaming import handlers as H
from convoy.streaming.keyed_table import KeyedTable

DEFAULT_WATERMARK = "10 minutes"


def _trigger(writer, trigger: str | None):
    """``None``: Spark's default (next micro-batch as soon as the previous one
    ends, for per-event handlers); ``"availableNow"``: process what is there
    and stop (backfills, tests); otherwise a processing-time interval."""
    if trigger is None:
        return writer
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def dedupe_pings(pings: DataFrame, delay: str = DEFAULT_WATERMARK) -> DataFrame:
    """Drop re-deliveries of the same (vehicle, ts) ping within the delay.
    Watermarks need a zoned timestamp: the zone-less ``ts`` is read in the
    session time zone (UTC) as the event time."""
    return (pings.withColumn("event_time", F.col("ts").cast("timestamp"))
            .withWatermark("event_time", delay)
            .dropDuplicatesWithinWatermark(["vehicle_id", "ts"])
            .drop("event_time"))


def delivery_verification(marks: DataFrame, status: DataFrame, out: str, checkpoint: str,
                          trigger: str | None = None) -> StreamingQuery:
    responses = H.verify_deliveries(marks, status)
    w = (responses.writeStream.format("parquet").outputMode("append")
         .option("path", out).option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def _maybe_dedupe(pings: DataFrame, delay: str | None) -> DataFrame:
    return dedupe_pings(pings, delay) if delay else pings


def vehicle_tracking(pings: DataFrame, out: str, checkpoint: str,
                     trigger: str | None = "5 minutes", dedupe_delay: str | None = None,
                     latest_only: bool = True) -> StreamingQuery:
    """Every 5 minutes, the ETA of each vehicle from its newest position in
    the interval (``latest_only=False``: an ETA for every ping)."""
    def each(batch: DataFrame, batch_id: int) -> None:
        # only valid events are stored, as the source does
        etas = H.vehicle_eta(batch).where("status_code = 200")
        if latest_only:
            etas = latest_per_key(etas.withColumn("_o", F.struct("ts", "event_id")),
                                  ["vehicle_id"], "_o").drop("_o")
        _write_batch(etas, out, batch_id)
    w = (_maybe_dedupe(pings, dedupe_delay).writeStream.foreachBatch(each)
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def route_deviation_alerts(pings: DataFrame, waypoints: DataFrame, alerts_out: str,
                           messages_out: str, checkpoint: str,
                           trigger: str | None = None, dedupe_delay: str | None = None
                           ) -> StreamingQuery:
    def each(batch: DataFrame, batch_id: int) -> None:
        # a file often is one row group, so one task: the search is dealt to all of them
        spread = batch.repartition("event_id")
        alerts = H.deviation_alerts(H.route_deviation(spread, waypoints), "event_id").persist()
        try:
            # the event id says which of two writes of one key in a batch is the later
            _write_batch(alerts, alerts_out, batch_id)
            _write_batch(H.alert_messages(alerts), messages_out, batch_id)
        finally:
            alerts.unpersist()
    w = (_maybe_dedupe(pings, dedupe_delay).writeStream.foreachBatch(each)
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def read_keyed(spark: SparkSession, path: str, keys: list[str], order: tuple[str, ...] = ("batch_id", "event_id")
               ) -> DataFrame:
    """Keyed table written by the batch sinks: the newest write of a key wins, by
    micro-batch and then by event id (whichever of the two are stored)."""
    df = spark.read.parquet(path)
    have = [c for c in order if c in df.columns]
    return latest_per_key(df.withColumn("_order", F.struct(*have)), keys, "_order").drop("_order", "batch_id")


# Keyed tables ---------------------------------------------------------------
def _put(table: KeyedTable, rows: DataFrame, batch_id: int, every: int) -> None:
    table.put(rows, batch_id)
    if (batch_id + 1) % every == 0:
        table.compact()
        table.retire()


def tracking_table(pings: DataFrame, table: KeyedTable, checkpoint: str, trigger: str | None = "5 minutes",
                   compact_every: int = 10) -> StreamingQuery:
    """The ETA of every valid ping, put into a compacted table keyed by vehicle and time."""
    def each(batch: DataFrame, batch_id: int) -> None:
        _put(table, H.vehicle_eta(batch).where("status_code = 200"), batch_id, compact_every)

    return _trigger(pings.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint), trigger).start()


def newest_positions(pings: DataFrame, table: KeyedTable, checkpoint: str, trigger: str | None = "5 minutes",
                     compact_every: int = 10) -> StreamingQuery:
    """The newest ping of each vehicle over all micro-batches. ``table`` is keyed by
    vehicle and ordered by event time and id, so that a late ping never sets a
    vehicle back and a repeated micro-batch changes nothing."""
    def each(batch: DataFrame, batch_id: int) -> None:
        newest = latest_per_key(batch.withColumn("_o", F.struct("ts", "event_id")), ["vehicle_id"], "_o").drop("_o")
        _put(table, newest, batch_id, compact_every)

    return _trigger(pings.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint), trigger).start()


def keyed_verification(marks: DataFrame, status: KeyedTable, out: str, checkpoint: str,
                       trigger: str | None = None) -> StreamingQuery:
    """Delivery verification against a keyed status table. Each micro-batch reads the buckets
    of its own ids as they are at that moment, so a status that has changed shows
    and the rest of the table is never opened."""
    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            buckets = status.buckets_of(batch)
            known = status.read(buckets) if buckets else None
            if known is None:
                known = batch.sparkSession.createDataFrame([], STATUS)
            _write_batch(H.verify_deliveries(batch, known), out, batch_id)
        finally:
            batch.unpersist()

    return _trigger(marks.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint), trigger).start()


# Messages -------------------------------------------------------------------
def publish_messages(spark: SparkSession, outbox: str, published: str, send=None) -> int:
    """Publish what the message outbox holds, each message once; the number published.

    ``published/ledger/batch_id=<n>`` marks a micro-batch as published and is written after its
    messages. A message's id is its micro-batch and event, and messages go to a
    folder of their micro-batch, so what a crash has left between the messages
    and the mark is written over, not added. ``send`` (messages, micro-batch) takes
    the place of that folder for a transport that drops repeated ids.
    """
    def ids(path: str) -> set[int]:
        return {int(n.split("=")[1]) for n in list_names(spark, path) if path_exists(spark, f"{path}/{n}/_SUCCESS")}

    total = 0
    for i in sorted(ids(outbox) - ids(f"{published}/ledger")):
        rows = spark.read.parquet(f"{outbox}/batch_id={i}").withColumn("message_id", F.concat(F.lit(f"{i}-"), "event_id"))
        (send or (lambda m, b: _write_batch(m, f"{published}/messages", b)))(rows.select("message_id", "key", "value"), i)
        n = rows.count()
        spark.range(1).select(F.lit(n).alias("messages")).coalesce(1).write.mode("overwrite").json(f"{published}/ledger/batch_id={i}")
        total += n
    return total
