"""Streams whose memory is Spark's state store: deduplication and the hourly hub.

Spark drops rows behind the watermark without a word. So a first query splits
them off: it compares each row with the greatest event time of earlier batches
less the delay, writes late rows to a late table and the others to a staging
table. The stateful query reads the staging table, and all that a run has staged
is one of its batches: its own watermark is never ahead of the one that the
split used, so it drops nothing that was on time.

Neither query reads what was written before: the split reads one row for each
earlier batch, the stateful one its state, which holds keys for the delay only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.streaming.incremental import _batch_dir, _files, _split_late, _watermark, time_literal
from stationflow.streaming.versions import VersionedTable

EVENT = "_event_time"
HOUR = 3_600_000_000  # microseconds


def _instant(ts) -> F.Column:
    """A local time as an instant (its clock read as UTC): watermarks take instants only, and no time zone shall move hours."""
    seconds = F.extract(F.lit("SECOND"), ts) * 1_000_000
    return F.timestamp_micros(F.unix_date(F.to_date(ts)) * F.lit(24 * HOUR) + F.hour(ts) * F.lit(HOUR) + F.minute(ts).cast("bigint") * F.lit(HOUR // 60) + seconds.cast("bigint"))


def _delay(days: int) -> str:
    """The stateful queries' delay: Spark drops a row that is exactly at the watermark, the split keeps it."""
    return f"{days} days 1 second"


def split_late(
    spark: SparkSession, in_dir: str, staged_dir: str, late_dir: str, ckpt: str, schema: T.StructType, ts: str, delay_days: int, max_files: int | None = None
) -> None:
    """Write the new files' rows that are on time to ``staged_dir`` and the others to ``late_dir``, a folder for each batch.

    A row without a time is on time and gets the batch's greatest time as its
    event time. A batch that is run again overwrites its own folders.
    """
    marks_dir = f"{staged_dir.rstrip('/')}-marks"

    def process(batch: DataFrame, batch_id: int) -> None:
        mark = _watermark(batch.sparkSession, marks_dir, batch_id, delay_days)
        on_time, late = _split_late(batch, ts, mark)
        latest = batch.agg(F.max(ts).alias("m"))
        latest.write.mode("overwrite").parquet(_batch_dir(marks_dir, batch_id))
        newest = latest.first()[0]
        on_time.withColumn(EVENT, _instant(F.coalesce(F.col(ts), time_literal(newest, schema[ts].dataType)))).write.mode("overwrite").parquet(_batch_dir(staged_dir, batch_id))
        late.write.mode("overwrite").parquet(_batch_dir(late_dir, batch_id))

    q = _files(spark, in_dir, schema, max_files).writeStream.foreachBatch(process).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()


def _staged(spark: SparkSession, staged_dir: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(EVENT, T.TimestampType())])
    return spark.readStream.schema(full).option("recursiveFileLookup", True).parquet(staged_dir)


def stream_dedup_stateful(
    spark: SparkSession, in_dir: str, out_dir: str, late_dir: str, ckpt: str, schema: T.StructType, key: Sequence[str], ts: str,
    delay_days: int = 7, max_files: int | None = None,
) -> DataFrame:
    """The first row of each key, keys being remembered for ``delay_days`` of event time; late rows go to ``late_dir``.

    The keys are in Spark's state store (``dropDuplicatesWithinWatermark``): a
    batch reads neither the output nor earlier input.
    """
    staged = f"{out_dir.rstrip('/')}-staged"
    split_late(spark, in_dir, staged, late_dir, f"{ckpt}/split", schema, ts, delay_days, max_files)
    fresh = _staged(spark, staged, schema).withWatermark(EVENT, _delay(delay_days)).dropDuplicatesWithinWatermark(list(key))
    q = fresh.drop(EVENT).writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", f"{ckpt}/dedup").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(schema).parquet(out_dir)


def stream_hourly_state(
    spark: SparkSession, in_dir: str, out_dir: str, late_dir: str, ckpt: str, schema: T.StructType, entity: str = "station_complex_id",
    ts: str = "transit_timestamp", measure: str = "ridership", delay_days: int = 7, max_files: int | None = None,
) -> DataFrame:
    """The hourly hub as a streaming aggregate: ridership for each entity and hour of the rows that were on time.

    Open hours are in the state store, and a batch hands on only those that it
    changed (update mode). The sink is a versioned table by date: changed hours
    replace their former values, dates that they touch are rewritten (so a
    closed day is one compact folder), and each version notes its batch, so a
    batch that is run again is left out. Two versions are kept: the number of
    files follows the dates, not the batches.
    """
    staged = f"{out_dir.rstrip('/')}-staged"
    split_late(spark, in_dir, staged, late_dir, f"{ckpt}/split", schema, ts, delay_days, max_files)
    hours = _staged(spark, staged, schema).filter(F.col(ts).isNotNull()).withWatermark(EVENT, _delay(delay_days))
    hours = hours.groupBy(F.window(EVENT, "1 hour").alias("w"), F.col(entity)).agg(
        F.sum(F.col(measure).cast("decimal(18,2)")).cast("decimal(28,2)").alias("_r"), F.count(F.lit(1)).alias("fare_rows")
    )
    hour = F.floor(F.unix_micros("w.start") / HOUR)
    hours = hours.select(
        entity, F.date_from_unix_date(F.floor(hour / 24).cast("int")).alias("transit_date"), F.pmod(hour, F.lit(24)).alias("transit_hour"), F.col("_r").cast("double").alias("hourly_ridership"), "fare_rows"
    )
    sink = VersionedTable(spark, out_dir, "transit_date")

    def process(batch: DataFrame, batch_id: int) -> None:
        if sink.meta().get("batch", -1) < batch_id and not batch.isEmpty():
            sink.upsert(batch, [entity, "transit_date", "transit_hour"], meta={"batch": batch_id})
            sink.vacuum(keep=2)

    q = hours.writeStream.outputMode("update").foreachBatch(process).option("checkpointLocation", f"{ckpt}/hourly").trigger(availableNow=True).start()
    q.awaitTermination()
    return sink.read()
