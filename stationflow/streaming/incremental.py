"""Keyed incremental loads and Structured Streaming ingestion.

Plain Parquet has no MERGE, so an upsert rewrites the partitions it touches: the
batch is staged once under the shared checkpoint root, the newest row for each
key of those partitions is staged next, and a marker says that the stage is
whole. Then the touched partitions are replaced (dynamic overwrite, set on the
write). A caller that passes its own stage path can run the same upsert again
after a failure at any point: a whole stage is applied as it is, whatever has
happened to the target meanwhile.

Streams use ``trigger(availableNow=True)``: the checkpoint is the cursor, each
micro-batch writes its own ``batch_id=N`` directory with overwrite, so a
replayed batch rewrites its own output. Rows behind the watermark go to a late
table, never away.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from stationflow.session import scratch_path


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple.

    An aggregate (``max_by`` over a struct), not a ``row_number`` window, so
    copies of one hot key are collapsed map-side before the shuffle instead
    of all landing in one task.
    """
    payload = [c for c in df.columns if c not in key]
    g = df.groupBy(*key).agg(F.max_by(F.struct(*payload), F.struct(*order)).alias("_r"))
    return g.select(*key, *[F.col("_r")[c].alias(c) for c in payload])


def incremental_upsert(target: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Merge ``batch`` into ``target`` by ``key``: batch rows win, newest ``order`` first.

    The key should be the full natural key (duplicate keys inside one batch
    are resolved by ``order``, never kept twice).
    """
    t = target.withColumn("_src", F.lit(0))
    b = batch.withColumn("_src", F.lit(1))
    u = t.unionByName(b, allowMissingColumns=True)
    merged = latest_per_key(u, key, ["_src", *order])
    return merged.drop("_src", *[o for o in order if o not in target.columns])


def _delete(spark: SparkSession, path: str) -> None:
    """Remove a directory through the cluster's file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def upsert_partitions(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    key: Sequence[str],
    partition_col: str,
    order: Sequence[str] = (),
    stage: str | None = None,
) -> None:
    """Upsert ``batch`` into the Parquet table at ``path`` (partitioned by ``partition_col``).

    Only touched partitions are read whole and rewritten: those of the batch
    and, unless the key holds the partition column, those where the target has
    a row of a key of the batch (found from the key columns alone), so a row
    whose key moves leaves its old partition. ``stage`` names the upsert:
    with the same path a failed one is resumed.
    """
    stage = stage or scratch_path(spark, "upsert-stage")
    if _try_read(spark, f"{stage}/ready") is None:
        _stage_upsert(spark, path, batch, key, partition_col, order, stage)
    merged = spark.read.parquet(f"{stage}/merged")
    touched = spark.read.parquet(f"{stage}/touched")
    emptied = touched.join(merged.select(partition_col).distinct(), partition_col, "left_anti")
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path)
    # a partition that lost its last row has nothing to overwrite it
    for r in emptied.toLocalIterator():
        _delete(spark, f"{path}/{partition_col}={r[0]}")


def _stage_upsert(spark, path, batch, key, partition_col, order, stage) -> None:
    columns = list(key) + [c for c in batch.columns if c not in key]
    batch.select(*columns).write.mode("overwrite").parquet(f"{stage}/batch")
    fresh = spark.read.schema(batch.select(*columns).schema).parquet(f"{stage}/batch")
    touched = fresh.select(partition_col).distinct()
    current = _try_read(spark, path)
    if current is None:
        merged = incremental_upsert(fresh.limit(0), fresh, key, order)
    else:
        if partition_col not in key:
            held = current.select(*key, partition_col).join(fresh.select(*key).distinct(), list(key), "left_semi")
            touched = touched.unionByName(held.select(partition_col).distinct()).distinct()
        merged = incremental_upsert(current.join(touched, partition_col, "left_semi"), fresh, key, order)
    touched.write.mode("overwrite").parquet(f"{stage}/touched")
    # ranges of (partition, key): few partitions for each task, and a busy one split over several
    merged.repartitionByRange(partition_col, *key).write.mode("overwrite").parquet(f"{stage}/merged")
    spark.range(1).write.mode("overwrite").parquet(f"{stage}/ready")


def _try_read(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None when nothing has been written there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def schema_sync(target: DataFrame, source: DataFrame) -> DataFrame:
    """Align the target with the source schema: union by name, keep the source's columns.

    Columns new in the source are NULL on old rows; columns the source no
    longer has are dropped.
    """
    return target.unionByName(source, allowMissingColumns=True).select(*source.columns)


# ------------------------------------------------------------------ streams
def _batch_dir(root: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/batch_id={batch_id}"


def _files(spark: SparkSession, in_dir: str, schema, max_files: int | None):
    src = spark.readStream.schema(schema)
    return (src.option("maxFilesPerTrigger", max_files) if max_files else src).parquet(in_dir)


def _watermark(spark: SparkSession, marks_dir: str, batch_id: int, delay_days: int):
    """Greatest event time of earlier batches less the delay (from a table of one row for each batch)."""
    marks = _try_read(spark, marks_dir)
    latest = None if marks is None else marks.filter(F.col("batch_id") < batch_id).agg(F.max("m")).first()[0]
    return None if latest is None else latest - timedelta(days=delay_days)


def time_literal(value, dtype: T.DataType) -> F.Column:
    """A collected time as a column of its own type; a local time stays one in any time zone."""
    if isinstance(dtype, T.TimestampNTZType) and value is not None:
        return F.lit(value.isoformat(sep=" ")).cast(dtype)
    return F.lit(value)


def _split_late(batch: DataFrame, ts: str, mark) -> tuple[DataFrame, DataFrame]:
    if mark is None:
        return batch, batch.limit(0)
    on_time = F.coalesce(F.col(ts) >= time_literal(mark, batch.schema[ts].dataType), F.lit(True))  # a row without a time is never late
    return batch.filter(on_time), batch.filter(~on_time)


def stream_landing(spark: SparkSession, in_dir: str, out_dir: str, ckpt: str, schema, max_files: int | None = None) -> DataFrame:
    """Land every file of ``in_dir`` into ``out_dir`` once (checkpointed cursor)."""
    src = _files(spark, in_dir, schema, max_files)
    q = (
        src.writeStream.format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return spark.read.schema(schema).parquet(out_dir)


def stream_dedup(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    late_dir: str,
    ckpt: str,
    schema,
    key: Sequence[str],
    ts: str,
    delay_days: int = 7,
    max_files: int | None = None,
) -> DataFrame:
    """Deduplicate a stream by key within a watermark; rows behind it go to a late table.

    Built on ``foreachBatch`` so late rows are kept (the built-in stateful
    dedup drops them silently). Per batch: the watermark is the greatest event
    time of earlier batches minus ``delay_days``, from a table of one row for
    each batch beside the output; older rows go to ``late_dir``; the rest are
    deduplicated within the batch and against output rows newer than the
    watermark (a filter that Parquet statistics prune by), then written to
    ``out_dir/batch_id=N``.
    """
    marks_dir = f"{out_dir.rstrip('/')}-marks"

    def process(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        mark = _watermark(s, marks_dir, batch_id, delay_days)
        on_time, late = _split_late(batch, ts, mark)
        fresh = on_time.dropDuplicates(list(key))
        done = _try_read(s, out_dir)
        if done is not None:
            recent = done.filter(F.col("batch_id") < batch_id)
            if mark is not None:
                recent = recent.filter(F.col(ts) >= time_literal(mark, batch.schema[ts].dataType))
            fresh = fresh.join(recent.select(*key), list(key), "left_anti")
        fresh.write.mode("overwrite").parquet(_batch_dir(out_dir, batch_id))
        late.write.mode("overwrite").parquet(_batch_dir(late_dir, batch_id))
        batch.agg(F.max(ts).alias("m")).write.mode("overwrite").parquet(_batch_dir(marks_dir, batch_id))

    src = _files(spark, in_dir, schema, max_files)
    q = src.writeStream.foreachBatch(process).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out_dir).drop("batch_id")


def stream_hourly(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    late_dir: str,
    ckpt: str,
    schema,
    entity: str = "station_complex_id",
    ts: str = "transit_timestamp",
    measure: str = "ridership",
    delay_days: int = 7,
    max_files: int | None = None,
) -> DataFrame:
    """Streaming hub aggregate: ridership per entity x hour of the rows that were on time.

    Each micro-batch writes its own partial sums (one row for each entity and
    hour it holds) to ``out_dir/batch_id=N``; the hub is their sum. Sums are
    additive, so no state is kept between batches and a replay rewrites its
    own partial sums. Rows more than ``delay_days`` behind the greatest event
    time of earlier batches go to ``late_dir`` whole: the hub of these
    (:func:`hourly_sums`) added to the result is the batch hub of all rows.
    """
    marks_dir = f"{out_dir.rstrip('/')}-marks"

    def process(batch: DataFrame, batch_id: int) -> None:
        mark = _watermark(batch.sparkSession, marks_dir, batch_id, delay_days)
        on_time, late = _split_late(batch, ts, mark)
        _partial(on_time, entity, ts, measure).write.mode("overwrite").parquet(_batch_dir(out_dir, batch_id))
        late.write.mode("overwrite").parquet(_batch_dir(late_dir, batch_id))
        batch.agg(F.max(ts).alias("m")).write.mode("overwrite").parquet(_batch_dir(marks_dir, batch_id))

    src = _files(spark, in_dir, schema, max_files).select(entity, ts, measure)
    q = src.writeStream.foreachBatch(process).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    return add_partials(spark.read.parquet(out_dir), entity)


def _partial(rows: DataFrame, entity: str, ts: str, measure: str) -> DataFrame:
    t = F.col(ts)
    return rows.groupBy(F.col(entity), F.to_date(t).alias("transit_date"), F.hour(t).cast("bigint").alias("transit_hour")).agg(
        F.sum(F.col(measure).cast("decimal(18,2)")).cast("decimal(28,2)").alias("_r"), F.count(F.lit(1)).alias("_n")
    )


def add_partials(partials: DataFrame, entity: str = "station_complex_id") -> DataFrame:
    """The hub from partial sums (of :func:`stream_hourly`'s batches, or of late rows)."""
    g = partials.groupBy(entity, "transit_date", "transit_hour").agg(F.sum("_r").alias("_r"), F.sum("_n").alias("_n"))
    return g.select(entity, "transit_date", "transit_hour", F.col("_r").cast("double").alias("hourly_ridership"), F.col("_n").alias("fare_rows"))


def hourly_sums(rows: DataFrame, entity: str = "station_complex_id", ts: str = "transit_timestamp", measure: str = "ridership") -> DataFrame:
    """Hub of plain rows, e.g. those of a late table."""
    return add_partials(_partial(rows, entity, ts, measure), entity)
