"""Streaming ingest into bronze and streaming upsert into silver
(S03, T01-T04, T06, A13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from candlewick.config import MARKET_TZ, _context
from candlewick.operators.silver import silver_quotes
from candlewick.schemas import QUOTE_SCHEMA
from candlewick.sources.kafka import dead_letters, empty_bronze, offset_gaps, to_bronze
from candlewick.sources.tables import bootstrap_table, materialize, merge_silver, open_store, read_table
from candlewick.streaming.stateful import deliver_once

ENDS_SCHEMA = StructType([StructField("kafka_partition", IntegerType()), StructField("last_offset", LongType()),
                          StructField("batch", LongType())])


def dealt(records: DataFrame) -> DataFrame:
    """The records over all cores: a source's file or Kafka partition may be one
    task's, and decoding it is most of the work."""
    context = _context(records.sparkSession)
    return records.repartition(context.defaultParallelism) if context is not None else records


def start_bronze(records: DataFrame, path: str, checkpoint: str, trigger: str | None = "15 seconds",
                 available_now: bool = False, tz: str = MARKET_TZ, query_name: str = "bronze_quotes",
                 schema: StructType = QUOTE_SCHEMA) -> StreamingQuery:
    """Append decoded quotes to the bronze table, partitioned by ingestion_date.

    A stream restarted with a ``schema`` that has more fields goes on with the same
    checkpoint: the table's recorded schema grows, and rows from before read the
    new columns as NULL.

    The file sink plus the checkpoint give exactly-once appends across
    restarts: a restarted query resumes from the last committed offsets.
    """
    bootstrap_table(empty_bronze(records.sparkSession, tz, schema), path, ["ingestion_date"])
    w = (to_bronze(dealt(records), tz=tz, schema=schema).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).partitionBy("ingestion_date").queryName(query_name))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start(path)


def start_bronze_split(records: DataFrame, path: str, dead_path: str, gaps_path: str, checkpoint: str,
                       trigger: str | None = "15 seconds", available_now: bool = False,
                       tz: str = MARKET_TZ) -> StreamingQuery:
    """Bronze, dead letters and offset gaps from one pass over the records.

    Each micro-batch is read once and written to bronze (by ingestion_date and
    batch), to the dead letters (by batch) and, with where each Kafka partition
    ended, to the gap log (by batch). A batch that is run again after a failure
    replaces its own partitions, so nothing is added twice. A gap between batches
    is found from where the batches before ended.
    """
    spark = records.sparkSession
    ends_path = f"{gaps_path.rstrip('/')}_ends"
    bootstrap_table(empty_bronze(spark, tz).withColumn("batch", F.lit(0).cast("long")), path, ["ingestion_date", "batch"])

    def split(batch: DataFrame, batch_id: int) -> None:
        def put(df: DataFrame, to: str, *cols: str) -> None:
            df.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy(*cols, "batch").parquet(to)

        session = batch.sparkSession
        batch = materialize(dealt(batch), "records")
        before = read_table(session, ends_path, ENDS_SCHEMA).filter(F.col("batch") < batch_id).groupBy(
            "kafka_partition").agg(F.max("last_offset").alias("last_offset"))
        places = batch.select(F.col("partition").cast("int").alias("kafka_partition"),
                              F.col("offset").cast("long").alias("kafka_offset"))
        put(to_bronze(batch, tz=tz), path, "ingestion_date")
        put(dead_letters(batch), dead_path)
        put(offset_gaps(places, before), gaps_path)
        put(places.groupBy("kafka_partition").agg(F.max("kafka_offset").alias("last_offset")), ends_path)

    w = records.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def start_silver_upsert(bronze_stream: DataFrame, silver_path: str, checkpoint: str, tz: str = MARKET_TZ,
                        available_now: bool = False, trigger: str | None = "15 seconds",
                        by_hour: bool = False, deliver_once_within: str | None = None) -> StreamingQuery:
    """Each micro-batch of bronze rows is typed, deduplicated and merged into
    silver with first-wins semantics, so replays and late readings are
    idempotent. ``by_hour`` partitions silver by day and quote hour, so a batch
    rewrites the hours it touches instead of whole days. The merge writes the
    transformed batch once, so each batch is decoded once. With
    ``deliver_once_within`` (e.g. "10 minutes"), events delivered again within that
    time are dropped before the merge."""
    if deliver_once_within:
        bronze_stream = deliver_once(bronze_stream, deliver_once_within)

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        merge_silver(batch.sparkSession, silver_quotes(batch, tz), silver_path, by_hour)

    w = bronze_stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


class ProgressTotals(StreamingQueryListener):
    """Counts rows once per completed micro-batch (not per polling tick).

    Keeps running totals per query and only the most recent ``keep`` batches,
    so a stream that runs for months does not grow driver memory.
    """

    def __init__(self, keep: int = 100) -> None:
        from collections import deque
        self.batches = deque(maxlen=keep)
        self.total_rows: dict[str, int] = {}
        self.total_batches: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        name = p.name or str(p.id)
        self.total_rows[name] = self.total_rows.get(name, 0) + p.numInputRows
        self.total_batches[name] = self.total_batches.get(name, 0) + 1
        self.batches.append({"query": name, "batch_id": p.batchId, "rows": p.numInputRows,
                             "rate": p.processedRowsPerSecond})

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def totals(self, spark: SparkSession) -> DataFrame:
        rows = [(q, self.total_batches[q], n) for q, n in self.total_rows.items()]
        return spark.createDataFrame(rows, "query string, batches long, rows long")


class ProgressLog(ProgressTotals):
    """Also keeps one JSON line per batch in a folder (any store pyarrow.fs
    opens), named by query and batch, so a replayed batch replaces its line and
    nothing depends on how many batches Spark retains."""

    def __init__(self, folder: str, keep: int = 100) -> None:
        super().__init__(keep)
        self.folder = folder
        self.ended: set[str] = set()

    def onQueryProgress(self, event) -> None:  # noqa: N802
        import json
        super().onQueryProgress(event)
        p = event.progress
        store, root = open_store(self.folder)
        store.create_dir(root, recursive=True)
        row = {"query": p.name or str(p.id), "batch_id": p.batchId, "rows": p.numInputRows, "rate": p.processedRowsPerSecond,
               "late": sum(o.numRowsDroppedByWatermark for o in p.stateOperators),
               "state_rows": sum(o.numRowsTotal for o in p.stateOperators)}
        with store.open_output_stream(f"{root}/{p.id}-{p.batchId}.json") as out:
            out.write((json.dumps(row) + "\n").encode())

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended.add(str(event.id))

    def wait(self, query: StreamingQuery, timeout_s: float = 60) -> None:
        """Until all events of a query that has ended were seen."""
        import time
        until = time.monotonic() + timeout_s
        while str(query.id) not in self.ended:
            if time.monotonic() > until:
                raise TimeoutError(f"no end event of stream {query.name}")
            time.sleep(0.1)


PROGRESS_SCHEMA = "query string, batch_id long, rows long, rate double, late long, state_rows long"


def progress_frame(spark: SparkSession, folder: str) -> DataFrame:
    """The logged batches of all runs: query, batch_id, rows, rate, rows that came
    later than the watermark, and rows of state."""
    return spark.read.schema(PROGRESS_SCHEMA).json(folder)


def heartbeat(progress: DataFrame) -> DataFrame:
    """Per batch: its rows, the rows of the query so far, and the mean rate of the
    batches that had rows. One row per batch, so a query's log is a small window."""
    so_far = Window.partitionBy("query").orderBy("batch_id")
    return progress.select("query", "batch_id", "rows", F.sum("rows").over(so_far).alias("rows_so_far"),
                           F.avg(F.when(F.col("rows") > 0, F.col("rate"))).over(so_far).alias("mean_rate"),
                           F.sum("late").over(so_far).alias("late_so_far"), "state_rows")


def await_or_raise(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Block until the query stops; surface its failure."""
    query.awaitTermination(timeout_s)
    if query.exception() is not None:
        raise RuntimeError(f"stream {query.name} failed: {query.exception()}")
