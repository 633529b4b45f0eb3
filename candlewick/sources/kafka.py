"""Quote stream source, bronze decoding and event publishing.

``to_bronze`` is the one transform shared by the streaming job, batch
back-fills and the empty-table bootstrap, so all three agree on the schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from candlewick.config import MARKET_TZ, as_of_col
from candlewick.functions.timeutil import market_date, parse_utc, to_utc_ntz
from candlewick.schemas import KAFKA_SHAPE, QUOTE_SCHEMA


def quote_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                 topic: str = "quotes.raw", bootstrap: str | None = None, **options) -> DataFrame:
    """Streaming DataFrame with the Kafka record shape (value, partition, offset, timestamp).

    ``fmt="kafka"`` subscribes to ``topic`` from the earliest offsets and keeps
    going when retention already dropped data. Any file format (``json``,
    ``parquet``) with the same four columns is accepted as a stand-in, which is
    how the tests drive the job without a broker.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        if not bootstrap:
            raise ValueError("bootstrap servers must be given for a Kafka source")
        reader = (reader.option("kafka.bootstrap.servers", bootstrap)
                  .option("subscribe", topic)
                  .option("startingOffsets", "earliest")
                  .option("failOnDataLoss", "false"))
    else:
        reader = reader.schema(KAFKA_SHAPE)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path) if path is not None else reader.load()


def to_bronze(records: DataFrame, as_of=None, tz: str = MARKET_TZ, schema: StructType = QUOTE_SCHEMA) -> DataFrame:
    """Kafka-shaped records -> typed bronze rows (21 columns, or those of another
    event ``schema``, as an older or newer producer writes it).

    Malformed JSON, top-level arrays and records without a ticker are dropped;
    a wrong-typed field becomes NULL while the others survive; unparsable
    timestamps become NULL. ``ingestion_date`` is the market-local date of
    ``ingestion_ts`` and is the partition column of the bronze table.
    """
    parsed = F.from_json(F.col("value").cast("string"), schema)
    # One array element per decodable record, none otherwise: the generator
    # drops bad records itself and keeps later predicates from being pushed
    # below it, which would repeat the parser once per predicate.
    usable = F.filter(F.array(parsed), lambda q: q["ticker"].isNotNull())
    event = records.select(
        F.explode(usable).alias("q"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("long").alias("kafka_offset"),
        to_utc_ntz("timestamp", records.schema["timestamp"].dataType).alias("kafka_ts"))
    times = {"quote_ts", "ingestion_ts"}
    fields = [parse_utc(F.col(f"q.{n}")).alias(n) if n in times else F.col(f"q.{n}") for n in schema.names]
    return event.select(*fields, "kafka_partition", "kafka_offset", "kafka_ts", as_of_col(as_of).alias("processing_ts"),
                        market_date(parse_utc(F.col("q.ingestion_ts")), tz).alias("ingestion_date"))


def empty_bronze(spark: SparkSession, tz: str = MARKET_TZ, schema: StructType = QUOTE_SCHEMA) -> DataFrame:
    """Zero-row bronze frame with exactly the streaming schema."""
    return to_bronze(spark.createDataFrame([], KAFKA_SHAPE), tz=tz, schema=schema)


def encode_events(df: DataFrame, key: str = "ticker") -> DataFrame:
    """Rows -> (key, value) for a Kafka sink: key = ticker, value = JSON of the row."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def dead_letters(records: DataFrame) -> DataFrame:
    """The records that :func:`to_bronze` drops, as they came, with a reason:
    ``empty`` (no value), ``malformed`` (no JSON object) or ``no ticker``. Together
    with bronze they are the whole input."""
    corrupt = "__corrupt"
    schema = StructType([*QUOTE_SCHEMA.fields, StructField(corrupt, StringType())])
    text = F.col("value").cast("string")
    q = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    reason = F.when(F.length(F.trim(F.coalesce(text, F.lit("")))) == 0, "empty").when(
        q[corrupt].isNotNull(), "malformed").otherwise("no ticker")
    # As in to_bronze, a generator keeps the parser from being repeated below it.
    lost = F.filter(F.array(F.struct(q["ticker"].alias("ticker"), reason.alias("reason"))),
                    lambda x: x["ticker"].isNull())
    return records.select(
        text.alias("value"), F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("long").alias("kafka_offset"),
        to_utc_ntz("timestamp", records.schema["timestamp"].dataType).alias("kafka_ts"), F.explode(lost).alias("x")
    ).select("value", "kafka_partition", "kafka_offset", "kafka_ts", "x.reason")


GAP_BLOCK = 1 << 16


def offset_gaps(bronze: DataFrame, last: DataFrame | None = None, block: int = GAP_BLOCK) -> DataFrame:
    """Holes in the offsets of each partition: kafka_partition, gap_start, gap_end
    (inclusive), missing. ``last`` (kafka_partition, last_offset) holds where an
    earlier batch ended, so that a hole between batches shows as well.

    Offsets are cut into blocks. A block whose distinct offsets fill it has no hole
    inside, and only the others are sorted; the blocks' ends are compared in order.
    So a topic's few partitions do not limit the number of tasks. Rows that repeat
    an offset change nothing; rows without one are not looked at.
    """
    seen = bronze.select("kafka_partition", "kafka_offset").where(
        "kafka_partition IS NOT NULL AND kafka_offset IS NOT NULL").distinct()
    if last is not None:
        seen = seen.join(last.select("kafka_partition", "last_offset"), "kafka_partition", "left").where(
            "last_offset IS NULL OR kafka_offset > last_offset").drop("last_offset")
    seen = seen.withColumn("block", F.floor(F.col("kafka_offset") / block))
    ends = seen.groupBy("kafka_partition", "block").agg(
        F.min("kafka_offset").alias("first"), F.max("kafka_offset").alias("final"), F.count(F.lit(1)).alias("n"))
    holed = ends.where("n < final - first + 1").select("kafka_partition", "block")
    inside = Window.partitionBy("kafka_partition", "block").orderBy("kafka_offset")
    within = seen.join(holed, ["kafka_partition", "block"], "left_semi").withColumn(
        "next", F.lead("kafka_offset").over(inside)).select("kafka_partition", F.col("kafka_offset").alias("before"), "next")
    edges = ends.select("kafka_partition", F.col("first"), F.col("final"))
    if last is not None:
        edges = edges.unionByName(last.select("kafka_partition", F.col("last_offset").alias("first"),
                                              F.col("last_offset").alias("final")))
    across = edges.withColumn("next", F.lead("first").over(Window.partitionBy("kafka_partition").orderBy("first"))).select(
        "kafka_partition", F.col("final").alias("before"), "next")
    return within.unionByName(across).where("next > before + 1").select(
        "kafka_partition", (F.col("before") + 1).alias("gap_start"), (F.col("next") - 1).alias("gap_end"),
        (F.col("next") - F.col("before") - 1).alias("missing"))


def repeated_offsets(bronze: DataFrame) -> DataFrame:
    """Offsets delivered more than once and how often."""
    return bronze.groupBy("kafka_partition", "kafka_offset").agg(F.count(F.lit(1)).alias("copies")).where(
        "copies > 1 AND kafka_offset IS NOT NULL")
