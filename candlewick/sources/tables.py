"""Table storage on Parquet.

No transactional table format is assumed. The keyed upsert therefore uses
dynamic partition overwrite: only partitions the source touches are read,
merged and rewritten. Writers must run one at a time (no optimistic
concurrency on plain Parquet), and a rewrite is not atomic for concurrent
readers of the same partition.

A table's schema is kept beside it (``<path>.schema``), so reading it back opens
no file's footer: files that lack a column read it as NULL, files of a narrower
type read as the wider one. Tables written by others have no such record; their
footers are merged until a merge or compaction of this module records it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyarrow import fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from candlewick.functions.widening import widen
from candlewick.operators.silver import merge_frames
from candlewick.schemas import DIM_SCHEMA


MAX_TOUCHED = 1000
COMPACT_BYTES = 128 * 1024 * 1024

# The error conditions of a path that does not exist or holds no data files.
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder for the driver's own small reads and writes."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri)


def is_absent(e: AnalysisException) -> bool:
    """Does the error say that there is no table yet (and nothing else)?"""
    return e.getCondition() in _ABSENT


def schema_of(spark: SparkSession, path: str) -> StructType | None:
    """The recorded schema of the table at ``path`` (None: not recorded)."""
    try:
        line = spark.read.text(f"{path.rstrip('/')}.schema", wholetext=True).first()
    except AnalysisException as e:
        if is_absent(e):
            return None
        raise
    return StructType.fromJson(json.loads(line[0])) if line else None


def record_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    """Keep the schema beside the table; nothing is written when it is known."""
    wide = StructType([StructField(f.name, f.dataType, True) for f in schema])
    if schema_of(spark, path) != wide:
        spark.createDataFrame([(wide.json(),)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{path.rstrip('/')}.schema")


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path`` with the columns of all its files, or None while
    there is none. An unreadable table raises."""
    schema = schema_of(spark, path)
    try:
        reader = spark.read.option("mergeSchema", True) if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as e:
        if is_absent(e):
            return None
        raise


def bootstrap_table(empty: DataFrame, path: str, partition_by: Sequence[str] = (), table: str | None = None) -> None:
    """Create the table with exactly ``empty``'s schema if it does not exist (idempotent).

    Plain Parquet cannot record the schema of an empty *partitioned* table in
    its files, so it is kept beside them; ``table`` (``db.name``) also registers
    it in the catalog with explicit columns and partitioning. If the table exists
    with fewer or narrower columns, its recorded schema grows (rows so far read
    the new columns as NULL).
    """
    known = schema_of(empty.sparkSession, path)
    record_schema(empty.sparkSession, path, empty.schema if known is None else widen(known, empty.schema))
    w = empty.write.mode("ignore")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    if table:
        spark = empty.sparkSession
        db = table.split(".")[0] if "." in table else None
        if db:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in empty.schema)
        part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet{part} LOCATION '{path}'")


def register(spark: SparkSession, db: str, table: str, path: str, fmt: str = "parquet") -> None:
    """Expose a path as an external catalog table (idempotent)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{db}`.`{table}` USING {fmt} LOCATION '{path}'")
    try:
        spark.sql(f"ALTER TABLE `{db}`.`{table}` RECOVER PARTITIONS")
    except AnalysisException:
        pass  # not partitioned


def load_dim(spark: SparkSession, csv_path: str, schema: StructType = DIM_SCHEMA) -> DataFrame:
    """Header CSV with declared (string) column types."""
    return spark.read.schema(schema).option("header", True).csv(csv_path)


def write_seed(df: DataFrame, path: str) -> None:
    """A seed replaces its table; appending would duplicate dimension rows."""
    df.write.mode("overwrite").parquet(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet",
                watch: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Full-refresh materialisation. ``watch`` is applied to the rows in the stage
    that writes them (see :class:`~candlewick.plans.checks.Watch`).

    Partitioned writes are rebalanced on the partition columns first: AQE
    splits a hot partition value into several files and merges small ones,
    so one huge day does not end up as one task and one file. The whole table
    is replaced whatever the session's overwrite mode: no partition survives.
    """
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    w = (watch(rows) if watch else rows).write.mode("overwrite").format(fmt)
    w = w.option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "parquet":
        record_schema(df.sparkSession, path, df.schema)
    w.save(path)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None,
               columns: Sequence[str] | None = None, since=None, partition_col: str = "ingestion_date") -> DataFrame:
    """Partition- and column-pruned read; a missing or still empty table reads as empty."""
    try:
        known = schema if schema is not None else schema_of(spark, path)
        reader = spark.read.schema(known) if known is not None else spark.read.option("mergeSchema", True)
        df = reader.parquet(path)
    except AnalysisException as e:
        if schema is None or not is_absent(e):
            raise
        df = spark.createDataFrame([], schema)
    if since is not None:
        df = df.filter(F.col(partition_col) >= (since if isinstance(since, Column) else F.lit(since)))
    return df.select(*columns) if columns else df


def touched_part(target: DataFrame, source: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The rows of ``target`` in the partitions that ``source`` (materialised)
    holds rows of. A few partitions become literal predicates, which prune the
    scan before it starts; a back-fill of more than ``MAX_TOUCHED`` leaves the
    choice to a join."""
    values = source.select(*cols).distinct().limit(MAX_TOUCHED + 1).collect()
    if not values:
        return target.limit(0)
    if len(values) > MAX_TOUCHED:
        on = reduce(Column.__and__, (target[c].eqNullSafe(F.col(f"__{c}")) for c in cols))
        return target.join(source.select(*(F.col(c).alias(f"__{c}") for c in cols)).distinct(), on, "left_semi")
    return target.filter(any_of([reduce(Column.__and__, (F.col(c).eqNullSafe(F.lit(v[c])) for c in cols))
                                 for v in values]))


def any_of(terms: list[Column]) -> Column:
    """A balanced OR: as deep as the logarithm of its length."""
    half = len(terms) // 2
    return terms[0] if not half else any_of(terms[:half]) | any_of(terms[half:])


def merge_into(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str] = ("ticker", "quote_ts"),
               partition_col: str | Sequence[str] = "trading_date", order: Sequence[Column] | None = None,
               on_match: str = "first", watch: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Keyed upsert of ``source`` into the partitioned table at ``path``.

    Partition columns must be functions of the key (trading_date, or
    trading_date plus the quote hour, of quote_ts), so a key never moves
    between partitions. The source is written once to the shared scratch
    folder; only the partitions it touches are read from the target, and
    exactly those are rewritten. A column that one side lacks, or holds in a
    narrower type, is evolved (see :func:`~candlewick.operators.silver.align`).
    ``watch`` is applied to all rows of the rewritten partitions.
    """
    cols = [partition_col] if isinstance(partition_col, str) else list(partition_col)
    target = stored(spark, path)
    if target is None:
        write_table(source, path, cols, watch=watch)
        return
    source = materialize(source, "merge_source")
    schema = widen(target.schema, source.schema)
    merged = merge_frames(touched_part(target, source, cols), source, keys, order, on_match)
    # The wider schema first: it reads the files of before and after alike.
    record_schema(spark, path, schema)
    rows = merged.hint("rebalance", *cols)
    ((watch(rows) if watch else rows).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path))


def merge_silver(spark: SparkSession, source: DataFrame, path: str, by_hour: bool = False,
                 watch: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Upsert silver rows, partitioned by day or by day and quote hour."""
    if by_hour:
        merge_into(spark, source.withColumn("quote_hour", F.hour("quote_ts")), path,
                   partition_col=["trading_date", "quote_hour"], watch=watch)
    else:
        merge_into(spark, source, path, watch=watch)


def file_sizes(spark: SparkSession, path: str, cols: Sequence[str] = ()) -> DataFrame:
    """One row per data file: its partition values, ``file`` and ``size``. Taken
    from the listing; no file is opened."""
    listed = spark.read.format("binaryFile").load(path)
    names = {c.lower(): c for c in listed.columns}
    return listed.select(*(F.col(names[c.lower()]).alias(c) for c in cols), F.col("_metadata.file_path").alias("file"),
                         F.col("_metadata.file_size").alias("size")).filter(F.col("file").endswith(".parquet"))


def plan_compaction(files: DataFrame, cols: Sequence[str], target_bytes: int) -> DataFrame:
    """The files of the partitions worth rewriting, and the bin each goes to.

    Files under half of ``target_bytes`` are small. A partition's small files are
    packed in order of size into bins of about ``target_bytes``; larger files are
    a bin each. A partition is rewritten only if that leaves fewer files.
    """
    own = Window.partitionBy(*cols, "small")
    before = F.sum("size").over(own.orderBy("size", "file").rowsBetween(Window.unboundedPreceding, -1))
    packed = files.withColumn("small", F.col("size") * 2 < target_bytes)
    packed = packed.withColumn("bin", F.when(F.col("small"), F.floor(F.coalesce(before, F.lit(0)) / target_bytes)).otherwise(
        -F.row_number().over(own.orderBy("size", "file"))).cast("long"))
    gain = F.when(F.col("small"), F.count(F.lit(1)).over(own) - F.max("bin").over(own) - 1).otherwise(0)
    packed = packed.withColumn("gain", gain)
    best = F.max("gain").over(Window.partitionBy(*cols)) if cols else F.max("gain").over(Window.partitionBy(F.lit(0)))
    return packed.withColumn("gain", best).filter("gain > 0").drop("small", "gain")


def compact(spark: SparkSession, path: str, partition_col: str | Sequence[str] | None = None,
            target_bytes: int = COMPACT_BYTES) -> int:
    """Rewrite the partitions of a table that hold many small files into fewer
    files of about ``target_bytes``, without changing rows or columns; returns the
    number of files rewritten. Other partitions keep their files, and a second
    run has nothing to do.

    New files are written in full beside the old ones before a partition is
    swapped. A directory written by the streaming file sink is refused: its
    readers trust the sink's ``_spark_metadata`` log, which an in-place rewrite
    would leave pointing at deleted files. Use :func:`compact_closed` there.
    """
    if _is_stream_sink_output(path):
        raise ValueError(f"{path} is a streaming file-sink output; use compact_closed")
    cols = [partition_col] if isinstance(partition_col, str) else list(partition_col or ())
    plan = materialize(plan_compaction(file_sizes(spark, path, cols), cols, target_bytes), "compaction_plan")
    n = plan.count()
    if not n:
        return 0
    table = stored(spark, path)
    place = [*cols, "bin"]
    bins = plan.select(*place).distinct()   # one row per file to write
    numbered = bins.select(*(F.col(c).alias(f"__{c}") for c in place),
                           (F.row_number().over(Window.orderBy(*place)) - 1).cast("int").alias("__to"))
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in place))
    into = plan.join(numbered, same).select(F.col("file").alias("__file"), "__to")
    rows = table.withColumn("__file", F.col("_metadata.file_path"))
    rows = (touched_part(rows, plan, cols) if cols else rows).join(into, "__file")
    out = rows.repartitionById(bins.count(), F.col("__to")).select(*table.columns)
    record_schema(spark, path, table.schema)
    if cols:
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)
    else:   # every file is read and replaced: write a whole copy first
        staged = materialize(out, "compacted")
        staged.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return n


def compact_all(spark: SparkSession, tables: Mapping[str, str | Sequence[str] | None]) -> dict[str, int]:
    """Compact a list of tables: path -> partition column(s) (None: not
    partitioned). Returns the files rewritten per path."""
    return {path: compact(spark, path, cols) for path, cols in tables.items()}


def compact_closed(spark: SparkSession, path: str, into: str, partition_col: str, before) -> None:
    """Compact the closed partitions (value < ``before``) of a streamed table
    into the table ``into``. The stream's own files and log stay untouched, so
    it can go on and restart; batch readers use :func:`read_compacted`.
    Running it again replaces the same partitions with the same rows."""
    closed = read_table(spark, path).filter(F.col(partition_col) < F.lit(before))
    (closed.hint("rebalance", partition_col).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(into))


def read_compacted(spark: SparkSession, path: str, into: str, partition_col: str, before) -> DataFrame:
    """A streamed table with its closed partitions from their compacted copy."""
    still_open = read_table(spark, path).filter(
        (F.col(partition_col) >= F.lit(before)) | F.col(partition_col).isNull())
    done = stored(spark, into)
    return still_open if done is None else still_open.unionByName(
        done.filter(F.col(partition_col) < F.lit(before)), allowMissingColumns=True)


def _is_stream_sink_output(path: str) -> bool:
    """Does ``path`` hold a streaming file sink's ``_spark_metadata`` log?"""
    store, root = open_store(path)
    return store.get_file_info(f"{root.rstrip('/')}/_spark_metadata").type != pafs.FileType.NotFound


def show_query(spark: SparkSession, sql: str, max_rows: int = 50) -> tuple[DataFrame, DataFrame]:
    """Ad-hoc SQL: the first ``max_rows`` rows, and the total row count as a
    one-row frame that costs nothing until it is read."""
    df = spark.sql(sql)
    return df.limit(max_rows), df.agg(F.count(F.lit(1)).alias("total_rows"))


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Cuts the lineage (lost executors never force a recompute past this
    point) and lets several consumers scan only the columns they need
    instead of each re-deriving the frame.
    """
    from candlewick.config import scratch_path
    path = scratch_path(df.sparkSession, name)
    w = (df.hint("rebalance", *partition_by) if partition_by else df).write
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
