"""Parameters, session helpers and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# These must equal the original pipeline's parameters, status
# words and display conventions for results to match.
MARKET_TZ = "America/Sao_Paulo"
GOLD_LOOKBACK_DAYS = 5
MAX_FEED_STALENESS_MINUTES = 20
FRESHNESS_WARN_MINUTES = 5
FRESHNESS_ERROR_MINUTES = 20
PRICE_MIN = 0.01
PRICE_MAX = 5000.0
CHANGE_PCT_LIMIT = 30.0
VOLUME_MAX = 100_000_000_000
REPROCESS_MINUTES = 10
FUTURE_TOLERANCE_MINUTES = 5
ACCEPTED_SOURCES = ("brapi", "simulated")
MARKET_OPEN = "10:00:00"
MARKET_CLOSE = "18:00:00"
DEFAULT_CURRENCY = "BRL"
RUN_OK = "ok"
RUN_FAILED = "falha"
STALE_OK_BELOW_SECONDS = 90
STALE_WARN_BELOW_SECONDS = 20 * 60
DIRECTION_DEAD_BAND = 1e-9
NULL_TEXT = "--"
CURRENCY_PREFIX = "R$ "


def as_of_col(as_of: str | Column | None) -> Column:
    """The evaluation instant as a UTC wall-clock TIMESTAMP_NTZ column.

    All timestamps inside candlewick are UTC TIMESTAMP_NTZ, so results never
    depend on ``spark.sql.session.timeZone``.
    """
    if as_of is None:
        return F.convert_timezone(None, F.lit("UTC"), F.current_timestamp())
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp_ntz")


def build_session(app: str = "candlewick", master: str | None = None,
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session with the settings the library relies on.

    AQE stays on so shuffle partitions are coalesced / split at runtime and
    small join sides are broadcast only after their size was measured.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates and lineage cuts.

    Uses the cluster's ``spark.checkpoint.dir``, else the folder set on the
    context. A local master (one machine, as in tests) gets a folder of its own
    once; on a cluster a missing folder is an error, because executors would
    not see each other's files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if sc is not None and not sc.getCheckpointDir():
        if not root:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            root = tempfile.mkdtemp(prefix="candlewick-")
        sc.setCheckpointDir(root)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return root


def _context(spark: SparkSession):
    """The SparkContext of a classic session (None for a remote session)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions have no context
        return None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
