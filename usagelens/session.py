"""Session settings shared by every job."""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Settings:
    """Thresholds and prices the models depend on."""

    credit_price_usd: Decimal = Decimal("4.00")
    seconds_per_credit: int = 3600
    window_days: int = 30
    lookback_days: int = 3
    event_lookback_hours: int = 6


def build_session(app: str = "usagelens", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC clock and adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # A busy key's session windows are merged before the shuffle, not in one task after it.
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        # Wide projections generate methods the JVM would refuse to compile; past this size
        # Spark runs the operators one by one, which is faster than interpreting them.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Recording the Python call site of every column costs more than building it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session clock to UTC: zone-less timestamps pass through zoned functions."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def utc_now() -> datetime:
    """The wall clock, for the outermost caller only; models take ``as_of``."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A session that names none and runs in one process, as in tests, gets a temporary folder;
    on a cluster that would be a different folder on every machine, so it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0]
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return os.path.join(tempfile.gettempdir(), "usagelens")
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
