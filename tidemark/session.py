"""Session helpers.

Nothing here is required by the operators; they work on any session. The helpers pin the
settings the operators' results depend on (UTC session time zone for epoch conversions)
and give tests and the bench a sensible local session.
"""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "tidemark", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def findable(spark: SparkSession) -> None:
    """Lets Python workers started from another folder import this package from where the driver has
    it (a no-op where it is installed or shipped with the job)."""
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if root not in (have := env.get("PYTHONPATH", "")).split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (root, have)))


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Epoch-millisecond conversions of ``timestamp_ntz`` columns go through the session
    time zone; the operators define epoch time as UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


#: Scratch folders of local sessions that name no shared one, by application.
_SCRATCH: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession, sub: str | None = None) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names shared storage; its absence is an error. Only a local
    session (tests) without it gets a fresh scratch folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _SCRATCH:  # the setting itself cannot be changed in a running session
            _SCRATCH[app] = tempfile.mkdtemp(prefix="tidemark-ckpt-")
            spark.sparkContext.setCheckpointDir(_SCRATCH[app])
        base = _SCRATCH[app]
    if sub:
        return base.rstrip("/") + "/" + sub
    return base
