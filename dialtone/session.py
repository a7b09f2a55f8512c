"""Spark session settings the reports rely on."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings every report assumes. The session time zone is pinned to UTC:
# fact timestamps are UTC wall-clock values (timestamp_ntz) and local days
# are always derived with an explicit zone, never from the session.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # generated methods above the JIT limit (8000 bytes) would run interpreted;
    # such stages fall back to split, compilable projections instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, app_name: str = "dialtone",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings in ``REQUIRED_CONF``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(REQUIRED_CONF)
    conf.setdefault("spark.ui.enabled", "false")
    conf.setdefault("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session (e.g. the driver's)."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


_OWN_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where it is unset, a local master gets a folder of its own for this
    application; on a cluster that is an error, as no local folder is shared.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    context = spark.sparkContext
    if not re.match(r"local(\[[^]]*\])?$", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _OWN_FOLDERS:
        _OWN_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="dialtone-")
    return _OWN_FOLDERS[context.applicationId]
