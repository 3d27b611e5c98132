"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

SETTINGS = {
    # Inventory times carry no zone, so every session reads them the same way.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Files of an upsert's written batch go when nothing refers to it any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "stockroom", master: str | None = None, conf: Mapping[str, str] | None = None
) -> SparkSession:
    """A session with the settings the operators expect.

    ``master`` and sizes (memory, shuffle partitions) come from the caller or from spark-submit.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediates.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back to a temporary folder, because
    executors on other machines could not read one.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="stockroom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below :func:`work_dir`."""
    return f"{work_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
