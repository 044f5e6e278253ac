"""Session settings the library expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "shopfloor",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with UTC time, AQE and the web page switched off.

    Partition counts, memory and the checkpoint folder belong to the cluster, so
    none is set here; pass them in ``extra`` for a local run.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **(extra or {}),
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
