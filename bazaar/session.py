"""Session defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Ids and money are compared exactly, so the session runs in UTC with ANSI checks; hot join
# keys are left to the adaptive skew split, which needs adaptive execution.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also where an aggregate above the join would have used its partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.cbo.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "bazaar", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` uses ``__`` for dots in a setting's name."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    settings.update({name.replace("__", "."): value for name, value in conf.items()})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
