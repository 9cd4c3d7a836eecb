"""Session settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Times are instants; wall clocks are converted where they enter.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def session(app: str = "tidemark", **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` adds to or overrides them."""
    builder = SparkSession.builder.appName(app)
    for key, value in (SETTINGS | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
