"""Session settings that results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Dates are cut in the session time zone, so it must not vary with the machine. Timestamps
#: in microseconds, unlike Spark's default layout, carry the statistics row groups are
#: skipped by.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a session. Sizes and parallelism stay the cluster's."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
