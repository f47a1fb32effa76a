"""Session settings the feature plans profit from."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # The plans are wide chains of aliases without filters worth inferring; inference over them takes
    # the optimizer longer than all other rules together (45 s for the joined table, 2 s without).
    "spark.sql.constraintPropagation.enabled": "false",
    # The JVM never compiles a method of more than 8,000 bytes of code. Stages whose generated code has one, as
    # wide rows of long CASE lists do, run as single operators, whose code is cut into small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Re-planning at run time: broadcast by real size, merged small partitions, split skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Applies the settings to a session and returns it. Results do not depend on them."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
