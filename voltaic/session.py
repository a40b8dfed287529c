"""A local session for tests and the bench.

The library never creates a session inside an operator and sets nothing on
the caller's: on a cluster the caller's session is used as it is.
"""

from __future__ import annotations

import os
from typing import Mapping

from pyspark.sql import SparkSession

# Settings every session of ours should have.  AQE re-plans joins and
# coalesces shuffle partitions at run time; skew join splits hot
# partitions; ANSI stays on (operators use try_* where a value may fail).
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "voltaic", settings: Mapping[str, str] | None = None) -> SparkSession:
    """A local session for tests and the bench; ``settings`` are added."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("VOLTAIC_DRIVER_MEMORY", "8g")))
    for key, value in {**DEFAULTS, **(settings or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
