"""Session settings used by the tests and the bench.

On a cluster the session comes from the submitter; nothing in the library
depends on these values for its results.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: str | int = "*", app: str = "gleanery") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        # One machine: a folder of its own is shared by all threads. A set folder stays.
        .config("spark.checkpoint.dir", os.environ.get("GLEANERY_SHARED_DIR") or tempfile.mkdtemp(prefix="gleanery-"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
