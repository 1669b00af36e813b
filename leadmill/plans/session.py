"""Settings the jobs rely on for speed; results do not depend on them."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# HotSpot does not compile methods above 8000 bytes of bytecode. The field rules
# form long projections; beyond this limit Spark splits their code into many
# small functions instead, which ran three times as fast here.
# A task that writes folders by source or priority keeps so many files open; only one with
# more of them sorts its rows first, which else spills them.
_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only where everything runs on one machine may the setting be absent.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and spark.sparkContext.master.startswith("local"):
        folder = tempfile.gettempdir()
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")

