"""Local session used by the tests and the benchmark."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: str | int = 8, app: str = "corvane", memory: str = "12g") -> SparkSession:
    os.environ.setdefault("PYARROW_IGNORE_TIMEZONE", "1")
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .getOrCreate()
    )
