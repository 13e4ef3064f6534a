"""Spark session with the settings that the operators' semantics rest on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, **settings: str) -> SparkSession:
    b = SparkSession.builder.appName("larkspur")
    if master:
        b = b.master(master)
    for k, v in (SETTINGS | settings).items():
        b = b.config(k, v)
    return b.getOrCreate()
