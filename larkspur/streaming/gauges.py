"""State of a running ingest as metric samples: ``metric, labels, value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ingest import Counters

SAMPLE = "metric string, labels map<string, string>, value double"


def positions(log: DataFrame, done: DataFrame, reset: str = "earliest") -> DataFrame:
    """``last_committed_offset`` and ``consumer_lag`` of each partition.

    ``log(topic, partition, low, high)`` are watermarks, ``done(partition, position)``
    the offsets that come next; a partition without one starts where ``reset`` says
    and has no committed offset.
    """
    from . import lag

    known = done.select(F.col("partition").alias("d_partition"), F.col("position").alias("committed"))
    both = log.join(known, F.col("partition") == F.col("d_partition"), "left")
    empty = F.lit(None).cast("long")
    both = both.withColumns({"position": empty, "delivered": empty})
    tags = F.create_map(F.lit("partition"), F.col("partition").cast("string"), F.lit("topic"), F.col("topic"))
    rows = F.array(*[F.struct(F.lit(n).alias("metric"), tags.alias("labels"), v.cast("double").alias("value")) for n, v in (("last_committed_offset", F.col("committed") - 1), ("consumer_lag", lag.lag(reset)))])
    return both.select(F.inline(rows)).where(F.col("value").isNotNull())


def counters(spark: SparkSession, c: Counters) -> DataFrame:
    """What an ingest has counted so far, one row a counter."""
    rows = [(f"{k}_total", {}, float(getattr(c, k))) for k in ("consumed", "written", "batches", "replays", "bytes")]
    for name, label, of in (("skipped_total", "reason", c.skipped), ("flushes_total", "trigger", c.flushes), ("errors_total", "type", c.failed), ("sink_total", "what", c.sink), ("include_total", "what", c.include), ("flush_rows_bucket", "le", c.shape)):
        rows += [(name, {label: str(k)}, float(v)) for k, v in of.items()]
    rows.append(("healthy", {}, float(c.healthy())))
    return spark.createDataFrame(rows, SAMPLE)
