"""Token counts through a cache keyed by content and tokenizer digests."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokenizing import Tokenizing, tokenizing
from .workspace import Workspace, text_slices


def _encode(rows: DataFrame, path: str) -> DataFrame:
    def run(batches):
        tok = tokenizing(path)
        for b in text_slices(batches):
            n = tok.count([t or "" for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], names=["digest", "n_tokens"])

    return rows.select("digest", "text").mapInArrow(run, "digest binary, n_tokens long")


def count_tokens(docs: DataFrame, path: str, cache: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` for every row of ``docs(doc_id, text)``.

    ``cache`` is a folder of Parquet files with ``digest, n_tokens`` below one
    sub-folder per tokenizer digest; without it the run keeps a cache of its own.
    Content is normalised by reading null as the empty text, and keyed by SHA-256.
    Of the texts that the cache lacks, one copy each is encoded, and the counts
    are appended.  Rows repeat, and a null doc_id stays null; an empty table gives
    no rows; other columns are not read.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "tokencounts")
    known = f"{cache.rstrip('/') if cache else ws.folder('cache')}/tokenizer={Tokenizing.version(path)}"
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    keyed = ws.save(rows.select("doc_id", digest.alias("digest"), F.octet_length("text").cast("long").alias("n_bytes")), "keys")

    schema = "digest binary, n_tokens long"
    # one copy of each text, elected before the exchange as well, so that copies do not travel
    misses = rows.withColumn("digest", digest).groupBy("digest").agg(F.first("text").alias("text"))
    if _exists(spark, known):
        misses = misses.join(spark.read.schema(schema).parquet(known).select("digest"), "digest", "left_anti")
    _encode(misses, path).write.mode("append").parquet(known)

    # a cache that two writers appended to may hold a digest twice
    counts = spark.read.schema(schema).parquet(known).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
    return keyed.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")


def _exists(spark, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
