"""Catalog tables of a lake as DataFrames: from a commit log, or from any tables of this shape.

``snapshot(snapshot_id, snapshot_time, schema_version)``,
``data_file(data_file_id, table_id, begin_snapshot, end_snapshot, path, path_is_relative, file_size_bytes, record_count, partition_id)``,
``delete_file``, ``file_partition_value``, ``file_column_stats``, ``scheduled``,
``lake_table``, ``lake_schema``, ``table_stats``, ``inlined``, ``metadata``.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIB = 1024 * 1024


@dataclass
class Catalog:
    snapshot: DataFrame
    data_file: DataFrame
    delete_file: DataFrame
    file_partition_value: DataFrame
    file_column_stats: DataFrame
    scheduled: DataFrame
    lake_table: DataFrame
    lake_schema: DataFrame
    table_stats: DataFrame
    inlined: DataFrame
    metadata: DataFrame

    def views(self) -> None:
        for f in fields(self):
            getattr(self, f.name).createOrReplaceTempView(f.name)


_FILE = "path string, bytes long, rows long, values array<string>, begin long"
_COMMIT = f"time double, add array<struct<{_FILE}>>, remove array<string>, values map<string, array<string>>"


def log_files(table) -> tuple[DataFrame, DataFrame]:
    """(``snapshot_id, snapshot_time``; ``path, begin, end, bytes, rows, values``) of a lake table's kept history, read by Spark from its log."""
    spark, first = table.spark, table.versions()[0]
    version = F.substring("_metadata.file_name", 1, 20).cast("long")
    commits = spark.read.schema(_COMMIT).option("pathGlobFilter", "*.json").json(f"{table.root}/_log").select(version.alias("version"), "*")
    added = commits.select("version", F.inline("add"))
    added = added.select("path", F.coalesce("begin", "version").alias("begin"), "bytes", "rows", "values")
    removed = commits.select(F.col("version").alias("end"), F.explode("remove").alias("r_path"))
    changed = commits.select("version", F.explode("values").alias("v_path", "now"))
    if first:  # what the fold at the oldest version holds is all that earlier commits said
        fold = spark.read.schema(f"files map<string, struct<{_FILE}>>").option("pathGlobFilter", f"{first:020d}.fold").json(f"{table.root}/_log")
        base = fold.select(F.explode("files").alias("path", "f")).select("path", F.col("f.begin").alias("begin"), "f.bytes", "f.rows", "f.values")
        later = F.col("version") > first
        added = commits.where(later).select("version", F.inline("add")).select("path", F.coalesce("begin", "version").alias("begin"), "bytes", "rows", "values").unionByName(base)
        removed, changed = removed.where(F.col("end") > first), changed.where(later)
    changed = changed.groupBy("v_path").agg(F.max_by("now", "version").alias("now"))
    files = added.join(removed, F.col("path") == F.col("r_path"), "left").join(changed, F.col("path") == F.col("v_path"), "left")
    files = files.select("path", "begin", "end", "bytes", "rows", F.coalesce("now", "values").alias("values"))
    return commits.select(F.col("version").alias("snapshot_id"), F.col("time").alias("snapshot_time")), files


def from_table(table, table_id: int = 0, name: str = "t") -> Catalog:
    """The catalog of one :class:`~larkspur.sources.lake.LakeTable`, derived from its log by Spark; a file's id is its path's hash."""
    spark: SparkSession = table.spark
    make = spark.createDataFrame
    snapshots, files = log_files(table)
    tid, fid = F.lit(table_id).cast("long").alias("table_id"), F.xxhash64("path").alias("data_file_id")
    zero = F.lit(0).cast("long")
    data = files.select(
        fid, tid, F.col("begin").alias("begin_snapshot"), F.col("end").alias("end_snapshot"), "path", F.lit(True).alias("path_is_relative"),
        F.col("bytes").alias("file_size_bytes"), F.col("rows").alias("record_count"), zero.alias("partition_id"),
    )
    values = files.select(fid, tid, F.posexplode("values").alias("partition_key_index", "partition_value"))
    return Catalog(
        snapshot=snapshots.withColumn("schema_version", zero),
        data_file=data,
        delete_file=make([], "delete_file_id long, data_file_id long, table_id long, begin_snapshot long, end_snapshot long, file_size_bytes long"),
        file_partition_value=values.withColumn("partition_key_index", F.col("partition_key_index").cast("long")),
        file_column_stats=make([], "data_file_id long, table_id long, column_id long"),
        scheduled=files.where(F.col("end").isNotNull()).select(fid, "path", F.lit(True).alias("path_is_relative")),
        lake_table=make([(table_id, 0, name, 0, None)], "table_id long, schema_id long, table_name string, begin_snapshot long, end_snapshot long"),
        lake_schema=make([(0, "main", None)], "schema_id long, schema_name string, end_snapshot long"),
        table_stats=files.where(F.col("end").isNull()).agg(F.coalesce(F.sum("rows"), zero).alias("record_count")).select(tid, "record_count"),
        inlined=make([], "table_id long, schema_version long, table_name string"),
        metadata=make([("version", "1.0", None, None)], "key string, value string, scope string, scope_id long"),
    )
