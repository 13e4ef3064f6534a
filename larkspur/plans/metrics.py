"""Built-in catalog metrics, and the merging of user-defined ones."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .catalog import MIB, Catalog

#: Upper limits of the size bands; the last band is open.
BANDS = (("lt_1mib", MIB), ("1_10mib", 10 * MIB), ("10_64mib", 64 * MIB), ("ge_64mib", None))


def band(size: Column) -> Column:
    out = F.lit(BANDS[-1][0])
    for name, top in reversed(BANDS[:-1]):
        out = F.when(size < top, name).otherwise(out)
    return out


def live(df: DataFrame) -> DataFrame:
    return df.where(F.col("end_snapshot").isNull())


def _sum(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("long")


def pending_deletes(c: Catalog) -> DataFrame:
    n, u = F.count("*"), F.countDistinct("path")
    return c.scheduled.agg(n.alias("total"), u.alias("unique_paths"), (n - u).alias("dup_rows"))


def data_files(c: Catalog) -> DataFrame:
    return live(c.data_file).agg(F.count("*").alias("files"), _sum("file_size_bytes").alias("bytes"), _sum("record_count").alias("rows"))


def delete_files(c: Catalog) -> DataFrame:
    return live(c.delete_file).agg(F.count("*").alias("files"), _sum("file_size_bytes").alias("bytes"))


def files_per_band(c: Catalog) -> DataFrame:
    return live(c.data_file).groupBy(band(F.col("file_size_bytes")).alias("band")).agg(F.count("*").alias("count"), _sum("file_size_bytes").alias("bytes"))


def with_partition(c: Catalog, files: DataFrame, how: str = "left") -> DataFrame:
    """``files`` with ``partition``: its values joined by slashes in key order, those of one key by value.

    Values are dealt out by the file's id alone, which is all that is joined by, so they
    move once.  With ``how="inner"`` files without any row of values are left out.
    """
    values = c.file_partition_value.where(F.col("data_file_id").isNotNull()).repartition("data_file_id")
    # an inner join, as a semi join would go before the exchange, and then what moves depends on whether the files' ids fit a broadcast
    values = values.join(files.select("data_file_id").distinct(), "data_file_id")
    per = values.groupBy("data_file_id").agg(F.collect_list(F.struct("table_id", "partition_key_index", "partition_value")).alias("entries"))
    named = files.join(per, "data_file_id", how)
    if how == "inner":
        named = named.where(F.exists("entries", lambda x: x["table_id"] == F.col("table_id")))
    own = F.filter("entries", lambda x: (x["table_id"] == F.col("table_id")) & x["partition_value"].isNotNull())
    # as the one element of an array the values are sorted once, though the text names them twice
    text = F.transform(F.array(F.array_sort(own)), lambda v: F.when(F.size(v) > 0, F.array_join(F.transform(v, lambda x: x["partition_value"]), "/")))
    return named.withColumn("partition", F.get(text, F.lit(0))).drop("entries")


def mergeable(c: Catalog) -> DataFrame:
    """Live files without live deletes, per table, partition and band below 64 MiB, where there are two or more."""
    deleted = live(c.delete_file).select("data_file_id").distinct()
    files = live(c.data_file).where(F.col("file_size_bytes") < BANDS[2][1]).join(deleted, "data_file_id", "left_anti")
    files = with_partition(c, files).withColumn("band", band(F.col("file_size_bytes")))
    groups = files.groupBy("table_id", "partition", "band").agg(F.count("*").alias("n"), F.sum("file_size_bytes").alias("size"))
    return groups.where(F.col("n") >= 2)


def mergeable_files_per_band(c: Catalog) -> DataFrame:
    return mergeable(c).groupBy("band").agg(F.sum("n").cast("long").alias("count"), F.sum("size").cast("long").alias("bytes"), F.count("*").alias("groups"))


def snapshots(c: Catalog, as_of: Column) -> DataFrame:
    age = lambda t: (F.unix_timestamp(as_of) - F.unix_timestamp(t)).cast("double")
    return c.snapshot.agg(
        F.count("*").alias("count"), age(F.min("snapshot_time")).alias("oldest_age"), age(F.max("snapshot_time")).alias("newest_age"),
        F.min("snapshot_id").alias("min_id"), F.max("snapshot_id").alias("max_id"),
    )


def inlined_data_tables(c: Catalog) -> DataFrame:
    return c.inlined.agg(F.count("*").alias("total"))


def unreachable_inlined(c: Catalog) -> DataFrame:
    """Registry rows whose table no retained snapshot reaches; none where there is no snapshot."""
    bounds = c.snapshot.agg(F.min("snapshot_id").alias("lo"), F.max("snapshot_id").alias("hi"))
    reach = c.lake_table.crossJoin(F.broadcast(bounds)).where(
        (F.col("begin_snapshot") <= F.col("hi")) & (F.col("end_snapshot").isNull() | (F.col("end_snapshot") > F.col("lo")))
    )
    some = F.broadcast(bounds.where(F.col("lo").isNotNull()).select(F.lit(1).alias("one")))
    return c.inlined.join(reach.select("table_id").distinct(), "table_id", "left_anti").crossJoin(some).drop("one")


def unreachable_inline_tables(c: Catalog) -> DataFrame:
    return unreachable_inlined(c).agg(F.count("*").alias("total"))


def tables(c: Catalog) -> DataFrame:
    return c.lake_table.groupBy(F.when(F.col("end_snapshot").isNull(), "live").otherwise("dropped").alias("state")).agg(F.count("*").alias("count"))


def files_per_partition_top20(c: Catalog) -> DataFrame:
    named = with_partition(c, live(c.data_file), "inner")
    per = named.groupBy("table_id", "partition").agg(F.count("*").alias("count"))
    return per.orderBy(F.desc("count"), "table_id", "partition").limit(20)


def live_file_lookup(c: Catalog, table_id: int) -> DataFrame:
    return live(c.data_file).where(F.col("table_id") == table_id).agg(F.count("*").alias("count"))


def partition_value_lookup(c: Catalog, table_id: int) -> DataFrame:
    files = live(c.data_file).where(F.col("table_id") == table_id).select("data_file_id")
    return c.file_partition_value.join(files, "data_file_id", "left_semi").agg(F.count("*").alias("count"))


def file_column_stats_lookup(c: Catalog, table_id: int) -> DataFrame:
    files = live(c.data_file).where(F.col("table_id") == table_id).select("data_file_id")
    return c.file_column_stats.join(files, "data_file_id", "left_semi").agg(F.count("*").alias("count"))


def catalog_version(c: Catalog) -> DataFrame:
    v = c.metadata.where((F.col("key") == "version") & F.col("scope").isNull())
    return v.select(F.regexp_extract("value", r"^([0-9]+(?:\.[0-9]+)*)", 1).try_cast("double").alias("format_version"), F.regexp_extract("value", r"^[0-9.]+(.*)$", 1).alias("suffix"))


def config(c: Catalog) -> DataFrame:
    v = F.lower("value")
    number = F.when(v == "true", 1.0).when(v == "false", 0.0).when(v.rlike(r"^-?[0-9]+(?:\.[0-9]+)?$"), v.try_cast("double"))
    return c.metadata.where(F.col("key") != "version").select("key", F.coalesce("scope", F.lit("global")).alias("scope"), "scope_id", number.alias("value"))


BUILT_IN: dict[str, Callable[[Catalog], DataFrame]] = {
    "pending_deletes": pending_deletes,
    "data_files": data_files,
    "delete_files": delete_files,
    "files_per_band": files_per_band,
    "mergeable_files_per_band": mergeable_files_per_band,
    "snapshots": lambda c: snapshots(c, F.now()),
    "inlined_data_tables": inlined_data_tables,
    "unreachable_inline_tables": unreachable_inline_tables,
    "tables": tables,
    "files_per_partition_top20": files_per_partition_top20,
    "live_file_lookup": lambda c: live_file_lookup(c, 0),
    "partition_value_lookup": lambda c: partition_value_lookup(c, 0),
    "file_column_stats_lookup": lambda c: file_column_stats_lookup(c, 0),
    "catalog": catalog_version,
    "config": config,
}
_NAME = re.compile(r"[a-z][a-z0-9_]*")


def merge(user: Iterable[dict], disabled: Iterable[str] = ()) -> dict[str, Callable[[Catalog], DataFrame]]:
    """Built-in metrics with the user's SQL ones by name (the user's win), less the disabled."""
    out = dict(BUILT_IN)
    for q in user:
        every = q.get("interval_minutes", 1)
        if not _NAME.fullmatch(str(q.get("name", ""))) or isinstance(every, bool) or not isinstance(every, int) or every < 1 or not q.get("sql"):
            raise ValueError(f"malformed metric {q!r}")
        out[q["name"]] = lambda c, sql=q["sql"]: (c.views(), c.snapshot.sparkSession.sql(sql))[1]
    for name in disabled:
        out.pop(name, None)
    return out


def samples(name: str, df: DataFrame, values: list[str], labels: list[str]) -> DataFrame:
    """``metric, labels, value`` of a metric's rows; null values give no sample, null labels the empty text."""
    tags = F.create_map(*[x for n in labels for x in (F.lit(n), F.coalesce(F.col(n).cast("string"), F.lit("")))]) if labels else F.create_map()
    parts = [df.select(F.lit(f"{name}_{v}").alias("metric"), tags.cast("map<string,string>").alias("labels"), F.col(v).cast("double").alias("value")) for v in values]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.where(F.col("value").isNotNull())


def exposition(df: DataFrame) -> DataFrame:
    """Text lines of samples."""
    pairs = F.transform(F.array_sort(F.map_entries("labels")), lambda e: F.concat(e["key"], F.lit('="'), F.regexp_replace(e["value"], '(["\\\\])', "\\\\\\\\$1"), F.lit('"')))
    tags = F.when(F.cardinality("labels") > 0, F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))).otherwise("")
    return df.select(F.concat("metric", tags, F.lit(" "), F.col("value").cast("string")).alias("line"))


def run(c: Catalog, queries: dict[str, Callable[[Catalog], DataFrame]]) -> tuple[dict[str, list], dict[str, str]]:
    """One pass over all metrics: rows of those that worked, errors of those that did not.

    Fails only where none worked.  Metric results are a few rows each.
    """
    good, bad = {}, {}
    for name, q in queries.items():
        try:
            good[name] = q(c).collect()
        except Exception as e:  # a metric's failure is that metric's own
            bad[name] = str(e)
    if queries and not good:
        raise RuntimeError(f"no metric succeeded: {bad}")
    return good, bad


def push(lines: DataFrame, url: str, timeout: float = 10.0) -> int:
    """Replaces a job's samples at a gateway by ``lines(line)``; the HTTP status.  An error of the gateway raises."""
    from urllib.request import Request, urlopen

    body = "".join(r["line"] + "\n" for r in lines.toLocalIterator())  # metric samples, a few lines a metric
    with urlopen(Request(url, body.encode(), {"Content-Type": "text/plain; version=0.0.4"}, method="PUT"), timeout=timeout) as answer:
        return answer.status
