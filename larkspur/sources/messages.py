"""A message log as Parquet segments, read by Spark's own readers wherever the folder is.

``<root>/<topic>/partition=<p>/base=<first offset>/`` holds one file of ``value``s in
offset order, a run of segments; a message's offset is the run's first offset plus its
row number.  Executors list, read and number the messages; a stream takes up new files
as they come, and each is a task of its own or several.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming.lag import assigned


#: Messages that a file has room for, as whole segments; one segment at least.
FILE_ROWS = 250_000
#: Files that a partition's batch is cut into at least, as far as it has segments.
FILES = 4


def append(messages: DataFrame, root: str, topic: str, segment: int = 100_000) -> None:
    """Writes ``messages(partition, offset, value)``, offsets without gaps, as segments of ``segment`` offsets.

    Segments are whole: a batch begins and ends at multiples of ``segment`` or at the log's end.
    A file holds a run of segments, so that the number of files goes by the messages and not by
    how short segments are.
    """
    span = segment * _run(messages, segment)
    base = (F.floor(F.col("offset") / span) * span).cast("long")
    rows = messages.select("partition", base.alias("base"), "offset", "value").repartition("partition", "base")
    first = F.min("offset").over(_segment())
    rows = rows.withColumn("base", first).sortWithinPartitions("partition", "base", "offset")
    rows.select("partition", "base", "value").write.mode("append").partitionBy("partition", "base").parquet(f"{root}/{topic}")


def _run(messages: DataFrame, segment: int) -> int:
    """Segments a file: by the longest partition of the batch, FILES files of it or files of FILE_ROWS."""
    most = messages.groupBy("partition").agg((F.max("offset") - F.min("offset") + 1).alias("n")).agg(F.max("n")).first()[0] or 0
    return max(1, min(FILE_ROWS, -(-most // FILES)) // segment)


def _segment():
    from pyspark.sql import Window

    return Window.partitionBy("partition", "base")


def read(spark: SparkSession, root: str, topic: str, stream: bool = False, replicas: int = 1, ordinal: int = 0, flush_bytes: int | None = None, starts: dict[int, int] | None = None) -> DataFrame:
    """``topic, partition, offset, value`` of the partitions that fall to one of the replicas.

    Partitions are those the folder has; folder pruning skips those of other replicas.
    A stream with ``flush_bytes`` admits segments to a batch until they have so many
    bytes (one segment at least).  ``starts`` are high watermarks by partition at some
    time: only segments from there on are read, others are pruned by their folders.
    """
    source = spark.readStream if stream else spark.read
    if stream and flush_bytes:
        source = source.option("maxBytesPerTrigger", str(flush_bytes))
    rows = source.schema("value string, partition int, base long").parquet(f"{root}/{topic}")
    if starts:
        at = F.create_map(*[F.lit(x) for p, first in starts.items() for x in (p, first)])
        rows = rows.where(F.col("base") >= F.coalesce(F.try_element_at(at, F.col("partition")), F.lit(0)))
    offset = F.col("base") + F.col("_metadata.row_index")
    return assigned(rows, ordinal, replicas).select(F.lit(topic).alias("topic"), "partition", offset.alias("offset"), "value")


def watermarks(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """``topic, partition, low, high``: the first offset there is and the one that comes next.

    Folder names give the first, and the row count of each partition's last segment,
    which its Parquet footer has, the next: of the messages nothing is read.
    """
    segments = spark.read.schema("partition int, base long").parquet(f"{root}/{topic}")
    rows = segments.groupBy("partition", "base").agg(F.count("*").alias("n"))
    ends = rows.groupBy("partition").agg(F.min("base").alias("low"), F.max(F.col("base") + F.col("n")).alias("high"))
    return ends.select(F.lit(topic).alias("topic"), "partition", "low", "high")


def from_positions(log: DataFrame, starts: DataFrame) -> DataFrame:
    """Messages from each partition's ``starts(partition, start)`` on; all of a partition without one."""
    known = F.broadcast(starts.select(F.col("partition").alias("s_partition"), "start"))  # a row a partition
    joined = log.join(known, F.col("partition") == F.col("s_partition"), "left")
    return joined.where(F.col("start").isNull() | (F.col("offset") >= F.col("start"))).select(log.columns)


class Producer:
    """Appends batches to a topic, each once by its key.

    ``_staged/`` gets a batch's files, ``_log/<20 digits>.json`` one commit a batch,
    which says where each file goes and what comes next in each partition; then the
    files move to their segments.  A writer first ends the moves of the newest commit,
    so that a batch whose writer died in between is whole before another follows, and
    a batch that comes again is recognised by the newest commit or by ``_done/<key>``.
    A writer that was crossed computes places anew, its files stay as they are.

    Every file that a task writes is a segment; they are dealt to the partitions in
    turn, nothing is shuffled.  Batches of :func:`append` must not run at the same time.
    """

    def __init__(self, spark: SparkSession, root: str, topic: str, partitions: int = 8):
        from .lake import Files

        self.spark, self.root, self.topic, self.partitions = spark, root.rstrip("/"), topic, partitions
        self.home = f"{self.root}/{topic}"
        self.files = Files(spark, self.home)

    def _newest(self) -> tuple[int, dict]:
        names = [n for n in self.files.names("_log") if n.endswith(".json")]
        if names:
            return int(names[-1][:20]), json.loads(self.files.read(f"_log/{names[-1]}"))
        known = any(n.startswith("partition=") for n in self.files.names(""))
        ends = {r["partition"]: r["high"] for r in watermarks(self.spark, self.root, self.topic).collect()} if known else {}  # a row a partition
        return -1, {"key": None, "moves": [], "next": [ends.get(p, 0) for p in range(self.partitions)]}

    def _finish(self, commit: dict) -> None:
        if commit["key"] is None or self.files.fs.exists(self.files.path(f"_done/{commit['key']}")):
            return
        for staged, place in commit["moves"]:
            if self.files.fs.exists(self.files.path(staged)):
                self.files.fs.mkdirs(self.files.path(place.rpartition("/")[0]))
                if not self.files.fs.rename(self.files.path(staged), self.files.path(place)):
                    raise OSError(f"{staged} could not be moved to {place}")
        self.files.put_new(f"_done/{commit['key']}", "")
        for folder in {staged.rpartition("/")[0] for staged, _ in commit["moves"]}:
            self.files.delete(folder)

    def append(self, values: DataFrame, key: str, attempts: int = 20) -> int:
        """Appends the texts of ``values(value)`` under a key; how many, 0 where the key has been written."""
        version, newest = self._newest()
        self._finish(newest)
        if self.files.fs.exists(self.files.path(f"_done/{key}")):
            return 0
        folder = f"_staged/{uuid.uuid4().hex}"
        values.select("value").write.parquet(f"{self.home}/{folder}")
        counts = self.spark.read.schema("value string").parquet(f"{self.home}/{folder}").groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n"))
        made = sorted((unquote(r["path"]).rpartition("/")[2], r["n"]) for r in counts.collect())  # a row a task of the write
        for _ in range(attempts):
            ends, moves = list(newest["next"]), []
            for i, (name, n) in enumerate(made):
                p = (version + 1 + i) % len(ends)
                moves.append((f"{folder}/{name}", f"partition={p}/base={ends[p]}/{name}"))
                ends[p] += n
            commit = {"key": key, "moves": moves, "next": ends}
            if self.files.put_new(f"_log/{version + 1:020d}.json", json.dumps(commit)):
                self._finish(commit)
                return sum(n for _, n in made)
            version, newest = self._newest()
            self._finish(newest)
        self.files.delete(folder)
        raise OSError(f"{attempts} others came first")
