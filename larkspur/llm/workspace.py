"""Tables and files shared by the driver and all executors.

``spark.checkpoint.dir`` names the shared folder.  It is read from the session;
only where it is unset (tests, a laptop) a local folder is used instead.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_FALLBACK: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The shared folder as a URI without a trailing slash."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = _FALLBACK.setdefault("dir", "file://" + os.path.join(tempfile.gettempdir(), f"larkspur-{os.getpid()}"))
    if "://" not in root and not root.startswith("file:"):
        root = "file://" + os.path.abspath(root) if os.path.isabs(root) else root
    return root.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the session may be gone at exit; the folder is temporary anyway
        pass


class Workspace:
    """One run's folder of intermediate tables; what is saved there has no lineage."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_root(spark)}/larkspur-{name}-{uuid.uuid4().hex}"
        self._n = 0
        atexit.register(_remove, spark, self.path)

    def folder(self, name: str) -> str:
        self._n += 1
        return f"{self.path}/{self._n:03d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Writes ``df`` once and returns a scan of what was written."""
        at = self.folder(name)
        df.write.parquet(at)
        out = self.spark.read.schema(df.schema).parquet(at)
        out._larkspur_path = at  # noqa: SLF001
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Deletes saved tables that nothing needs any more."""
        for f in frames:
            if at := getattr(f, "_larkspur_path", None):
                _remove(self.spark, at)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores behind it as it takes to differ from every column of ``df``."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n += "_"
        have.add(n.lower())
        out.append(n)
    return out


def documents_of(docs: DataFrame) -> DataFrame:
    """The two columns that every text operator reads; extra columns never matter."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))


def text_slices(batches, most: int = 4 << 20, column: str = "text"):
    """Cuts Arrow batches so that a slice holds about ``most`` bytes of text or one row."""
    import pyarrow.compute as pc

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        size = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).cumsum()
        at = 0
        while at < n:
            done = int(size[at - 1]) if at else 0
            end = int(size.searchsorted(done + most, side="right"))
            end = min(n, max(end, at + 1))
            yield batch.slice(at, end - at)
            at = end
