"""A lake table: Parquet files under a commit log with optimistic concurrency.

``_log/<20 digits>.json`` holds one commit a file.  A commit is written as a draft
and published under its version by a step that never replaces a file, so of two
writers of one version one fails, and a version is whole or not there.  A commit adds
and removes files and may change schema, partition spec or sort keys; a snapshot is
the fold of the commits up to a version.  Every CHECKPOINT commits the fold is written
beside them, so that a reader opens the newest fold and the commits after it.  Commits
with a key that the log has are recognised and write nothing.

A writer that another one crossed looks at what came between: if layout and table are
as they were, its staged files are committed at the next version, otherwise they are
discarded and the batch is written anew.

Snapshots expire by commits too: ``expire_to`` moves the oldest version that may be
read, ``queue`` names files that no version from there on sees, ``unqueue`` those that
have been deleted.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections import Counter
from dataclasses import dataclass, field, replace
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import evolve, partition, presort

CODECS = ("zstd", "snappy", "none")
#: Commits between two checkpoints of the log.
CHECKPOINT = 50
_VERSION = re.compile(r"\d{20}\.json")
#: Bins that one compaction job deals to tasks of their own; more share tasks.
MERGE_TASKS = 2000


_SLASHES = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*):/+")


def file_uri() -> Column:
    """The file that a row was read from; how many slashes follow the scheme differs between spellings."""
    return F.regexp_replace(F.col("_metadata.file_path"), _SLASHES.pattern, "$1:/")


class CommitConflict(Exception):
    """Another writer made this version, or changed the table since the basis."""


class TableRecreated(Exception):
    """The table is another one than the writer knew."""


class SnapshotExpired(Exception):
    """The version is older than the oldest that is kept."""


@dataclass
class Snapshot:
    version: int
    table_uuid: str
    schema: T.StructType
    spec: str
    sort: tuple[str, ...]
    files: dict[str, dict]
    keys: dict[str, int]
    metadata_version: int
    options: dict = field(default_factory=dict)
    oldest: int = 0
    queue: dict[str, dict] = field(default_factory=dict)
    specs: dict[str, int] = field(default_factory=dict)

    def after(self, c: dict) -> Snapshot:
        """This snapshot with a commit on top; dictionaries are taken over, not copied."""
        self.version = c["version"]
        if "schema" in c:
            self.schema = T.StructType.fromJson(c["schema"])
        if "schema" in c or "spec" in c:
            self.metadata_version = c["version"]
        self.spec, self.sort = c.get("spec", self.spec), tuple(c.get("sort", self.sort))
        if "spec" in c:
            self.specs.setdefault(self.spec, len(self.specs))
        self.options |= c.get("options", {})
        for f in c.get("remove", []):
            self.files.pop(f, None)
        for f in c.get("add", []):
            self.files[f["path"]] = {"begin": c["version"], "spec": self.spec} | f
        for path, values in c.get("values", {}).items():
            if path in self.files:
                self.files[path] = self.files[path] | {"values": values}
        self.oldest = c.get("expire_to", self.oldest)
        for f in c.get("queue", []):
            self.queue[f["path"]] = f
        for f in c.get("unqueue", []):
            self.queue.pop(f, None)
        if c.get("key"):
            self.keys[c["key"]] = c["version"]
        return self

    def copy(self) -> Snapshot:
        return replace(self, files=dict(self.files), keys=dict(self.keys), options=dict(self.options), queue=dict(self.queue), specs=dict(self.specs))

    def to_json(self) -> str:
        return json.dumps(vars(self) | {"schema": self.schema.jsonValue()})

    @staticmethod
    def from_json(text: str) -> Snapshot:
        s = Snapshot(**json.loads(text))
        s.schema, s.sort = T.StructType.fromJson(s.schema), tuple(s.sort)
        return s


class Files:
    """The few file system calls that the log needs, on whatever Hadoop can open."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf, self.root = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), root
        self.gateway = spark.sparkContext._gateway
        self.fs = self.path("").getFileSystem(self.conf)
        self.base = self.fs.makeQualified(self.path("")).toString()

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def uri(self, name: str) -> str:
        """The path as :func:`file_uri` spells it."""
        return _SLASHES.sub(r"\1:/", self.fs.makeQualified(self.path(name)).toUri().toString())

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self.path(name), True)
        out.write(bytearray(text.encode()))
        out.close()

    def put_new(self, name: str, text: str) -> bool:
        """Publishes a whole file under a name that is free; False if it is taken."""
        draft = f"{name.rpartition('/')[0]}/drafts/{uuid.uuid4().hex}"
        self.write(draft, text)
        try:
            self._publish(draft, name)
            return True
        except Py4JJavaError as e:
            if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        finally:
            self.delete(draft)

    def _publish(self, draft: str, name: str) -> None:
        a, b = self.fs.makeQualified(self.path(draft)), self.fs.makeQualified(self.path(name))
        if b.toUri().getScheme() == "file":  # a local rename replaces, a link does not
            at = [self.jvm.java.nio.file.Paths.get(p.toUri().getPath(), self.gateway.new_array(self.jvm.java.lang.String, 0)) for p in (a, b)]
            self.jvm.java.nio.file.Files.createLink(at[1], at[0])
            return
        kind = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.gateway.new_array(kind, 1)
        options[0] = kind.NONE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(b.toUri(), self.conf).rename(a, b, options)

    def read(self, name: str) -> str:
        s = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(s, "UTF-8")
        finally:
            s.close()

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        return sorted(x.getPath().getName() for x in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def delete(self, name: str) -> bool:
        return self.fs.delete(self.path(name), True)


def summary(adds: list[dict], codec: str, note: str) -> str:
    """One line on a batch, the same for the same batch: rows, files, partitions, bytes, codec, and where it came from."""
    parts = len({tuple(f["values"]) for f in adds if f["values"]})
    return f"{sum(f['rows'] for f in adds)} rows in {len(adds)} files of {parts} partitions, {codec}" + (f"; {note}" if note else "")


class LakeTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, self.root)
        #: What this writer did: commits, rebased, rebuilt, already_published.
        self.counts: Counter = Counter()
        self._known: Snapshot | None = None  # the newest this object has seen; later ones start from it

    # log ---------------------------------------------------------------------------

    def versions(self) -> list[int]:
        return [int(n[:20]) for n in self.files.names("_log") if _VERSION.fullmatch(n)]

    def _commit_at(self, v: int) -> dict:
        return json.loads(self.files.read(f"_log/{v:020d}.json")) | {"version": v}

    def commits(self) -> list[dict]:
        """The kept history, for maintenance; a snapshot does not need it."""
        return [self._commit_at(v) for v in self.versions()]

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The table at a version, or as it is; SnapshotExpired for one that is no longer kept."""
        for again in (True, True, False):
            try:
                s = self._fold(None)
                if version is None or version == s.version:
                    return s
                if version < s.oldest:
                    raise SnapshotExpired(f"version {version} of {self.root} has expired, the oldest is {s.oldest}")
                return self._fold(version)
            except Py4JJavaError:  # a commit that was trimmed after the log was listed
                if not again:
                    raise
        raise AssertionError("unreachable")

    def _fold(self, version: int | None) -> Snapshot:
        names = self.files.names("_log")
        upto = [int(n[:20]) for n in names if _VERSION.fullmatch(n) and (version is None or int(n[:20]) <= version)]
        if not upto:
            raise FileNotFoundError(f"no table at {self.root}")
        last = self._commit_at(upto[-1])
        known = self._known
        s = known.copy() if version is None and known and known.table_uuid == last["table_uuid"] and known.version <= last["version"] else None
        for n in [] if s else sorted((n for n in names if n.endswith(".fold") and int(n[:20]) <= upto[-1]), reverse=True):
            try:
                s = Snapshot.from_json(self.files.read(f"_log/{n}"))
            except ValueError:  # a fold of another layout or cut off: an older one will do
                continue
            break
        if s is None or s.table_uuid != last["table_uuid"]:
            s = Snapshot(-1, last["table_uuid"], T.StructType(), "", (), {}, {}, 0)
        for v in upto:
            if v > s.version:
                s = s.after(last if v == last["version"] else self._commit_at(v))
        if version is None:
            self._known = s.copy()
        return s

    def _commit(self, basis: Snapshot, change: dict) -> int:
        body = {"table_uuid": basis.table_uuid, "time": time.time()} | change
        v = basis.version + 1
        if not self.files.put_new(f"_log/{v:020d}.json", json.dumps(body)):
            raise CommitConflict(f"version {v} is taken")
        self.counts["commits"] += 1
        if v % CHECKPOINT == 0:
            self.files.put_new(f"_log/{v:020d}.fold", self._fold(v).to_json())
        return v

    def change(self, make, attempts: int = 8) -> int | None:
        """Commits ``make(snapshot)``; made anew from the newest snapshot if another writer comes first, nothing where it is None."""
        for attempt in range(attempts):
            s = self.snapshot()
            body = make(s)
            if body is None:
                return None
            try:
                return self._commit(s, body)
            except CommitConflict:
                if attempt + 1 == attempts:
                    raise
                time.sleep(min(30, 0.05 * 2**attempt))
        return None

    def trim(self, keep: int) -> int:
        """Deletes the log before version ``keep``, behind a fold that holds what it said; how many commits."""
        name = f"_log/{keep:020d}.fold"
        if not self.files.fs.exists(self.files.path(name)):
            self.files.put_new(name, self._fold(keep).to_json())
        old = [n for n in self.files.names("_log") if (_VERSION.fullmatch(n) or n.endswith(".fold")) and int(n[:20]) < keep]
        for n in old:
            self.files.delete(f"_log/{n}")
        return sum(n.endswith(".json") for n in old)

    # DDL ---------------------------------------------------------------------------

    def create(self, schema: T.StructType, spec: str = "", sort: tuple[str, ...] = (), options: dict | None = None) -> Snapshot:
        """Creates the table unless it is there; whoever comes second takes the first's."""
        if not self.versions():
            if spec:
                partition.parse_spec(spec)
            evolve.check_reserved([f.name for f in schema if f.name != evolve.STAMP], "transform")
            evolve.check_nullable_variants(schema)
            fields = [f for f in schema if f.name != evolve.STAMP] + [T.StructField(evolve.STAMP, T.TimestampType())]
            body = {"table_uuid": str(uuid.uuid4()), "time": time.time(), "schema": T.StructType(fields).jsonValue(), "spec": spec, "sort": list(sort), "options": options or {}}
            self.files.put_new(f"_log/{0:020d}.json", json.dumps(body))  # whoever comes first
        have = self.snapshot()
        if spec and have.spec and have.spec != spec:
            raise ValueError(f"table is partitioned by {have.spec!r}, not {spec!r}")
        if spec and not have.spec:
            self._commit(have, {"spec": spec})
            have = self.snapshot()
        return have

    def ensure_sort(self, keys: tuple[str, ...], dry_run: bool = False) -> bool:
        """Sets the sort keys; False if they are set already or the table is absent."""
        if not self.versions():
            return False
        s = self.snapshot()
        if s.sort == tuple(keys):
            return False
        if not dry_run:
            self._commit(s, {"sort": list(keys)})
        return True

    # write -------------------------------------------------------------------------

    def append(self, df: DataFrame, key: str | None = None, codec: str = "zstd", level: int = 3, table_uuid: str | None = None, attempts: int = 5, note: str = "") -> int:
        """Appends a batch, evolving the schema by widening; returns the rows written (0 for a replay).

        The commit's message says what the batch was, with ``note`` behind it.
        """
        if codec not in CODECS or (codec == "zstd" and not 1 <= level <= 9):
            raise ValueError(f"codec is one of {CODECS}, zstd levels are 1 to 9")
        df, unsafe = evolve.drop_unwritable(df)
        unstorable = [f.name for f in df.schema if not evolve.storable(f.dataType)]
        df = df.drop(*unstorable)
        self.counts["unsafe_field_name"] += len(unsafe)
        self.counts["columns_skipped"] += len(unstorable)
        if not df.columns:
            return 0
        evolve.check_reserved(df.columns, "transform")
        if not self.versions():
            self.create(df.schema)
        basis, change, adds = None, {}, []
        for attempt in range(attempts):
            s = self.snapshot()
            if table_uuid and table_uuid != s.table_uuid or basis and basis.table_uuid != s.table_uuid:
                self.delete_files([f["path"] for f in adds])
                raise TableRecreated(self.root)
            if key and key in s.keys:
                self.delete_files([f["path"] for f in adds])
                self.counts["already_published"] += 1
                return 0
            # layout changed in between, or history that would tell has expired: what is staged may have the old one
            if basis and (s.metadata_version > basis.version or basis.version < s.oldest):
                self.delete_files([f["path"] for f in adds])
                basis = None
                self.counts["rebuilt"] += 1
            elif basis:
                self.counts["rebased"] += 1
            if basis is None:
                body, _ = evolve.drop_live_variants(df, s.schema)
                body, texts_only = evolve.drop_companions(body, s.schema)
                self.counts["companion_degraded"] += len(texts_only)
                if not body.columns:
                    return 0
                # only what the reader can widen in older files
                schema, added, widened, skipped = evolve.plan(s.schema, body.schema, evolve.PROMOTIONS)
                self.counts["columns_skipped"] += len(skipped)
                change = {"schema": schema.jsonValue()} if added or widened else {}
                adds, basis = self._stage(body, schema, s, codec, level), s
            try:
                self._commit(s, change | {"add": adds, "key": key, "message": summary(adds, f"{codec}-{level}" if codec == "zstd" else codec, note)})
                self.counts["files"] += len(adds)
                return sum(f["rows"] for f in adds)
            except CommitConflict:
                if attempt + 1 == attempts:
                    self.delete_files([f["path"] for f in adds])
                    raise
                time.sleep(min(30, 0.05 * 2**attempt))
        return 0

    def _stage(self, df: DataFrame, schema: T.StructType, s: Snapshot, codec: str, level: int) -> list[dict]:
        """Writes Parquet files, hive folders by partition value, and describes them from their own rows."""
        spec = partition.parse_spec(s.spec) if s.spec else ()
        body = evolve.align(evolve.stamp(df), schema)
        keys, unsorted = presort.sort_keys(body, s.sort)
        if unsorted:
            self.counts[f"sort_skipped_{unsorted}"] += 1
        laid = partition.write_layout(body, spec, keys)
        folder = f"data/{uuid.uuid4().hex}"
        names = ["p_" + f.name for f in spec]
        w = laid.write.option("compression", codec).option("parquet.compression.codec.zstd.level", level)
        (w.partitionBy(*names) if names else w).parquet(f"{self.root}/{folder}")
        return self._describe(folder, schema, spec, sorted(s.sort))

    def _describe(self, folder: str, schema: T.StructType, spec: tuple, stats: list[str]) -> list[dict]:
        if not self.files.fs.exists(self.files.path(folder)):
            return []
        read = self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{self.root}/{folder}")
        use = [c for c in stats if c in read.columns]
        aggs = [F.count("*").alias("rows"), *[F.min(c).cast("string").alias(f"lo_{c}") for c in use], *[F.max(c).cast("string").alias(f"hi_{c}") for c in use]]
        # a file has one value of each partition field: its rows tell, whatever the folder is called
        kinds = dict(read.dtypes)
        aggs += [F.min(f.value(kinds[f.column]).cast("string")).alias(f"p_{i}") for i, f in enumerate(spec)]
        # a row a file of this write: as many as the write had tasks and partition values
        rows = read.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(*aggs).collect()
        out = []
        for r in rows:
            path = unquote(r["path"])
            rel = path[path.rindex(folder) :]
            out.append({"path": rel, "bytes": r["bytes"], "rows": r["rows"], "values": [r[f"p_{i}"] for i in range(len(spec))], "stats": {c: [r[f"lo_{c}"], r[f"hi_{c}"]] for c in use}})
        if not spec:  # without folders, the first task of a write makes a file even if it has no row, which no commit would name
            known = {f["path"] for f in out}
            self.delete_files([f for n in self.files.names(folder) if n.startswith("part-") and (f := f"{folder}/{n}") not in known])
        return out

    # read --------------------------------------------------------------------------

    def read(self, version: int | None = None, keep_file=None) -> DataFrame:
        """The table at a version; ``keep_file(file)`` prunes files by partition values or statistics."""
        s = self.snapshot(version)
        paths = [f"{self.root}/{p}" for p, f in s.files.items() if keep_file is None or keep_file(f)]
        if not paths:
            return self.spark.createDataFrame([], s.schema)
        # the reader widens what older files hold, and gives nulls for what they lack
        return evolve.align(self.spark.read.schema(s.schema).parquet(*paths), s.schema)

    def file_rows(self) -> list[tuple]:
        """Every file of the kept history: ``path, begin_snapshot, end_snapshot, bytes, rows, values``."""
        commits = self.commits()
        base = self._fold(commits[0]["version"])
        alive = {p: [p, f["begin"], None, f["bytes"], f["rows"], f["values"]] for p, f in base.files.items()}
        out = list(alive.values())
        for c in commits[1:]:
            for p in c.get("remove", []):
                if p in alive:
                    alive[p][2] = c["version"]
            for p, v in c.get("values", {}).items():
                if p in alive:
                    alive[p][5] = v
            for f in c.get("add", []):
                alive[f["path"]] = [f["path"], f.get("begin", c["version"]), None, f["bytes"], f["rows"], f["values"]]
                out.append(alive[f["path"]])
        return [tuple(r) for r in out]

    # maintenance -------------------------------------------------------------------

    def replace(self, remove: list[str], add: list[dict], spec: str | None = None) -> int:
        """Puts files in the place of live ones, whatever else was committed meanwhile; CommitConflict if one is gone or the spec is another."""

        def make(s: Snapshot) -> dict:
            gone = [p for p in remove if p not in s.files]
            if gone:
                raise CommitConflict(f"files are no longer live: {gone[:3]}")
            if spec is not None and spec != s.spec:
                raise CommitConflict(f"the table is partitioned by {s.spec!r} now")
            return {"remove": remove, "add": add}

        return self.change(make)

    def present(self, paths: list[str]) -> set[str]:
        """Those of the paths that there is a file for; one listing a folder."""
        out = set()
        for folder in {p.rpartition("/")[0] for p in paths}:
            out |= {f"{folder}/{n}" for n in self.files.names(folder)}
        return out & set(paths)

    def _dealt(self, s: Snapshot, groups: dict[int, list[str]]) -> tuple[DataFrame, str]:
        """The rows of the groups' files with the number of their group, and the name of that column."""
        names = {c.lower() for c in s.schema.names}
        bin_, path = (next(n for k in range(99) if (n := f"{x}_{k}").lower() not in names) for x in ("bin", "path"))
        dealt = self.spark.createDataFrame([(self.files.uri(p), i) for i, g in groups.items() for p in g], f"{path} string, {bin_} int")
        src = self.spark.read.schema(s.schema).option("ignoreMissingFiles", "true").option("ignoreCorruptFiles", "true").parquet(*[f"{self.root}/{p}" for g in groups.values() for p in g])
        # the row a file goes to the tasks: by estimated sizes, files that compress well would be taken to the driver as rows
        return src.select("*", file_uri().alias(path)).join(F.broadcast(dealt), path).drop(path), bin_

    def compact(self, groups: list[list[str]], codec: str = "zstd") -> int:
        """Merges each group of live files of one partition tuple into a file; how many groups.

        All groups are one job: rows go to the task of their group, which writes one
        file.  Each group is a commit of its own, and only if its file has as many rows
        as the log gives its inputs; a group with a lost or broken file, or with files
        that others removed meanwhile, stays as it is and leaves the others alone.
        """
        s = self.snapshot()
        here = self.present([p for g in groups for p in g])
        whole = {i: g for i, g in enumerate(groups) if g and all(p in s.files and p in here for p in g)}
        if not whole:
            return 0
        rows, bin_ = self._dealt(s, whole)
        keys, _ = presort.sort_keys(rows, s.sort)
        folder = f"data/{uuid.uuid4().hex}"
        rows.repartition(min(len(whole), MERGE_TASKS), bin_).sortWithinPartitions(bin_, *keys).write.option("compression", codec).partitionBy(bin_).parquet(f"{self.root}/{folder}")
        made: dict[int, list[dict]] = {}
        for f in self._describe(folder, s.schema, (), sorted(s.sort)):
            made.setdefault(int(re.search(rf"/{bin_}=(\d+)/", f["path"])[1]), []).append(f)
        done = 0
        for i, group in whole.items():
            out = made.get(i, [])
            inputs = [s.files[p] for p in group]
            same = sum(f["rows"] for f in out) == sum(f["rows"] for f in inputs)
            add = [f | {"values": inputs[0]["values"], "spec": inputs[0]["spec"]} for f in out]
            try:
                if not same:
                    raise CommitConflict("rows are missing")
                self.replace(group, add)
                done += 1
            except CommitConflict:
                self.counts["groups_left"] += 1
                self.delete_files([f["path"] for f in out])
        return done

    def delete_files(self, paths: list[str]) -> int:
        return sum(bool(self.files.delete(p)) for p in paths)
