"""Jaccard join of n-gram sets with token-combination prefixes, and its components.

Every text is its set of k-word shingles (48-bit hashes).  Two sets link when
100 * |x & y| >= percent * |x | y|.  Shingles have a global order, rare before frequent.
A set's prefix is long enough that any partner shares one of its signatures:

* a rare shingle of the prefix is a signature by itself;
* frequent shingles fall into classes by hash, and each pair of the prefix's
  frequent shingles of one class is a signature.  A class with c shingles of the
  prefix still gives a common pair after c - 2 of them are lost, so the prefix
  grows until rare + sum(max(0, c - 1)) passes the number of shingles that a
  partner may lack.

The number of classes grows with set size; sets near a size limit emit the
signatures of both sides, so partners always meet under one scheme.

Candidates come in two rounds.  First each sampled signature's sets are compared
with one of them only, which joins up groups of copies cheaply.  Then, over all
signatures, sets of different components are compared, if their sizes and places
in the prefix leave a link possible.  Both rounds compare full sets.
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .components import components
from .textkernel import mix, shingle_sets
from .workspace import Workspace, text_slices, unused

TOKEN_BITS = 48
#: A shingle in more sets than this is frequent, unless more than LISTED are: then the limit doubles.
FREQUENT = 32
LISTED = 2_000_000
#: Bits of the fixed-size filter of shingles in two sets or more, and of that of documents to compare.
SEEN_BITS = 27
WANTED_BITS = 24
#: Bytes of text that a Python worker hashes at a time; its scratch arrays are many times that.
SLICE = 1 << 19
#: Shingles that a task counts before it hands them on, and about how many a counting group gets.
FLUSH = 2_000_000
GROUP = 1_500_000
#: Sets below the first limit use frequent shingles singly; limits go up fourfold, with limit / 2 classes.
FIRST_LIMIT = 32
#: Of the signatures, one in so many takes part in the first round.
SAMPLED = 8
#: Times that a set of each sampled signature is compared with the others.
HUB_ROUNDS = 2

_S1, _S2, _S3 = np.uint64(0x8D1F9A3C5B7E2461), np.uint64(0x3C79AC492BA7B653), np.uint64(0x1C69B3F74AC4AE35)


def _i64(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def fingerprint(s: np.ndarray) -> int:
    """64-bit identity of a set, as a signed integer."""
    h = (int(mix(s ^ _S1).sum(dtype=np.uint64)) * int(_S2) + len(s)) & 0xFFFFFFFFFFFFFFFF
    return h - (1 << 64) if h >> 63 else h


def _hash_id(ids: np.ndarray) -> np.ndarray:
    return mix(ids.astype(np.int64).view(np.uint64) ^ _S3) >> np.uint64(64 - WANTED_BITS)


def _ids(column) -> np.ndarray:
    return column.fill_null(-(1 << 62)).to_numpy(zero_copy_only=False)


def sets_of(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id, n_shingles, node`` per row; node is the set's fingerprint."""

    def run(batches):
        for b in text_slices(batches, SLICE):
            n, f = [], []
            for s in shingle_sets(b.column(1), k):
                n.append(len(s))
                f.append(fingerprint(s))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(f, pa.int64())], names=["doc_id", "n_shingles", "node"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, node long")


# counting --------------------------------------------------------------------------


def _pack_counts(tokens: np.ndarray, bits: int):
    """(part, blob) of sorted distinct tokens with counts; blobs hold gaps at a fixed byte width."""
    tokens.sort()
    starts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(TOKEN_BITS - bits)
    cut = np.append(np.searchsorted(tokens, starts), len(tokens))
    for part in np.flatnonzero(cut[1:] > cut[:-1]).tolist():  # a part at a time: scratch arrays stay small
        own = tokens[cut[part] : cut[part + 1]]
        at = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        n = np.minimum(np.diff(np.append(at, len(own))), 255).astype(np.uint8)
        gaps = np.diff(own[at], prepend=starts[part])
        width = max(1, -(-int(gaps.max()).bit_length() // 8))
        raw = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        yield part, bytes([width]) + n.tobytes() + np.ascontiguousarray(raw.T).tobytes()


def _unpack_counts(part: int, bits: int, blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    width = blob[0]
    m = (len(blob) - 1) // (1 + width)
    n = np.frombuffer(blob, dtype=np.uint8, count=m, offset=1)
    raw = np.zeros((m, 8), dtype=np.uint8)
    raw[:, :width] = np.frombuffer(blob, dtype=np.uint8, offset=1 + m).reshape(width, m).T
    return np.cumsum(raw.view("<u8")[:, 0], dtype=np.uint64) + np.uint64(part << (TOKEN_BITS - bits)), n


def _counts(docs: DataFrame, k: int, bits: int, frequent: int) -> DataFrame:
    """``part, seen, tokens, n``: per hash range, the filter of shingles met twice, and the frequent ones."""

    def gather(batches):
        held, size, met = [], 0, set()

        def flush():
            tokens = np.concatenate(held)
            held.clear()
            for got in itertools.batched(_pack_counts(tokens, bits), 1024):
                part, blob = zip(*got)
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(blob, pa.binary())], names=["part", "blob"])

        for b in text_slices(batches, SLICE):
            for s in shingle_sets(b.column(1), k):
                f = fingerprint(s)
                if len(s) and f not in met:  # copies that a task meets count once
                    met.add(f)
                    held.append(s)
                    size += len(s)
            if size >= FLUSH:
                yield from flush()
                size, met = 0, set()
        if size:
            yield from flush()

    def merge(table):
        part = table.column("part")[0].as_py()
        got = [_unpack_counts(part, bits, x) for x in table.column("blob").to_pylist()]
        t, n = np.concatenate([x for x, _ in got]), np.concatenate([x for _, x in got])
        order = np.argsort(t, kind="stable")
        t, n = t[order], n[order].astype(np.int64)
        at = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        t, n = t[at], np.add.reduceat(n, at)
        seen = np.zeros(1 << (SEEN_BITS - bits), dtype=np.uint8)
        low = (t[n > 1] >> np.uint64(TOKEN_BITS - SEEN_BITS)) & np.uint64(len(seen) - 1)
        seen[low.astype(np.int64)] = 1
        often = n > frequent
        return pa.table(
            {
                "part": pa.array([part], pa.int64()),
                "seen": pa.array([zlib.compress(np.packbits(seen, bitorder="little").tobytes(), 1)], pa.binary()),
                "tokens": pa.array([_i64(t[often])], pa.list_(pa.int64())),
                "n": pa.array([n[often]], pa.list_(pa.int64())),
            }
        )

    blobs = docs.mapInArrow(gather, "part long, blob binary")
    return blobs.groupBy("part").applyInArrow(merge, "part long, seen binary, tokens array<long>, n array<long>")


def _statistics(docs: DataFrame, k: int, total: int, frequent: int, ws: Workspace):
    """The shingle filter (bytes) and the frequent shingles in order of frequency rank."""
    bits = min(20, max(4, (total // GROUP).bit_length()))
    table = ws.save(_counts(docs, k, bits, frequent), "counts")
    seen = np.zeros(1 << (SEEN_BITS - 3), dtype=np.uint8)  # fixed size, whatever the input
    step = len(seen) >> bits
    for r in table.select("part", "seen").toLocalIterator():
        seen[r["part"] * step : (r["part"] + 1) * step] = np.frombuffer(zlib.decompress(r["seen"]), dtype=np.uint8)
    flat = table.select(F.explode(F.arrays_zip("tokens", "n")).alias("x")).select("x.tokens", "x.n")
    sizes = {r["p"]: r["c"] for r in flat.groupBy(F.floor(F.log2(F.col("n") / frequent)).alias("p")).agg(F.count("*").alias("c")).collect()}
    doubled = 0
    while sum(c for p, c in sizes.items() if p >= doubled) > LISTED:
        doubled += 1
    limit = frequent << doubled
    rows = flat.where(F.col("n") > limit).toArrow()  # at most LISTED rows, by the count above
    tokens = rows["tokens"].to_numpy().view(np.uint64)
    n = rows["n"].to_numpy()
    order = np.argsort(tokens)
    ws.drop(table)
    return seen, tokens[order], n[order]


# signatures ------------------------------------------------------------------------


def _schemes(n: int, percent: int) -> list[int]:
    """Class counts under which a set of n shingles emits pairs; 0: frequent shingles count singly."""
    limit, m = FIRST_LIMIT, 0
    while n >= limit:
        limit, m = limit * 4, limit // 2
    low = limit // 4  # the limit at or below n
    out = [m]
    if m and n * percent <= low * 100:
        out.append(low // 8 if low > FIRST_LIMIT else 0)
    return out


def signatures(s: np.ndarray, frequent: np.ndarray, count: np.ndarray, percent: int = 75) -> tuple[np.ndarray, np.ndarray]:
    """(signature, shingles left) of one sorted set.

    ``frequent`` is the sorted list of frequent shingles, ``count`` their counts.
    The second array bounds the overlap with a partner first met at the signature.
    """
    n = len(s)
    if not n:
        return s, np.zeros(0, dtype=np.int64)
    need = n - -(-n * percent // 100) + 1
    if len(frequent):
        place = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
        often = frequent[place] == s
    else:
        often = np.zeros(n, dtype=bool)
    rare = s[~often]
    if len(rare) >= need:
        return mix(rare[:need] ^ _S3), n - np.arange(need)
    sig, left = [mix(rare ^ _S3)], [n - np.arange(len(rare))]
    hot = s[often]
    hot = hot[np.lexsort((hot, count[place[often]]))]
    rest = n - len(rare)
    short = need - len(rare)
    for m in _schemes(n, percent):
        if m == 0:
            one = hot[:short]
            sig.append(mix(one ^ _S3))
            left.append(rest - np.arange(len(one)))
            continue
        cls = (mix(hot ^ _S2) % np.uint64(m)).astype(np.int64)
        # how much each further shingle adds: nothing if it is the first of its class
        again = np.ones(len(cls), dtype=np.int64)
        again[np.unique(cls, return_index=True)[1]] = 0
        end = int(np.searchsorted(np.cumsum(again), short)) + 1
        order = np.argsort(cls[:end], kind="stable")
        t, c = hot[:end][order], cls[:end][order]
        size = np.bincount(c, minlength=m)
        size = size[size > 0]
        at = np.cumsum(size) - size
        later = np.repeat(at + size, size) - np.arange(len(t)) - 1  # partners behind each shingle in its class
        i = np.repeat(np.arange(len(t)), later)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(later) - later, later)
        a, b = np.minimum(t[i], t[j]), np.maximum(t[i], t[j])
        sig.append(mix(mix(a ^ _S1) + b * _S2 + np.uint64(m)))
        left.append(np.full(len(i), rest))
    return np.concatenate(sig), np.concatenate(left)


def _emit(docs: DataFrame, k: int, percent: int, shared) -> DataFrame:
    """``sig, node, n, rest`` of all sets; signatures of shingles that one set only has are left out."""

    def run(batches):
        seen, frequent, count = shared.value
        met: set[int] = set()
        for b in text_slices(batches, SLICE):
            out = []
            for s in shingle_sets(b.column(1), k):
                f = fingerprint(s)
                if not len(s) or f in met:
                    continue
                met.add(f)
                low = s >> np.uint64(TOKEN_BITS - SEEN_BITS)
                twice = (seen[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8)) & 1
                if not twice.any():
                    continue
                sig, left = signatures(s, frequent, count, percent)
                lone = mix(s[twice == 0] ^ _S3)
                keep = ~np.isin(sig, lone)
                if keep.any():
                    out.append((sig[keep], left[keep], f, len(s)))
            if len(met) > 200_000:
                met.clear()
            if out:
                size = [len(x[0]) for x in out]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(_i64(np.concatenate([x[0] for x in out]))),
                        pa.array(np.repeat(np.array([x[2] for x in out], dtype=np.int64), size)),
                        pa.array(np.repeat(np.array([x[3] for x in out], dtype=np.int64), size)),
                        pa.array(np.concatenate([x[1] for x in out]).astype(np.int64)),
                    ],
                    names=["sig", "node", "n", "rest"],
                )

    return docs.mapInArrow(run, "sig long, node long, n long, rest long")


# verification ----------------------------------------------------------------------


def _wanted(spark, keys: DataFrame) -> np.ndarray:
    """Fixed-size filter of the documents whose sets are to be compared."""

    def bits(batches):
        got = np.zeros(1 << WANTED_BITS, dtype=np.uint8)
        any_row = False
        for b in batches:
            any_row = any_row or b.num_rows > 0
            got[_hash_id(_ids(b.column(0))).astype(np.int64)] = 1
        if any_row:
            packed = np.packbits(got, bitorder="little").view("<i8")
            at = np.flatnonzero(packed)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(packed[at])], names=["at", "word"])

    words = keys.select("rep").mapInArrow(bits, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    out = np.zeros(1 << (WANTED_BITS - 6), dtype=np.int64)
    out[words["at"].to_numpy()] = words["word"].to_numpy()
    return out.view(np.uint8)


def _packed_sets(docs: DataFrame, k: int, shared) -> DataFrame:
    """``node, doc_id, tokens`` of documents that the filter lets through; 6 bytes a shingle."""

    def run(batches):
        wanted = shared.value
        for b in text_slices(batches, SLICE):
            h = _hash_id(_ids(b.column(0)))
            yes = ((wanted[(h >> np.uint64(3)).astype(np.int64)] >> (h & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
            if not yes.any():
                continue
            b = b.filter(pa.array(yes))
            node, tokens = [], []
            for s in shingle_sets(b.column(1), k):
                node.append(fingerprint(s))
                tokens.append(np.ascontiguousarray(s.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), b.column(0), pa.array(tokens, pa.binary())], names=["node", "doc_id", "tokens"])

    return docs.mapInArrow(run, "node long, doc_id long, tokens binary")


def _open_set(blob: bytes) -> np.ndarray:
    raw = np.zeros((len(blob) // 6, 8), dtype=np.uint8)
    raw[:, :6] = np.frombuffer(blob, dtype=np.uint8).reshape(-1, 6)
    return raw.view("<u8")[:, 0]


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted distinct sets link."""
    at = np.searchsorted(y, x)
    both = int(np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x)) if len(y) else 0
    return 100 * both >= percent * (len(x) + len(y) - both) and both > 0


def _verify(docs: DataFrame, k: int, percent: int, pairs: DataFrame, classes: DataFrame, ws: Workspace) -> DataFrame:
    """The pairs ``u, v`` whose full sets link.  Each set travels once per pair it is in."""
    spark = docs.sparkSession
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()
    keys = ws.save(nodes.join(classes, "node").select("node", "rep"), "compared")
    wanted = spark.sparkContext.broadcast(_wanted(spark, keys))
    held = keys.select(F.col("node").alias("k_node"), "rep").hint("shuffle_hash")
    sets = _packed_sets(docs, k, wanted)
    sets = sets.join(held, (F.col("node") == F.col("k_node")) & F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi").select("node", "tokens")
    sets = ws.save(sets, "sets")

    def compare(batches):
        for b in batches:
            # a pair at a time: the sets of a whole batch are not held twice
            yes = [linked(_open_set(x.as_py()), _open_set(y.as_py()), percent) for x, y in zip(b.column(2), b.column(3))]
            yield b.select([0, 1]).filter(pa.array(yes, pa.bool_()))

    both = pairs.join(sets.withColumnsRenamed({"node": "u", "tokens": "x"}), "u").join(sets.withColumnsRenamed({"node": "v", "tokens": "y"}), "v")
    out = ws.save(both.select("u", "v", "x", "y").mapInArrow(compare, "u long, v long").distinct(), "links")
    wanted.destroy()
    ws.drop(keys, sets)
    return out


# the operator ----------------------------------------------------------------------


def _joined(docs: DataFrame, k: int, percent: int, frequent: int, ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """``doc_id, n_shingles, node`` of every row, and ``node, class_id, component_id, root`` of every set."""
    spark = docs.sparkSession
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    rows = ws.save(sets_of(docs, k), "sets-of")
    some = rows.where(F.col("n_shingles") > 0)
    classes = ws.save(some.groupBy("node").agg(F.min("doc_id").alias("rep")), "classes")
    total = some.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    shared = spark.sparkContext.broadcast(_statistics(docs, k, total, frequent, ws))
    emitted = ws.save(_emit(docs, k, percent, shared).distinct(), "signatures")
    shared.destroy()

    def sized(a, b):
        return (F.least(a, b) * 100 >= F.greatest(a, b) * percent).cast("boolean")

    # round 1: a sample of signatures, everything against one set of each: the one whose own
    # signatures are the most common, which in a group of copies is closest to what they were copied from
    part = ws.save(emitted.where(F.pmod(F.xxhash64("sig"), F.lit(SAMPLED)) == 0), "sample")
    size = part.groupBy("sig").agg(F.count("*").alias("c")).where(F.col("c") > 1)
    common = part.join(size, "sig").groupBy("node").agg(F.sum("c").alias("common"))
    part = part.join(size, "sig").join(common, "node").select("sig", "node", "n", "common")
    part = ws.save(part, "ranked")
    links, stars, roots = None, None, None
    for turn in range(HUB_ROUNDS):
        rooted = part.withColumn("root", F.col("node")) if roots is None else part.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        # every round has another order: hubs of what is still apart come up
        rank = F.struct("common", "node") if turn == 0 else F.struct(F.xxhash64("root", F.lit(turn)), "common", "node")
        hub = rooted.groupBy("sig").agg(F.max(rank).alias("h"), F.max_by("n", rank).alias("u_n"), F.max_by("root", rank).alias("u_root")).select("sig", F.col("h.node").alias("u"), "u_n", "u_root")
        new = rooted.join(hub, "sig").where((F.col("root") != F.col("u_root")) & sized(F.col("n"), F.col("u_n")))
        new = new.select(F.least("u", "node").alias("u"), F.greatest("u", "node").alias("v")).distinct()
        new = ws.save(new if stars is None else new.join(stars, ["u", "v"], "left_anti"), "stars")
        got = _verify(docs, k, percent, new, classes, ws)
        links, stars = (got, new) if links is None else (links.union(got), stars.union(new))
        roots = ws.save(components(links, ws), "roots-1")

    # round 2: all signatures, sets of different components
    t = emitted.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    t = ws.save(t, "rooted")
    ws.drop(emitted, part)
    mixed = t.groupBy("sig").agg(F.min("root").alias("a"), F.max("root").alias("b")).where(F.col("a") != F.col("b")).select("sig")
    # a group's signatures are gathered under the set of each that has most of them in common, so
    # that two sets meet once a group and not once a signature
    apart = ws.save(t.join(mixed, "sig", "left_semi"), "apart")
    size = apart.groupBy("sig").agg(F.count("*").alias("c"))
    sized_rows = apart.join(size, "sig")
    common = sized_rows.groupBy("node").agg(F.sum("c").alias("common"))
    hub = sized_rows.join(common, "node").groupBy("sig").agg(F.max(F.struct("common", "node")).alias("h")).select("sig", F.col("h.node").alias("hub"))
    under = apart.join(hub, "sig").groupBy("hub", "root", "node").agg(F.max("n").alias("n"), F.max("rest").alias("rest"), F.collect_list("sig").alias("sigs"))
    under = ws.save(under, "under")
    per = under.groupBy("hub", "root").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max("rest").alias("rest"), F.count("*").alias("sets"))
    per = ws.save(per, "mixed")
    x, y = (per.withColumnsRenamed({c: f"{s}_{c}" for c in ("root", "least", "most", "rest", "sets")}) for s in "xy")
    # |x & y| >= percent / (100 + percent) * (|x| + |y|), and is at most what either has left
    met = x.join(y, "hub").where(
        (F.col("x_root") < F.col("y_root"))
        & (F.least("x_rest", "y_rest") * (100 + percent) >= percent * (F.col("x_least") + F.col("y_least")))
        & (F.least("x_most", "y_most") * 100 >= percent * F.greatest("x_least", "y_least"))
    )
    # the side with fewer sets is spelt out first: a large component's sets then only come up as one side of a candidate
    few = F.col("x_sets") <= F.col("y_sets")
    met = met.select("hub", F.when(few, F.col("x_root")).otherwise(F.col("y_root")).alias("x_root"), F.when(few, F.col("y_root")).otherwise(F.col("x_root")).alias("y_root"))
    tx, ty = (under.withColumnsRenamed({"root": f"{s}_root", "node": s, "n": f"{s}_n", "rest": f"{s}_rest", "sigs": f"{s}_sigs"}) for s in "xy")
    pairs = met.join(tx, ["hub", "x_root"]).join(ty, ["hub", "y_root"]).where(
        (F.least("x_rest", "y_rest") * (100 + percent) >= percent * (F.col("x_n") + F.col("y_n")))
        & sized(F.col("x_n"), F.col("y_n"))
        & F.arrays_overlap("x_sigs", "y_sigs")
    )
    pairs = pairs.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct()
    pairs = ws.save(pairs.join(stars, ["u", "v"], "left_anti"), "pairs")
    ws.drop(t, apart, under, per)
    more = _verify(docs, k, percent, pairs, classes, ws)
    ws.drop(pairs)

    roots = ws.save(components(links.union(more), ws), "roots")
    named = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = ws.save(named.join(least, "root").select("node", F.col("rep").alias("class_id"), "component_id", "root"), "named")
    ws.drop(links, more, classes)
    return rows, named


def join_components(docs: DataFrame, k: int = 5, percent: int = 75, frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id`` for every row of ``docs(doc_id, text)``.

    ``class_id`` is the least doc_id with the same set, ``component_id`` the least
    one reachable by links.  A null or wordless text has no shingles, links with
    nothing and has its own doc_id for both.  Repeated rows repeat; a null doc_id
    takes part but is never the least unless no other is there.  An empty table
    gives no rows; other columns are not read.
    """
    rows, named = _joined(docs, k, percent, frequent, Workspace(docs.sparkSession, "ngramjoin"))
    out = rows.where(F.col("n_shingles") > 0).join(named, "node").select("doc_id", "n_shingles", "component_id", "class_id")
    none = rows.where(F.col("n_shingles") == 0)
    return out.union(none.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id")))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 75, frequent: int = FREQUENT) -> DataFrame:
    """``docs`` with one row of each component: the one with the least doc_id (null counts as the largest).

    Rows without words, null texts included, all stay.  Same columns, whatever
    their names.  Of rows with the same doc_id and the same set, the one whose
    text sorts first stays; rows that agree in that too differ in other columns at
    most, and any of them stays.
    """
    rows, named = _joined(docs, k, percent, frequent, Workspace(docs.sparkSession, "ngramjoin"))
    node, n, c_node, c_id, times, l_node, l_text = unused(docs, "k_node", "k_n", "c_node", "c_id", "k_times", "l_node", "l_text")
    rank = F.struct(F.col("class_id").isNull(), "class_id", "node")
    chosen = named.groupBy("root").agg(F.min(rank).alias("c")).select("c.class_id", "c.node")
    # most often a set is there once under its doc_id; only the others have to be told apart
    count = rows.where(F.col("n_shingles") > 0).groupBy("node", F.col("doc_id").alias("r_id")).agg(F.count("*").alias("times"))
    chosen = chosen.join(count, "node").where(F.col("class_id").eqNullSafe(F.col("r_id")))
    chosen = chosen.select(F.col("node").alias(c_node), F.col("class_id").alias(c_id), F.col("times").alias(times))
    tagged = _tagged(docs, k, node, n)
    mine = (F.col(node) == F.col(c_node)) & tagged["doc_id"].cast("long").eqNullSafe(F.col(c_id))
    marked = tagged.join(chosen.hint("shuffle_hash"), mine, "left")
    out = marked.where((F.col(n) == 0) | (F.col(times) == 1))
    if chosen.where(F.col(times) > 1).take(1):
        same = marked.where(F.col(times) > 1)
        least = same.groupBy(F.col(node).alias(l_node)).agg(F.min("text").alias(l_text))
        same = same.join(least, (F.col(node) == F.col(l_node)) & (same["text"] == F.col(l_text)), "left_semi")
        out = out.unionByName(same.dropDuplicates([node]))
    return out.drop(node, n, c_node, c_id, times)


def _tagged(docs: DataFrame, k: int, node: str, n: str) -> DataFrame:
    """``docs`` with the fingerprint and the size of each text's set; empty sets have numbers that spread them out."""
    ti = docs.columns.index("text")

    def run(batches):
        for b in text_slices(batches, SLICE):
            got = [(fingerprint(s) if len(s) else i, len(s)) for i, s in enumerate(shingle_sets(b.column(ti), k))]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array([x[i] for x in got], pa.int64()) for i in (0, 1))], names=[*b.schema.names, node, n])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(node, LongType()), StructField(n, LongType())]))
