"""Near-duplicate vectors by rotated binary codes with stored correction factors.

Vectors of one label that are alike collide in random-hyperplane buckets.  Through
the buckets travel codes: a vector's signs after a random rotation, the correction
factor, and its components in 8 bits.  The code and factor of one vector and the
8-bit components of another give an unbiased estimate of their inner product and a
confidence bound.  Vectors with a pair whose upper bound reaches the threshold go on
to the same buckets in full, where what the bounds leave open is computed exactly,
in double precision; all other pairs are settled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .vectors import unit, usable
from .workspace import Workspace

#: Standard deviations that the confidence bound of an estimate spans.
CONFIDENCE = 5.0
#: Independent rotations per code: a code has this many bits per dimension.
ROTATIONS = 2
#: Expected vectors of one bucket, and the chance that a pair at the threshold meets in none.
BUCKET = 128
MISS = 1e-6
#: Vectors whose projections are computed at a time.
PROJECTED = 1024
#: Vectors of a bucket that one comparison block holds; larger buckets are compared block by block.
BLOCK = 2048


@dataclass(frozen=True)
class Hyperplanes:
    """Bucket keys: ``tables`` of ``bits`` signs of random projections each."""

    bits: int
    tables: int

    @staticmethod
    def of(rows: int, cosine: float) -> Hyperplanes:
        bits = max(8, min(28, math.ceil(math.log2(max(2, rows) / BUCKET))))
        meet = (1 - math.acos(cosine) / math.pi) ** bits
        return Hyperplanes(bits, math.ceil(math.log(MISS) / math.log(1 - meet)))

    def keys(self, u: np.ndarray) -> np.ndarray:
        rng = np.random.Generator(np.random.PCG64([0xB1, u.shape[1]]))
        planes = rng.standard_normal((u.shape[1], self.bits * self.tables))
        signs = (u @ planes > 0).reshape(len(u), self.tables, self.bits)
        return (signs << np.arange(self.bits)).sum(axis=2).astype(np.int32)


_rotations: dict[int, np.ndarray] = {}


def rotation(dim: int) -> np.ndarray:
    """Seeded orthogonal matrices side by side, dim x (ROTATIONS * dim)."""
    if dim not in _rotations:
        rng = np.random.Generator(np.random.PCG64([0x5AB1, dim]))
        _rotations[dim] = np.concatenate([np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(ROTATIONS)], axis=1)
    return _rotations[dim]


def encode(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (packed signs) and correction factors, the inner products of unit vectors with their codes."""
    r = u @ rotation(u.shape[1]) / math.sqrt(ROTATIONS)
    return np.packbits(r > 0, axis=1), np.abs(r).sum(axis=1) / math.sqrt(r.shape[1])


def rounded(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components in 8 bits and the step of each row: no component is off by more than half a step."""
    step = np.maximum(np.abs(u).max(axis=1), 1e-30) / 127
    return np.rint(u / step[:, None]).astype(np.int8), step


def estimate(code: np.ndarray, factor: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of coded vectors (rows) with unit vectors (columns), and error bounds per row."""
    bits = ROTATIONS * u.shape[1]
    signs = np.unpackbits(code, axis=1, count=bits).astype(np.float32) * 2 - 1
    turned = (u @ rotation(u.shape[1]) / math.sqrt(ROTATIONS)).astype(np.float32)
    est = (signs @ turned.T) / (math.sqrt(bits) * factor[:, None])
    return est, CONFIDENCE * np.sqrt((1 - factor**2) / factor**2 / max(1, u.shape[1] - 1))


def _maybe(a: dict, other: dict, table: int, cosine: float, alone: bool) -> np.ndarray:
    """Pairs (rows of a, rows of other) that the estimates leave open and no earlier table has brought together."""
    est, err = estimate(a["code"], a["factor"], other["unit"])
    maybe = est + err[:, None] + other["slack"][None] / a["factor"][:, None] >= cosine
    if alone:
        maybe = np.triu(maybe, 1)
    i, j = np.nonzero(maybe)
    out = []
    for lo in range(0, len(i), 200_000):
        p, q = i[lo : lo + 200_000], j[lo : lo + 200_000]
        first = ~(a["keys"][p, :table] == other["keys"][q, :table]).any(axis=1)
        out.append((p[first], q[first]))
    return np.concatenate([np.stack(x) for x in out], axis=1) if out else np.zeros((2, 0), dtype=np.int64)


def link_block(a: dict, b: dict | None, table: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (rows of a, rows of b; of a alone, i < j, where b is None) whose first common table this is."""
    other = a if b is None else b
    i, j = _maybe(a, other, table, cosine, b is None)
    ok = [np.zeros(0, dtype=bool)]
    for lo in range(0, len(i), 200_000):  # exact recomputation of what the bounds leave open
        ok.append((a["unit"][i[lo : lo + 200_000]] * other["unit"][j[lo : lo + 200_000]]).sum(axis=1) >= cosine)
    ok = np.concatenate(ok)
    return i[ok], j[ok]


def _groups(batches):
    """Rows of sorted batches, one table per (bucket, lo, hi)."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        new = np.zeros(b.num_rows, dtype=bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), b.num_rows]
        for s, e in zip(cuts[:-1], cuts[1:]):
            key = tuple(int(c[s]) for c in cols)
            if key != last and held:
                yield last, pa.Table.from_batches(held)
                held = []
            last = key
            held.append(b.slice(s, e - s))
    if held:
        yield last, pa.Table.from_batches(held)


def _sides(lo: int, hi: int, t: pa.Table) -> list[pa.Table]:
    """The one block of a group, or its two."""
    own = t.column("own").to_numpy()
    return [t] if lo == hi else [t.filter(pa.array(own == lo)), t.filter(pa.array(own == hi))]


def _raw(t: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(t.column(name).to_pylist()), dtype=kind).reshape(t.num_rows, -1)


def _coded(t: pa.Table) -> dict:
    step = t.column("step").to_numpy().astype(np.float64)
    u = _raw(t, "small", np.int8) * step[:, None]
    return {
        "factor": t.column("factor").to_numpy().astype(np.float64),
        "code": _raw(t, "code", np.uint8),
        "keys": _raw(t, "keys", np.int32),
        "unit": u,
        "slack": step / 2 * math.sqrt(u.shape[1]),  # length of what rounding has taken away, at most
    }


def _whole(t: pa.Table, planes: Hyperplanes, upto: int) -> dict:
    u = unit(_raw(t, "raw", np.float64))
    code, factor = encode(u)
    return {"weight": t.column("weight").to_numpy(), "factor": factor, "code": code, "keys": planes.keys(u)[:, :upto], "unit": u, "slack": np.zeros(len(u))}


def near_duplicates(vectors: DataFrame, cosine: float = 0.93) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors(vec_id, embedding, label)``.

    Rows with equal labels (not null) and a cosine of at least ``cosine`` link.
    Vectors that are null, empty, zero or not finite, rows without label and rows
    without vec_id link with nothing and keep their own id.  Equal vectors of a
    label are compared once and count as often as they are there; repeated rows
    are rows.  Vectors of different lengths are never compared.  An empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    ws = Workspace(spark, "vecdedup")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    good = usable(rows.where(F.col("label").isNotNull() & F.col("vec_id").isNotNull()))
    # equal vectors, -0.0 and 0.0 alike, are one node, known by 2 x 64 bits; nodes are numbered as they are written
    same = F.transform("vec", lambda x: x + F.lit(0.0))
    hashes = {f"h{i}": F.xxhash64(F.lit(i), "label", same) for i in (1, 2)}
    keyed = ws.save(good.select("vec_id", "label", "vec").withColumns(hashes), "vectors")
    classes = keyed.groupBy(*hashes).agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.first("label").alias("label"), F.first("vec").alias("vec"))
    classes = ws.save(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    planes = Hyperplanes.of(max((r["c"] for r in classes.groupBy("label").agg(F.count("*").alias("c")).orderBy(F.desc("c")).limit(1).collect()), default=1), cosine)
    blob = lambda a: pa.array([r.tobytes() for r in np.ascontiguousarray(a)], pa.binary())

    def spread(batches):
        for b in batches:
            lens = np.array([len(v) for v in b.column(2).to_pylist()]) if b.num_rows else np.zeros(0, dtype=int)
            for dim in np.unique(lens).tolist():
                same_size = b.filter(pa.array(lens == dim))
                for at in range(0, same_size.num_rows, PROJECTED):
                    part = same_size.slice(at, PROJECTED)
                    u = unit(part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64))
                    keys = planes.keys(u)
                    code, factor = encode(u)
                    small, step = rounded(u)
                    n = len(u)
                    codes, smalls = blob(code), blob(small)
                    for tab in range(planes.tables):  # vectors of other lengths have other keys
                        cols = [part.column(1), pa.array(np.full(n, tab)), pa.array(keys[:, tab].astype(np.int64) + (dim << 32)), part.column(0)]
                        cols += [pa.array(factor.astype(np.float32)), pa.array(step.astype(np.float32)), codes, smalls, blob(keys[:, :tab])]
                        yield pa.RecordBatch.from_arrays(cols, names=["label", "tab", "key", "node", "factor", "step", "code", "small", "keys"])

    entry = "label long, tab long, key long, node long, factor float, step float, code binary, small binary, keys binary"
    posted = classes.select("node", "label", "vec").mapInArrow(spread, entry)
    bucket = F.xxhash64("label", "tab", "key").alias("bucket")
    posted = ws.save(posted.select(bucket, "tab", "node", "factor", "step", "code", "small", "keys"), "posted")
    sizes = posted.groupBy("bucket").agg(F.count("*").alias("c")).where(F.col("c") > 1)
    placed = posted.join(sizes, "bucket").withColumn("blocks", F.ceil(F.col("c") / BLOCK).cast("long"))
    # a bucket of several blocks is compared pair of blocks by pair of blocks
    own = F.when(F.col("blocks") == 1, 0).otherwise(F.pmod(F.xxhash64("node", "tab"), F.col("blocks")))
    placed = placed.withColumn("own", own.cast("long")).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    names = ["bucket", "lo", "hi"]
    placed = placed.select("bucket", F.least("own", "with").alias("lo"), F.greatest("own", "with").alias("hi"), "own", "tab", "node", "factor", "step", "code", "small", "keys")
    placed = placed.repartition(*names).sortWithinPartitions(*names, "own")

    def sift(batches):
        for (bucket, lo, hi), t in _groups(batches):
            sides = [x for x in _sides(lo, hi, t) if x.num_rows]
            if len(sides) < 1 + (lo != hi):
                continue
            tab = t.column("tab")[0].as_py()
            a, b = _coded(sides[0]), _coded(sides[-1])
            i, j = _maybe(a, b, tab, cosine, lo == hi)
            some = [np.unique(np.concatenate([i, j]))] if lo == hi else [np.unique(i), np.unique(j)]
            for side, rows in zip(sides, some):
                if len(rows):
                    n = len(rows)
                    own, node = (side.column(c).take(pa.array(rows)).combine_chunks() for c in ("own", "node"))
                    yield pa.RecordBatch.from_arrays([*(pa.array(np.full(n, x)) for x in (bucket, lo, hi)), own, pa.array(np.full(n, tab)), node], names=[*names, "own", "tab", "node"])

    open_ = ws.save(placed.mapInArrow(sift, "bucket long, lo long, hi long, own long, tab long, node long"), "open")
    ws.drop(posted)
    dealt = open_.join(classes.select("node", "weight", "vec"), "node").select(*open_.columns, "weight", "vec").repartition(*names).sortWithinPartitions(*names, "own")

    def compare(batches):
        out = []
        for (_, lo, hi), t in _groups(batches):
            t = t.append_column("raw", blob_of(t.column("vec")))
            sides = [x for x in _sides(lo, hi, t) if x.num_rows]
            if len(sides) < 1 + (lo != hi):
                continue
            tab = t.column("tab")[0].as_py()
            got = [_whole(x, planes, tab) for x in sides]
            a, b = got[0], got[1] if lo != hi else None
            i, j = link_block(a, b, tab, cosine)
            if not len(i):
                continue
            weight = np.concatenate([x["weight"] for x in got])
            node = pa.concat_arrays([c for x in sides for c in x.column("node").chunks])
            j = j if b is None else j + len(a["weight"])
            links = np.bincount(i, weight[j], len(weight)) + np.bincount(j, weight[i], len(weight))
            root = _roots(len(weight), i, j)
            at = np.flatnonzero(links)
            out.append((node.take(pa.array(at)), node.take(pa.array(root[at])), pa.array(links[at].astype(np.int64))))
            if sum(len(x[0]) for x in out) > 50_000:
                yield _edges(out)
                out = []
        if out:
            yield _edges(out)

    def blob_of(column):
        return pa.array([np.asarray(v, dtype=np.float64).tobytes() for v in column.to_pylist()], pa.binary())

    met = ws.save(dealt.mapInArrow(compare, "node long, root long, links long"), "met")
    links = met.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(met.select(F.col("node").alias("u"), F.col("root").alias("v")), ws)
    named = classes.select(*hashes, "node", "rep", "weight").join(links, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "root").select(*hashes, (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    named = ws.save(named, "named")
    done = keyed.select("vec_id", *hashes).join(named, [*hashes]).select("vec_id", "n_links", "component_id")
    # rows that took no part: as many per id as the table has beyond the usable ones
    bad = rows.select("vec_id").groupBy("vec_id").agg(F.count("*").alias("c")).join(
        keyed.groupBy(F.col("vec_id").alias("g_id")).agg(F.count("*").alias("g")), F.col("vec_id") == F.col("g_id"), "left"
    ).withColumn("rest", F.col("c") - F.coalesce("g", F.lit(0))).where(F.col("rest") > 0)
    bad = bad.select("vec_id", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rest")))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = done.union(bad)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _edges(out) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.concat_arrays([x[k] for x in out]) for k in range(3)], names=["node", "root", "links"])


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least index of each index's component under the edges i-j."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new
