"""Approximate nearest neighbours with a permutation index.

A vector is represented by its nearest pivots in order.  The index deals all
vectors into blocks by hash; a block is one row with its inverted files, one per
pivot, of the vectors that have the pivot and its place in their order.  A query
adds up the files of its own pivots, which ranks the block by Spearman's footrule
distance between orders.  The best of the block are reranked by exact distance,
with all that tie with the last of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .vectors import matrix, usable
from .workspace import Workspace

#: Pivots, and the bounded sample of rows (those with the least hashed id) that they are chosen from.
PIVOTS = 256
SAMPLE = 1024
#: A vector is posted for one in so many pivots.
POSTED = 4
#: Expected vectors of a block, and the share of a block that is reranked (ties come on top), at least RERANK_LEAST of it.
BLOCK = 8192
RERANK = 0.25
RERANK_LEAST = 200
#: Queries are sent to the executors in blocks of so many bytes of vectors.
QUERY_BYTES = 8 << 20


def orders(x: np.ndarray, pivots: np.ndarray, m: int) -> np.ndarray:
    """Each row's m nearest pivots, nearest first, ties to the lower pivot."""
    size = max(np.abs(x).max(initial=0.0), np.abs(pivots).max(initial=0.0))
    if size > 1e100:  # squares would be infinite
        x, pivots = x / size, pivots / size
    d = (pivots * pivots).sum(axis=1) - 2.0 * (x @ pivots.T)
    return np.argsort(d, axis=1, kind="stable")[:, :m].astype(np.int16)


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distance of each row of x from q, finite and above 0 wherever doubles can hold it."""
    gap = x - q
    most = np.abs(gap).max(axis=1, initial=0.0)
    d = np.sqrt((gap * gap).sum(axis=1))
    odd = np.flatnonzero((most > 1e140) | (most < 1e-140) & (most > 0))
    if len(odd):
        d[odd] = most[odd] * np.sqrt(((gap[odd] / most[odd, None]) ** 2).sum(axis=1))
    return d


def spaced(x: np.ndarray, most: int) -> np.ndarray:
    """The first rows that are not next to an earlier one: a group of near copies gives one pivot."""
    unit = x / max(np.abs(x).max(), 1e-300)
    d = np.sqrt(np.maximum(0, (unit * unit).sum(1)[:, None] + (unit * unit).sum(1)[None] - 2 * unit @ unit.T))
    near = np.median(d) / 2
    kept: list[int] = []
    for i in range(len(x)):
        if len(kept) == most:
            break
        if not kept or d[i, kept].min() > near:
            kept.append(i)
    return x[kept]


class PivotFiles:
    """The inverted files of one block of vectors: rows and places of each pivot, one pivot after the other."""

    def __init__(self, n: int, m: int, ends: np.ndarray, rows: np.ndarray, places: np.ndarray):
        self.n, self.m, self.ends, self.rows, self.places = n, m, ends, rows, places

    @staticmethod
    def of(order: np.ndarray, pivots: int) -> PivotFiles:
        n, m = order.shape
        flat = order.reshape(-1)
        at = np.argsort(flat, kind="stable")
        return PivotFiles(n, m, np.searchsorted(flat[at], np.arange(pivots + 1)), (at // m).astype(np.int32), (at % m).astype(np.int16))

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Footrule distance of every row's order to a query's; absent pivots are at place m."""
        gain = np.zeros(self.n, dtype=np.int32)
        for place, p in enumerate(order.tolist()):
            a, b = self.ends[p], self.ends[p + 1]
            gain[self.rows[a:b]] += self.m - np.maximum(self.places[a:b], place)
        return self.m * (self.m + 1) - 2 * gain


INDEX = "block long, ids binary, vecs binary, ends binary, rows binary, places binary"


def build(rows: DataFrame, ws: Workspace, pivots: int = PIVOTS) -> tuple[DataFrame, np.ndarray]:
    """The index of all ``rows(vec_id, vec)``, vectors of one length, as a saved table of blocks, and the pivots."""
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "vec").limit(SAMPLE).toPandas()  # at most SAMPLE rows
    p = spaced(np.array(drawn["vec"].tolist(), dtype=np.float64), pivots)
    m = max(1, len(p) // POSTED)
    blocks = max(1, -(-rows.count() // BLOCK))

    def post(table):
        t = table.combine_chunks()
        x = matrix(t.column("vec").chunk(0))
        f = PivotFiles.of(orders(x, p, m), len(p))
        parts = (t.column("vec_id").to_numpy(), x, f.ends.astype(np.int64), f.rows, f.places)
        return pa.table({"block": t.column("block")[:1]} | {n: pa.array([a.tobytes()], pa.binary()) for n, a in zip(("ids", "vecs", "ends", "rows", "places"), parts)})

    dealt = rows.select("vec_id", "vec", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(blocks)).alias("block"))
    return ws.save(dealt.groupBy("block").applyInArrow(post, INDEX), "index"), p


def _opened(row: dict, m: int) -> tuple[np.ndarray, np.ndarray, PivotFiles]:
    ids = np.frombuffer(row["ids"], dtype=np.int64)
    x = np.frombuffer(row["vecs"]).reshape(len(ids), -1)
    kinds = (("ends", np.int64), ("rows", np.int32), ("places", np.int16))
    return ids, x, PivotFiles(len(ids), m, *(np.frombuffer(row[c], dtype=k) for c, k in kinds))


def search(vectors: DataFrame, is_query, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of every query among all other rows.

    ``vectors(vec_id, embedding)``; ``is_query`` is a condition on ``vec_id``.  Score is
    Euclidean distance of the original vectors, ties go to the smaller vec_id.
    Rows with a null vec_id, or with vectors that are null, empty, zero or not
    finite take no part.  Vectors of each length are searched among those of that
    length.  Of rows that repeat a queried vec_id one is the query (the shortest,
    then the least vector), and none is its own neighbour.  Components may be as
    large or small as doubles go.  An empty table gives no rows; fewer rows than
    k give all of them.
    """
    spark = vectors.sparkSession
    final = "query_id long, rank int, vec_id long, score double"
    ws = Workspace(spark, "ann")
    rows = usable(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(F.col("vec_id").isNotNull()))
    rows = ws.save(rows.withColumn("size", F.size("vec")), "vectors")
    lengths = sorted(r["size"] for r in rows.select("size").distinct().collect())  # a number a length
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min(F.struct("size", "vec")).alias("v")).select("vec_id", "v.size", "v.vec")
    asked = ws.save(asked, "queries")
    found = [f for n in lengths for f in _found(rows.where(F.col("size") == n), asked.where(F.col("size") == n), n, k, ws)]
    if not found:
        return spark.createDataFrame([], final)
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _found(rows: DataFrame, asked: DataFrame, length: int, k: int, ws: Workspace) -> list[DataFrame]:
    """``query_id, vec_id, score`` of the k best of each block, a table for each lot of queries."""
    n = asked.count()
    if not n:
        return []
    index, p = build(rows, ws)
    m = max(1, len(p) // POSTED)
    # a bounded number of bytes of queries travels at a time, whatever their total
    parts = max(1, -(-n * length * 8 // QUERY_BYTES))
    found = []
    for part in range(parts):
        q = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == part).orderBy("vec_id").toPandas()
        if not len(q):
            continue
        ids, vecs = q["vec_id"].to_numpy(dtype=np.int64), np.array(q["vec"].tolist(), dtype=np.float64)
        shared = ws.spark.sparkContext.broadcast((ids, vecs, orders(vecs, p, m)))

        def look(batches, shared=shared):
            ids, vecs, near = shared.value
            for b, at in ((b, i) for b in batches for i in range(b.num_rows)):
                own, x, files = _opened(b.slice(at, 1).to_pylist()[0], m)
                take = max(RERANK_LEAST, int(np.ceil(len(own) * RERANK)))
                query, vec, score = [], [], []
                for i in range(len(ids)):
                    far = files.footrule(near[i])
                    at = np.flatnonzero(far <= np.partition(far, take - 1)[take - 1]) if take < len(own) else np.arange(len(own))
                    at = at[own[at] != ids[i]]
                    d, v = distances(x[at], vecs[i]), own[at]
                    if len(d) > k:
                        near_ = d <= np.partition(d, k - 1)[k - 1]
                        d, v = d[near_], v[near_]
                    s = np.lexsort((v, d))[:k]
                    query.append(np.full(len(s), ids[i]))
                    vec.append(v[s])
                    score.append(d[s])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (query, vec, score)], names=["query_id", "vec_id", "score"])

        found.append(ws.save(index.mapInArrow(look, "query_id long, vec_id long, score double"), "found"))
        shared.destroy()
    return found
