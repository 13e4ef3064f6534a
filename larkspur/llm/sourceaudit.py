"""How a source's words differ from those of other sources of its language, in exact integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import termcounts
from .textkernel import utf8_parts
from .workspace import Workspace, text_slices

#: Documents of a language that a term must be in.
LEAST_DOCS = 3
SCALE_STEPS, STEP = 3, 1000  # a probability is a share of STEP ** SCALE_STEPS
TOP = 200
#: Terms that meet in one group, on average.
AT_ONCE = 20_000
#: Cells of a table of terms and sources that is worked on at a time.
CELLS = 1 << 20


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` by slice of ``docs(text, lang, source)``; each group also has a row with an empty term."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])

    def run(batches):
        for b in text_slices(batches, 16 << 20):
            raw, offsets = utf8_parts(b.column(0))
            pair = pa.StructArray.from_arrays([b.column(1), b.column(2)], ["lang", "source"])
            index: dict = {}
            groups = np.array([index.setdefault((x["lang"], x["source"]), len(index)) for x in pair.to_pylist()])
            lang, source = (pa.array([k[i] for k in index], pa.string()) for i in range(2))
            none = pa.array(np.zeros(len(index), dtype=np.int64))
            yield pa.RecordBatch.from_arrays([lang, source, pa.array([b""] * len(index), pa.binary()), none, none], schema=schema)
            for terms, group, n, docs in termcounts.count(raw, offsets, groups):
                g = pa.array(group)
                yield pa.RecordBatch.from_arrays([lang.take(g), source.take(g), pa.array(terms, pa.binary()), pa.array(n), pa.array(docs)], schema=schema)

    return docs.mapInArrow(run, "lang string, source string, term binary, n long, docs long")


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(STEP ** SCALE_STEPS * (count + 1) / total)`` by long division, exact for counts below 9e15."""
    rest, out = count + 1, np.zeros(np.broadcast(count, total).shape, dtype=np.int64)
    for _ in range(SCALE_STEPS):
        rest = rest * STEP
        digit = rest // total
        out = out * STEP + digit
        rest = rest - digit * total
    return out + 1


def _compare(key, terms: pa.Table, sources: pa.Table) -> pa.Table:
    """Sums of one share of a language's terms for all pairs of its sources, and each source's most typical terms among them."""
    sources = sources.sort_by("source")
    names, total, v = sources["source"].combine_chunks(), sources["total"].to_numpy(), int(sources["v"][0].as_py())
    s, lang = len(names), key[0].as_py()
    where = {x: i for i, x in enumerate(names.to_pylist())}
    acc, found = np.zeros((s, s), dtype=np.int64), []
    if len(terms):
        terms = terms.combine_chunks()
        by = terms["by"].combine_chunks() if isinstance(terms["by"], pa.ChunkedArray) else terms["by"]
        by = by if isinstance(by, pa.ListArray) else by.chunk(0)
        row = np.repeat(np.arange(len(by)), np.diff(by.offsets.to_numpy()))
        entry = by.flatten()
        at, n = np.array([where[x] for x in entry.field(0).to_pylist()], dtype=np.int64), entry.field(1).to_numpy()
        whole = terms["n"].to_numpy()
        step = max(1, CELLS // s)
        for a in range(0, len(by), step):
            b = min(len(by), a + step)
            lo, hi = np.searchsorted(row, [a, b])
            table = np.zeros((b - a, s), dtype=np.int64)
            table[row[lo:hi] - a, at[lo:hi]] = n[lo:hi]
            p = share(table, (total + v)[None, :])
            for g in range(s):
                d = p[:, g : g + 1] - p
                acc[g] += (d * d // p).sum(axis=0)
            q = share(whole[a:b], np.int64(total.sum() + v))[:, None]
            t, g = np.nonzero((table > 0) & (p > q))
            d = p[t, g] - q[t, 0]
            found.append((t + a, g, d * d // q[t, 0]))
    one, two = np.nonzero(~np.eye(s, dtype=bool))
    columns = [[names.take(pa.array(one)), pa.array(["pair"] * len(one), pa.string()), names.take(pa.array(two)), pa.array(acc[one, two])]]
    if found:
        t, g, value = (np.concatenate(x) for x in zip(*found))
        order = np.empty(len(terms), dtype=np.int64)
        order[pc.sort_indices(terms["term"]).to_numpy()] = np.arange(len(terms))
        by = np.lexsort((order[t], -value, g))
        t, g, value = t[by], g[by], value[by]
        new = np.concatenate([[True], g[1:] != g[:-1]]) if len(g) else np.zeros(0, dtype=bool)
        place = np.arange(len(g)) - np.maximum.accumulate(np.where(new, np.arange(len(g)), 0))
        t, g, value = t[place < TOP], g[place < TOP], value[place < TOP]
        item = terms["term"].cast(pa.string()).combine_chunks().take(pa.array(t))
        columns.append([names.take(pa.array(g)), pa.array(["term"] * len(t), pa.string()), item, pa.array(value)])
    tables = [pa.table([pa.array([lang] * len(c[0]), pa.string()), *c], names=["lang", "source", "part", "item", "value"]) for c in columns]
    return pa.concat_tables(tables)


def audit(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (lang, source) of ``docs(text, lang, source)``.

    A language keeps the terms that are in at least ``LEAST_DOCS`` of its documents
    (rows; V of them).  A source gives a term with c occurrences the share p = 1 +
    floor(10^9 (c + 1) / (N + V)), N of all its kept terms.  ``pair``: for each other
    source, with share q, the sum of floor((p - q)^2 / q) over all kept terms; ``term``:
    the ``TOP`` terms of the source that it uses more than its language, by the same
    value against the language's share.  Ranks are by falling value, then by item.
    Null texts, languages and sources are empty ones; repeated rows count; sources
    without terms have their pairs, a language of one source has none; an empty table
    gives no rows; other columns are not read.

    The result has a row for each pair of sources of a language, so one language's
    sources are few beside its terms; terms are dealt by hash, whatever language has
    most of them, and a group's sums are added up afterwards.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "sourceaudit")
    rows = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")])
    # one exchange: what a source has of a term, then what a language has
    counts = term_counts(rows).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    per = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("by"))
    kept = ws.save(per.where((F.col("docs") >= LEAST_DOCS) | (F.octet_length("term") == 0)), "kept")

    is_term = F.octet_length("term") > 0
    totals = kept.select("lang", F.inline("by")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    size = kept.groupBy("lang").agg(F.count_if(is_term).alias("v")).withColumnRenamed("lang", "v_lang")
    totals = totals.join(size, totals["lang"] == size["v_lang"]).select("lang", "source", "total", "v")
    deals = max(int(spark.conf.get("spark.sql.shuffle.partitions")), kept.count() // AT_ONCE)
    deal = F.pmod(F.xxhash64("term"), F.lit(deals)).cast("int").alias("deal")
    terms = kept.where(is_term).select("lang", deal, "term", "n", "by")
    totals = totals.select(F.col("lang").alias("t_lang"), "source", "total", "v", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))).alias("t_deal"))

    def run(key, left, right):
        return _compare(key, left, right)

    found = terms.groupBy("lang", "deal").cogroup(totals.groupBy("t_lang", "t_deal")).applyInArrow(run, "lang string, source string, part string, item string, value long")
    found = ws.save(found, "found")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    pairs = found.where(F.col("part") == "pair").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    # a term is in one deal: tasks leave out what is beyond the top before rows meet
    terms = found.where(F.col("part") == "term").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
    return pairs.unionByName(terms)
