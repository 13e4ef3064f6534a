"""Toxicity scores from averaged subword embeddings and a linear softmax.

A text is the bag of the 3- to 6-character n-grams of its bracketed words; each
n-gram is hashed to a row of an embedding table, rows are averaged, and a linear
softmax over two classes is trained jointly with the table.  A misspelt word
that was never seen shares most n-grams with the word it stands for.

The labelled sample is drawn by Spark and fitted in one task on an executor; only
the per-bucket log-odds that embeddings and softmax come to reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .textkernel import mix
from .workspace import text_slices

SIZES = (3, 4, 5, 6)
BUCKET_BITS = 18
DIM = 4
#: Neutral n-grams that every average holds besides the text's own, so that few words do not decide alone.
PRIOR = 400

_LESS, _MORE = ord("<"), ord(">")
_rng = np.random.Generator(np.random.PCG64(0x70C5))
_LANE = _rng.integers(1, 1 << 62, size=8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass(frozen=True)
class Sample:
    """Bounds of the labelled sample that is fitted on.  Scoring knows no such bounds.

    Rows of either class, characters of a row, and characters of each class in all
    (a class's first row is taken whatever its length).
    """

    toxic: int = 2500
    clean: int = 3500
    chars: int = 65_536
    total: int = 12_000_000


def ngram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of every text in order, and each text's bounds (n + 1).

    Words are runs of letters and digits (and everything from U+00C0 on but general
    punctuation and the ideographic space) in lower case.
    """
    texts = [t.lower() for t in texts]
    code = np.frombuffer("".join([" " + t + " \n" for t in texts]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ascii_word = (code - 48 < 10) | (code - 97 < 26)
    word = ascii_word | (code >= 0xC0) & ~((code >= 0x2000) & (code < 0x2070)) & (code != 0x3000)
    # a bracket on either side of each run: what stands before and after it is never a word character
    before, after = np.flatnonzero(word[1:] & ~word[:-1]), np.flatnonzero(word[:-1] & ~word[1:]) + 1
    # runs one apart would share a bracket cell, so the text is laid out anew with two cells between runs
    size = after - before + 1
    first = np.cumsum(size) - size
    total = int(size.sum())
    inside = np.arange(total) - np.repeat(first, size)
    flat = code[np.repeat(before, size) + inside].astype(np.uint64)
    flat[first] = _LESS
    flat[first + size - 1] = _MORE
    left = np.repeat(size, size) - inside  # cells from here to the end of the word
    # only the newlines that were put between texts end a text
    ends = np.cumsum([len(t) + 3 for t in texts]) - 1
    own = np.repeat(np.searchsorted(ends, before), size)
    h = np.zeros(total, dtype=np.uint64)
    keys, owners = [], []
    for n in range(1, SIZES[-1] + 1):
        step = flat[n - 1 :]
        h = h[: len(step)] * _LANE[0] + (step ^ _LANE[1]) * _LANE[2]
        if n in SIZES:
            ok = left[: len(step)] >= n
            keys.append((mix(h[ok] + np.uint64(n)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
            owners.append(own[: len(step)][ok])
    keys, owners = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return keys[order], np.searchsorted(owners[order], np.arange(len(texts) + 1))


class SubwordSoftmax:
    """The classifier: an embedding table and a softmax layer, trained together in numpy."""

    def __init__(self, seed: int = 11):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.table = rng.uniform(-0.01, 0.01, (1 << BUCKET_BITS, DIM)).astype(np.float32)
        self.weight = rng.uniform(-1, 1, (DIM, 2)).astype(np.float32)
        self.bias = np.zeros(2, dtype=np.float32)

    def gradients(self, keys: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the mean cross-entropy of a batch: by bucket, by softmax weight, by bias.

        The gradient of a bucket's embedding is its number in the first array times
        the difference of the two columns of weights, as there are two classes.
        """
        odds = self.table @ (self.weight[:, 1] - self.weight[:, 0])
        at = np.concatenate([[0], np.cumsum(sizes)])
        run = np.concatenate([[0.0], np.cumsum(odds[keys], dtype=np.float64)])
        z = (run[at[1:]] - run[at[:-1]]) / (sizes + PRIOR) + self.bias[1] - self.bias[0]
        err = (1 / (1 + np.exp(-z)) - y) / len(y)
        bucket = np.bincount(keys, np.repeat(err / (sizes + PRIOR), sizes), len(self.table)).astype(np.float32)
        along = self.table.T @ bucket
        return bucket, np.stack([-along, along], axis=1), np.array([-err.sum(), err.sum()], dtype=np.float32)

    def fit(self, texts: list[str], labels: list[int], epochs: int = 10, steps: int = 1500, batch: int = 64, rate: float = 0.8, seed: int = 5) -> SubwordSoftmax:
        """Minimises cross-entropy by mini-batches with a step size per n-gram.

        A small sample is passed over more often, until ``steps`` batches are done.
        """
        feats = []
        for lo in range(0, len(texts), 64):
            keys, at = ngram_buckets(texts[lo : lo + 64])
            feats += [keys[a:b] for a, b in zip(at[:-1], at[1:])]
        y = np.array(labels, dtype=np.float64)
        rng = np.random.Generator(np.random.PCG64(seed))
        g_rows = np.full(len(self.table), 1e-8, dtype=np.float32)
        g_weight, g_bias = np.full_like(self.weight, 1e-8), np.full_like(self.bias, 1e-8)
        for _ in range(max(epochs, -(-steps * batch // max(1, len(feats))))):
            order = rng.permutation(len(feats))
            for lo in range(0, len(order), batch):
                rows = order[lo : lo + batch]
                sizes = np.array([len(feats[r]) for r in rows])
                bucket, dw, db = self.gradients(np.concatenate([feats[r] for r in rows]), sizes, y[rows])
                across = self.weight[:, 1] - self.weight[:, 0]
                # one step size for the whole table: n-grams that many texts of a class share move,
                # those that a text has by chance hardly do
                g_rows += bucket * bucket * float((across * across).mean())
                self.table -= (rate * bucket / np.sqrt(g_rows))[:, None] * across
                g_weight += dw * dw
                g_bias += db * db
                self.weight -= 0.1 * dw / np.sqrt(g_weight)
                self.bias -= 0.1 * db / np.sqrt(g_bias)
        return self

    def collapsed(self) -> tuple[np.ndarray, float]:
        """Per-bucket log-odds and the constant: what averaging and the softmax come to for two classes."""
        return self.table @ (self.weight[:, 1] - self.weight[:, 0]), float(self.bias[1] - self.bias[0])


@dataclass(frozen=True)
class Model:
    """A fitted classifier as scoring needs it: log-odds of each bucket and the constant."""

    odds: np.ndarray
    const: float

    @staticmethod
    def always(toxic: bool) -> Model:
        return Model(np.zeros(1 << BUCKET_BITS, dtype=np.float32), 20.0 if toxic else -20.0)

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Score of each text; null counts as empty, and an empty text has the score of the constant alone."""
        keys, at = ngram_buckets([t or "" for t in texts])
        total = np.concatenate([[0.0], np.cumsum(self.odds[keys], dtype=np.float64)])
        z = (total[at[1:]] - total[at[:-1]]) / (at[1:] - at[:-1] + PRIOR) + self.const
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def held_out(folds: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, sample: Sample = Sample()) -> Model:
    """Fits the classifier on a bounded sample of labelled rows outside fold 0.

    A doc_id with several labels has the largest of them; null labels and labels
    of no document are left out.  The sample takes the rows of each class whose
    hashed doc_id is least; the class shares of all training labels set the prior.
    With one class only, every text scores on that class's side of 0.5, without
    any label on the clean side.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(folds))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return Model.always(1 in n)
    # as many rows again are drawn, since some are too long or have no document
    hashed = F.xxhash64("doc_id")
    drawn = [known.where(F.col("toxic") == c).orderBy(hashed, "doc_id").limit(2 * most) for c, most in ((1, sample.toxic), (0, sample.clean))]
    short = docs.where((F.length("text") <= sample.chars) & F.col("text").isNotNull()).select("doc_id", "text")
    rows = short.join(F.broadcast(drawn[0].unionByName(drawn[1])), "doc_id")  # at most 2 * (toxic + clean) keys
    picks = rows.where(F.col("toxic") == 1).orderBy(hashed, "doc_id", "text").limit(sample.toxic).unionByName(
        rows.where(F.col("toxic") == 0).orderBy(hashed, "doc_id", "text").limit(sample.clean)
    )
    before = Window.partitionBy("toxic").orderBy(hashed, "doc_id", "text").rowsBetween(Window.unboundedPreceding, -1)
    picks = picks.withColumn("before", F.coalesce(F.sum(F.length("text")).over(before), F.lit(0)))
    picks = picks.where((F.col("before") == 0) | (F.col("before") + F.length("text") <= sample.total)).select("text", "toxic", "doc_id")

    def train(batches):
        texts, y = [], []
        for b in batches:
            texts += b.column(0).to_pylist()
            y += b.column(1).to_pylist()
        if not 0 < sum(y) < len(y):
            const = 20.0 if sum(y) else -20.0
            yield pa.RecordBatch.from_pylist([{"odds": None, "const": const}], schema=out)
            return
        odds, const = SubwordSoftmax().fit(texts, y).collapsed()
        const += float(np.log(n[1] / n[0]) - np.log(sum(y) / (len(y) - sum(y))))
        yield pa.RecordBatch.from_pylist([{"odds": odds.astype("<f4").tobytes(), "const": const}], schema=out)

    out = pa.schema([("odds", pa.binary()), ("const", pa.float64())])
    # one task holds the whole sample, whose rows and characters are bounded
    got = picks.repartition(1).sortWithinPartitions("doc_id", "text").mapInArrow(train, "odds binary, const double").first()
    if got is None or got["odds"] is None:
        return Model.always(got is not None and got["const"] > 0)
    return Model(np.frombuffer(got["odds"], dtype="<f4"), got["const"])


def score(docs: DataFrame, model: Model, into: str = "toxicity") -> DataFrame:
    """``docs`` with a column ``into``: 0 to 1, higher where label 1 is likelier.

    Every row stays, with all its columns; only ``text`` is looked at.  A null
    text counts as empty, and an empty text has the score of the bias alone.
    Refuses a table that has a column of the name ``into`` already.
    """
    names = docs.columns
    if into in names:
        raise ValueError(f"the table has a column {into!r} already; choose another name for the score")
    ti = names.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**18 floats

    def run(batches):
        for b in text_slices(batches, 1 << 20):
            s = shared.value.score(b.column(ti).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], names=[*names, into])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(into, DoubleType())]))


def keep_clean(docs: DataFrame, model: Model, toxic: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``toxic``, whatever columns there are."""
    ti = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in text_slices(batches, 1 << 20):
            yield b.filter(pa.array(shared.value.score(b.column(ti).to_pylist()) < toxic))

    return docs.mapInArrow(run, docs.schema)
