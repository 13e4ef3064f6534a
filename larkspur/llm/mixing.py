"""Mixing sources to target weights by hierarchical budgets (DataFrame operations only).

A token budget is handed down a tree of groups (domain, language, source).  Each
node shares what it gets among its children by weight, none above its capacity,
so a shortage is made up by siblings first; only what a whole subtree cannot
hold reaches the siblings of its parent.  A leaf's budget becomes whole epochs
over its documents plus a token prefix of one more epoch in seeded order.

All amounts are whole tokens; shares are rounded by largest remainder.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .workspace import Workspace, unused

WORDS = r"[^\x20\x09-\x0D]+"
#: Digits of the order key that form a bucket: 16**3 per leaf, whatever the leaf's size.
BUCKET_DIGITS = 3


@dataclass(frozen=True)
class Mix:
    """Parameters of a mixture.

    ``levels``: (name, column) from the root down; the last is the leaf's own.
    ``weights``: per level, child name -> whole weight (the default is 1; 0 shuts a child out).
    ``budget``: a fraction (numerator, denominator) of all tokens, or whole tokens.
    ``max_epochs`` bounds how often a document is taken; ``floor_epochs`` epochs of
    every leaf are set aside first, and weights divide the rest.
    """

    levels: Sequence[tuple[str, Column]]
    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    budget: tuple[int, int] | int = (1, 1)
    max_epochs: int = 4
    floor_epochs: int = 0
    seed: str = "0"


def _weight(names: dict[str, int], col: Column) -> Column:
    out = F.lit(1)
    for name, w in names.items():
        out = F.when(col == name, F.lit(int(w))).otherwise(out)
    return out.cast("long")


def _big(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def fill(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Divides each parent's ``budget`` among its children as ``given``.

    ``nodes`` has ``cap`` and ``weight`` per child and the parent's ``budget``;
    children whose share by weight would pass their cap get the cap, the others
    divide the rest by weight.
    """
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    ranked = group.orderBy(F.when(F.col("weight") > 0, F.col("cap").cast("double") / F.col("weight")).asc_nulls_last(), F.col(name))
    upto = ranked.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = ranked.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = F.sum("cap").over(upto) - F.col("cap")
    full = _big(F.col("cap")) * _big(F.sum("weight").over(onward)) <= _big(F.col("budget") - before) * _big(F.col("weight"))
    t = nodes.withColumn("full", full)
    t = t.withColumn("rest", F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(group), F.lit(0)))
    t = t.withColumn("open", F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(group), F.lit(0)))
    share = F.expr("CASE WHEN full OR open = 0 THEN 0 ELSE (CAST(rest AS DECIMAL(19,0)) * CAST(weight AS DECIMAL(19,0))) DIV open END")
    t = t.withColumn("share", share.cast("long"))
    over = F.when(~F.col("full"), _big(F.col("rest")) * _big(F.col("weight")) - _big(F.col("share")) * _big(F.col("open")))
    t = t.withColumn("left_over", F.col("rest") - F.sum("share").over(group))
    t = t.withColumn("turn", F.row_number().over(group.orderBy(over.desc_nulls_last(), F.col(name))))
    extra = F.when(~F.col("full") & (F.col("open") > 0) & (F.col("turn") <= F.col("left_over")), 1).otherwise(0)
    given = F.when(F.col("full"), F.col("cap")).otherwise(F.col("share") + extra)
    return t.withColumn("given", given.cast("long")).drop("full", "rest", "open", "share", "left_over", "turn")


def leaf_budgets(units: DataFrame, mix: Mix, ws: Workspace) -> DataFrame:
    """``levels..., avail, given, least`` of each leaf: its tokens, the tokens the mixture takes from it, and its epochs at least.

    Units are added up once, and every level is a query of its own: as one plan the
    levels repeat each other, and each of its stages has the driver plan all of it again.
    """
    names = [n for n, _ in mix.levels]
    leaves = units.groupBy(*names).agg(F.sum("n_tokens").alias("avail"))
    for n in names:
        leaves = leaves.withColumn(f"w_{n}", _weight(mix.weights.get(n, {}), F.col(n)))
    shut = F.greatest(*[(F.col(f"w_{n}") <= 0).cast("int") for n in names]) if len(names) > 1 else (F.col(f"w_{names[0]}") <= 0).cast("int")
    leaves = leaves.withColumn("least", F.when(shut == 1, 0).otherwise(mix.floor_epochs))
    leaves = leaves.withColumn("floor", F.col("avail") * F.col("least"))
    leaves = leaves.withColumn("cap", F.when(shut == 1, 0).otherwise(F.col("avail") * (mix.max_epochs - mix.floor_epochs)))
    leaves = ws.save(leaves, "groups")
    total = leaves.agg(F.coalesce(F.sum("avail"), F.lit(0)), F.coalesce(F.sum("floor"), F.lit(0)), F.coalesce(F.sum("cap"), F.lit(0))).first()
    budget = mix.budget if isinstance(mix.budget, int) else total[0] * mix.budget[0] // mix.budget[1]
    budget = max(0, min(budget - total[1], total[2]))
    above = None
    for depth, n in enumerate(names):
        path = names[: depth + 1]
        nodes = leaves.groupBy(*path).agg(F.sum("cap").alias("cap"), F.max(f"w_{n}").alias("weight"))
        nodes = nodes.withColumn("budget", F.lit(budget).cast("long")) if above is None else nodes.join(above, path[:-1])
        above = ws.save(fill(nodes, path[:-1], n).select(*path, F.col("given").alias("budget")), f"level-{depth}")
    return leaves.join(above, names).select(*names, "avail", (F.col("floor") + F.col("budget")).alias("given"), "least")


def units_of(docs: DataFrame, mix: Mix) -> DataFrame:
    """``doc_id, levels..., n_tokens``: rows that share doc_id and leaf count as one unit.

    A null group name counts as the empty name, a null text as no tokens.
    """
    named = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in mix.levels],
        F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("n_tokens"),
    )
    return named.groupBy("doc_id", *[n for n, _ in mix.levels]).agg(F.sum("n_tokens").alias("n_tokens"))


def plan(docs: DataFrame, mix: Mix) -> DataFrame:
    """One row per unit: ``doc_id, levels..., n_tokens, epochs, prefix_tokens, copies``.

    ``epochs`` counts whole epochs, ``prefix_tokens`` the unit's tokens within the
    prefix of the epoch after those, ``copies`` how often the unit is taken (the
    unit that the prefix ends in counts).  Units without tokens are taken where
    the prefix passes them; a leaf without any tokens has ``floor_epochs`` epochs.  An empty table gives no rows.
    """
    names = [n for n, _ in mix.levels]
    ws = Workspace(docs.sparkSession, "mixing")
    units = ws.save(units_of(docs, mix), "units")
    leaves = leaf_budgets(units, mix, ws)
    leaves = leaves.withColumn("epochs", F.expr("CASE WHEN avail = 0 THEN least ELSE given DIV avail END").cast("long"))
    leaves = ws.save(leaves.withColumn("prefix", F.col("given") - F.col("epochs") * F.col("avail")).select(*names, "epochs", "prefix"), "leaves")

    key = F.md5(F.concat_ws(":", F.lit(mix.seed), F.col("epochs").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    placed = units.join(leaves, names).withColumn("order_key", key).withColumn("bucket", F.substring("order_key", 1, BUCKET_DIGITS))
    # prefix sums in two steps: over a leaf's buckets, then inside the one bucket that the prefix ends in
    sums = placed.groupBy(*names, "bucket").agg(F.sum("n_tokens").alias("in_bucket"))
    run = Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = ws.save(sums.withColumn("start", F.sum("in_bucket").over(run) - F.col("in_bucket")), "buckets")
    t = placed.join(sums, [*names, "bucket"])
    cut = (F.col("start") < F.col("prefix")) & (F.col("start") + F.col("in_bucket") > F.col("prefix"))
    whole = t.where(~cut).withColumn("first", F.when(F.col("start") < F.col("prefix"), F.col("start")))
    whole = whole.select("doc_id", *names, "n_tokens", "epochs", F.when(F.col("first").isNotNull(), F.col("n_tokens")).otherwise(0).alias("prefix_tokens"), F.col("first").isNotNull().alias("in_prefix"))
    inner = Window.partitionBy(*names, "bucket").orderBy("order_key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    part = t.where(cut).withColumn("at", F.col("start") + F.sum("n_tokens").over(inner) - F.col("n_tokens"))
    part = part.select(
        "doc_id", *names, "n_tokens", "epochs",
        F.greatest(F.lit(0), F.least(F.col("n_tokens"), F.col("prefix") - F.col("at"))).alias("prefix_tokens"),
        (F.col("at") < F.col("prefix")).alias("in_prefix"),
    )
    out = whole.unionByName(part)
    return out.select(
        "doc_id", *names, "n_tokens", "epochs",
        F.col("prefix_tokens").cast("long").alias("prefix_tokens"),
        (F.col("epochs") + F.col("in_prefix").cast("long")).alias("copies"),
    )


def apply(docs: DataFrame, mix: Mix) -> DataFrame:
    """``docs`` with every row as often as the mixture takes its unit; same columns, whatever their names."""
    names = [n for n, _ in mix.levels]
    m_id, m_copies, m_copy, *m_names = unused(docs, "m_id", "m_copies", "m_copy", *[f"m_{n}" for n in names])
    chosen = plan(docs, mix).where(F.col("copies") > 0)
    chosen = chosen.select(F.col("doc_id").alias(m_id), F.col("copies").alias(m_copies), *[F.col(n).alias(m) for n, m in zip(names, m_names)])
    on = docs["doc_id"].cast("long").eqNullSafe(F.col(m_id))
    for (_, c), m in zip(mix.levels, m_names):
        on = on & (F.coalesce(c.cast("string"), F.lit("")) == F.col(m))
    taken = docs.join(chosen.hint("shuffle_hash"), on)
    return taken.withColumn(m_copy, F.explode(F.sequence(F.lit(1), F.col(m_copies)))).drop(m_id, m_copies, m_copy, *m_names)
