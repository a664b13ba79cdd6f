"""Mixing sources to target weights: hierarchical token budgets over a domain - language - source tree.

The budget goes down the tree by weight. A node whose subtree cannot supply its share (tokens times
``max_epochs``) gets what it has, and its shortage goes to its siblings in proportion to their
weights; a parent's capacity is that of its subtree, so an ancestor sees only what the siblings
could not take. Per family this is one water level: the largest of (budget - capacities before) /
(weights from here), in order of capacity per weight.

Each leaf then takes the prefix of that many tokens of its seeded epochs: every epoch is the leaf's
documents in the order of a seeded hash; whole epochs need no order, and the last one is cut by a
running sum over range partitions, so a source with a third of all rows is spread over many tasks.

Edge cases. Null or empty texts have no tokens and are never chosen. Null languages and sources form
leaves of their own; unlisted names have weight ``other``; a weight of 0 chooses nothing. Equal hashes
are ordered by ID and text hash. A table without tokens gives an empty result. Other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.scale import grouped_cumsum
from . import common

TREE = ("domain", "lang", "source")


@dataclass(frozen=True)
class Plan:
    """Target weights per level. The budget is ``share`` of all tokens. ``domains`` groups sources by their number."""

    share: float = 0.75
    max_epochs: int = 2
    seed: int = 7
    domain: dict = field(default_factory=lambda: {"d0": 0.4, "d1": 0.3, "d2": 0.2, "d3": 0.1})
    lang: dict = field(default_factory=lambda: {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1})
    source: dict = field(default_factory=dict)
    other: float = 1.0

    def weight(self, level: str) -> Column:
        out = F.lit(float(self.other))
        for name, w in sorted(getattr(self, level).items()):
            out = F.when(F.col(level) == name, F.lit(float(w))).otherwise(out)
        return out


def domain_of(source: Column) -> Column:
    """The table has no domain column: the source's number modulo 4 stands for one (none: d0)."""
    number = F.coalesce(F.regexp_extract(source, "([0-9]{1,9})$", 1), F.lit(""))
    return F.concat(F.lit("d"), F.when(number == "", 0).otherwise(number.cast("int") % 4).cast("string"))


def leaves_of(documents: DataFrame) -> DataFrame:
    """Slim rows: doc_id, text_key, domain, lang, source, tokens (words)."""
    text = common.text_or_empty()
    return documents.select(
        "doc_id", F.xxhash64(text).alias("text_key"), domain_of(F.col("source")).alias("domain"),
        F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens")).filter("tokens > 0")


def shared_out(nodes: DataFrame, parents: list[str], key: str, budget: str) -> DataFrame:
    """Adds ``given``: the part of ``budget`` (a column, equal in a family) of each child by water level."""
    w = Window.partitionBy(*(parents or [F.lit(0)]))
    up = w.orderBy(F.col("capacity") / F.col("weight"), key)
    level = nodes.filter("weight > 0").withColumn("__before", F.sum("capacity").over(up) - F.col("capacity"))
    level = level.withColumn("__weight", F.sum("weight").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    level = level.withColumn("__level", F.max((F.col(budget) - F.col("__before")) / F.col("__weight")).over(w))
    return level.withColumn("given", F.least("capacity", F.col("weight") * F.col("__level"))).drop("__before", "__weight", "__level")


def budgets(slim: DataFrame, plan: Plan) -> DataFrame:
    """Per leaf: domain, lang, source, leaf_tokens, budget (long). One row per source and language goes through the windows."""
    leaves = common.pinned(slim.groupBy(*TREE).agg(F.sum("tokens").alias("leaf_tokens")))
    given = leaves.agg((F.sum("leaf_tokens") * plan.share).cast("double").alias("given"))
    for depth, key in enumerate(TREE):
        parents = list(TREE[:depth])
        nodes = (leaves.groupBy(*TREE[:depth + 1])
                 .agg((F.sum("leaf_tokens") * plan.max_epochs).cast("double").alias("capacity"), F.sum("leaf_tokens").alias("leaf_tokens"))
                 .withColumn("weight", plan.weight(key)))
        above = given.withColumnRenamed("given", "__budget")
        nodes = nodes.join(above, parents) if parents else nodes.crossJoin(F.broadcast(above))  # one row
        given = shared_out(nodes, parents, key, "__budget").select(*TREE[:depth + 1], "given", "leaf_tokens")
        if depth + 1 < len(TREE):
            given = given.drop("leaf_tokens")
    return given.select(*TREE, "leaf_tokens", F.floor(F.col("given") + 1e-6).cast("long").alias("budget"))


def chosen(documents: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """Per chosen document and epoch: doc_id, text_key, domain, lang, source, epoch, tokens, taken.

    ``taken`` is the part of its tokens within the leaf's prefix; it is less than ``tokens`` for the
    document at the cut only.
    """
    slim = common.pinned(leaves_of(documents))  # words are counted once
    rows = slim.join(budgets(slim, plan).withColumnRenamed("leaf_tokens", "__all"), list(TREE))
    full = F.floor(F.col("budget") / F.col("__all")).cast("int")
    rows = rows.withColumn("__full", full).withColumn("__rest", F.col("budget") - F.col("__full") * F.col("__all"))
    order = F.md5(F.concat_ws(":", F.lit(str(plan.seed)), F.col("__full").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    summed = grouped_cumsum(rows.withColumn("__order", order), list(TREE), ["__order", "doc_id", "text_key"], "tokens", "__end")
    left = F.col("__rest") - (F.col("__end") - F.col("tokens"))
    epochs = F.col("__full") + F.when(left > 0, 1).otherwise(0)
    out = summed.filter(epochs > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), epochs - 1)))
    taken = F.when(F.col("epoch") < F.col("__full"), F.col("tokens")).otherwise(F.least("tokens", left))
    return out.select("doc_id", "text_key", *TREE, "epoch", "tokens", taken.alias("taken"))


def select(documents: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """The chosen documents, whole, once per epoch. Rows that share ID and text are chosen together."""
    times = (chosen(documents, plan).groupBy("doc_id", "text_key").agg((F.max("epoch") + 1).alias("times")))
    rows = common.keyed(documents).join(times.hint("shuffle_hash"), F.expr("id <=> doc_id and key = text_key"))
    if plan.max_epochs > 1:
        rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return rows.select("row.*")
