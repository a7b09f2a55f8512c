"""Mixing sources to target weights, in DataFrame functions.

A tree of domain, language and source carries weights. The token budget is
passed from the root to the leaves in proportion to the weights of siblings; a
node can take no more than its documents give in ``max_epochs`` epochs, and
what it can't take goes to its siblings, in proportion to their weights, before
it goes to the siblings of its ancestors. A leaf then gets whole epochs and the
beginning of one more: its documents in the order of a seeded hash of epoch and
id, as long as their tokens fit.

The prefix of a leaf of any size is found without sorting the leaf: sums over
65,536 ranges of the hash give the range in which the budget ends, and only the
documents of that range are put in order.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` unless a column is named.

Defined cases: a null text has no tokens and costs nothing; null domains,
languages and sources count as the empty name; names without a weight have
weight ``default_weight``; a weight of 0 takes nothing; rows that share an id
are chosen together; a null id hashes as the empty text; an empty table gives
an empty result. Input columns named like the helper columns stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialtone.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
LEVELS = ("domain", "lang", "source")
RANGE_DIGITS = 4


@dataclass(frozen=True)
class Weights:
    """Weights by name at each level, the same below every parent."""

    domain: dict[str, int] = field(default_factory=dict)
    lang: dict[str, int] = field(default_factory=dict)
    source: dict[str, int] = field(default_factory=dict)
    default_weight: int = 1

    def of(self, level: str) -> Column:
        out = F.lit(float(self.default_weight))
        for name, weight in getattr(self, level).items():
            out = F.when(F.col(level) == F.lit(name), F.lit(float(weight))).otherwise(out)
        return out


def count_tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _share(nodes: DataFrame, parents: list[str]) -> DataFrame:
    """Pass ``amount`` of each parent to its children (weight, capacity): adds ``given``.

    Children in the order of capacity / weight: a child is full if its part of
    what the ones before leave reaches its capacity; the others share the rest by weight.
    """
    by = Window.partitionBy(*parents)
    names = [c for c in LEVELS if c in nodes.columns and c not in parents]
    order = by.orderBy("ratio", *names)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    live = nodes.where((F.col("weight") > 0) & (F.col("capacity") > 0)).withColumn(
        "ratio", F.col("capacity") / F.col("weight"))
    level = (F.col("amount") - F.coalesce(F.sum("capacity").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    marked = live.withColumn("level", level).withColumn("full", F.col("ratio") <= F.col("level"))
    first_open = F.min(F.when(~F.col("full"), F.struct("ratio", *names, "level")))
    shared = marked.withColumn("open", first_open.over(by))
    return shared.withColumn("given", F.when(F.col("full"), F.col("capacity"))
                             .otherwise(F.col("open.level") * F.col("weight"))).drop("ratio", "level", "full", "open")


def leaf_targets(leaves: DataFrame, weights: Weights, budget_share: float, max_epochs: int) -> DataFrame:
    """(domain, lang, source, tokens, target) of leaves given as (domain, lang, source, tokens).

    The budget is ``budget_share`` of all tokens. Works on one row a leaf.
    """
    wanted = reduce(Column.__and__, [weights.of(level) > 0 for level in LEVELS])
    capacity = F.when(wanted, F.col("tokens") * max_epochs).otherwise(0).cast("double")
    nodes = leaves.withColumn("capacity", capacity).withColumn("all", F.lit(1))
    root = nodes.groupBy("all").agg(F.floor(F.sum("tokens") * F.lit(budget_share)).cast("double").alias("budget"))
    given = None
    for depth in range(len(LEVELS)):
        parents, level = list(LEVELS[:depth]), LEVELS[depth]
        own = (nodes.groupBy("all", *parents, level).agg(F.sum("capacity").alias("capacity"))
               .withColumn("weight", weights.of(level)))
        if given is None:
            own = own.join(root, "all").withColumn("amount", F.col("budget")).drop("budget")
        else:
            own = own.join(given.select(*parents, F.col("given").alias("amount")), parents)
        given = _share(own, ["all", *parents])
    return (leaves.join(given.select(*LEVELS, F.col("given")), list(LEVELS), "left")
            .withColumn("target", F.floor(F.coalesce("given", F.lit(0.0))).cast("long")).drop("given"))


def _draw(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"),
                             F.coalesce(doc_id.cast("string"), F.lit(""))))


def mix(docs: DataFrame, domain: Column, weights: Weights, budget_share: float = 0.8, max_epochs: int = 3,
        seed: int = 17, tokens: Column | None = None, id_col: str = "doc_id", lang: str = "lang",
        source: str = "source", text_col: str = "text", name: str = "mix") -> DataFrame:
    """The chosen rows with all their columns and a struct ``name``: (domain, lang, source, epoch, tokens).

    A row appears once for each epoch in which it is chosen. Text is read, never
    shuffled: rows are compared with their leaf's last chosen hash and id.
    """
    own = F.struct(F.coalesce(domain, F.lit("")).alias("domain"),
                   F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
                   F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
                   (count_tokens(F.col(text_col)) if tokens is None
                    else F.coalesce(tokens.cast("long"), F.lit(0))).alias("tokens"))
    named = docs.select(F.col(id_col).alias("id"), F.struct(*docs.columns).alias("row"), own.alias("own"))
    narrow = stored(named.select("id", "own.*"), "mix-docs")
    leaves = narrow.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    leaves = leaf_targets(leaves, weights, budget_share, max_epochs)
    full = F.when(F.col("tokens") > 0, F.floor(F.col("target") / F.col("tokens"))).otherwise(0).cast("int")
    plan = stored(leaves.withColumn("full", full).select(
        *LEVELS, "full", (F.col("target") - F.col("full") * F.col("tokens")).alias("rest")), "mix-plan")

    drawn = narrow.join(plan, list(LEVELS)).where("rest > 0").withColumn(
        "draw", _draw(seed, F.col("full"), F.col("id")))
    drawn = drawn.withColumn("range", F.substring("draw", 1, RANGE_DIGITS))
    sums = drawn.groupBy(*LEVELS, "rest", "range").agg(F.sum("tokens").alias("tokens"))
    upto = Window.partitionBy(*LEVELS).orderBy("range")
    # the first range whose tokens do not all fit
    over = (sums.withColumn("before", F.sum("tokens").over(upto) - F.col("tokens"))
            .where("before + tokens > rest").groupBy(*LEVELS, "rest")
            .agg(F.min(F.struct("range", "before")).alias("cut"))
            .select(*LEVELS, "rest", F.col("cut.range").alias("range"), F.col("cut.before").alias("before")))
    inside = drawn.drop("rest").join(over, [*LEVELS, "range"])
    upto = Window.partitionBy(*LEVELS).orderBy("draw", "id")
    fits = (inside.withColumn("upto", F.col("before") + F.sum("tokens").over(upto)).where("upto <= rest")
            .groupBy(*LEVELS).agg(F.max(F.struct("draw", "id")).alias("at"))
            .select(*LEVELS, F.col("at.draw").alias("last_draw"), F.col("at.id").alias("last_id")))
    ends = stored(over.select(*LEVELS, F.col("range").alias("cut_range")).join(fits, list(LEVELS), "left"),
                  "mix-ends")

    leaf = plan.join(ends, list(LEVELS), "left").select(
        F.struct(*LEVELS).alias("leaf"), "full", "rest", "cut_range", "last_draw", "last_id")
    rows = named.withColumn("leaf", F.struct(*[F.col(f"own.{c}").alias(c) for c in LEVELS])).join(leaf, "leaf")
    draw = _draw(seed, F.col("full"), F.col("id"))
    early = F.substring(draw, 1, RANGE_DIGITS) < F.col("cut_range")
    in_cut = (draw < F.col("last_draw")) | ((draw == F.col("last_draw"))
                                            & (F.col("id").isNull() | F.coalesce(F.col("id") <= F.col("last_id"), F.lit(False))))
    last = (F.col("rest") > 0) & (F.col("cut_range").isNull() | early | F.coalesce(in_cut, F.lit(False)))
    epochs = F.concat(F.when(F.col("full") > 0, F.sequence(F.lit(0), F.col("full") - 1))
                      .otherwise(F.array().cast("array<int>")),
                      F.when(last, F.array(F.col("full"))).otherwise(F.array().cast("array<int>")))
    return (rows.withColumn("epoch", F.explode(epochs))
            .select("row.*", F.struct("own.domain", "own.lang", "own.source", "epoch", "own.tokens").alias(name)))
