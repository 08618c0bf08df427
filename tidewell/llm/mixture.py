"""Mixing sources to target weights by hierarchical budgeting, in DataFrame functions alone.

Weights go down a tree of levels (domain, language, source). A node gives each child its share of its
budget, but no more than the child's documents hold in ``max_epochs`` epochs; what a child can't take
goes to its siblings by their weights, and only what none of them can take to the node's own siblings.
Each leaf fills its budget with whole epochs and the prefix of one more, in an order seeded by
(seed, epoch): the documents whose running sum of tokens stays within what is left.

Documents are never sorted as a whole. Each leaf's order of n documents is cut into sqrt(n) buckets of
hashes; sums of buckets tell in which the prefix ends, and only that one is summed document by document. So a leaf is kept
by a bound on the hash, and documents meet a table of leaves alone.

Nulls: a null level is the child ``(none)``; a null text has no tokens and goes with its leaf. Rows that tie
in the order (one doc_id repeated, or null) are kept or left together. Without documents the result is empty.
Other columns stay.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, words, written


def default_domain() -> Column:
    """The domain of a source: its name picks one of four."""
    return F.element_at(F.array(*map(F.lit, ("web", "books", "news", "forum"))), (F.crc32("source") % 4).cast("int") + 1)


#: Leaves (a row each of some hundred bytes) up to which their table is broadcast.
BROADCAST_LEAVES = 50_000


@dataclass(frozen=True)
class Mixture:
    """Weights, whole numbers, are by path, such as ``("web",)`` or ``("web", "en")``; a path that isn't named has weight 1."""

    weights: dict = field(default_factory=dict)
    #: Tokens to select, as a share of all tokens: (of, in).
    budget: tuple = (4, 5)
    max_epochs: int = 4
    seed: int = 1


WHOLE = "decimal(20,0)"


def _shared(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """``nodes`` (their path, room, weight w, and their parent's amount) with ``share``, what each gets of that amount.

    By the room that a weight has, children fill up one after the other: each is full if its part of what those before
    it left, by the weights from it on, is no less than its room. The others part the rest by their weights.
    """
    siblings = Window.partitionBy(*parent)
    ordered = siblings.orderBy(F.when(F.col("w") > 0, F.col("room") / F.col("w")).asc_nulls_last(), nodes.columns[len(parent)])
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(WHOLE)
    left = F.col("amount") - F.coalesce(F.sum("room").over(before), zero)
    weights = F.sum("w").over(siblings) - F.coalesce(F.sum("w").over(before), zero)
    fits = (weights > 0) & (F.col("room") * weights <= left * F.col("w"))
    nodes = nodes.withColumn("fits", fits).withColumn("full", F.bool_and("fits").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    rest = F.col("amount") - F.coalesce(F.sum(F.when(F.col("full"), F.col("room"))).over(siblings), zero)
    total = F.sum(F.when(~F.col("full"), F.col("w"))).over(siblings)
    nodes = nodes.withColumn("rest", rest.cast(WHOLE)).withColumn("total", total.cast(WHOLE))
    return nodes.withColumn("share", F.when(F.col("full"), F.col("room")).when(F.col("total") > 0, F.expr("(rest * w) DIV total")).otherwise(zero).cast(WHOLE))


def allocate(leaves: DataFrame, names: list[str], mixture: Mixture, budget: int) -> DataFrame:
    """The leaves (paths ``names`` and the tokens ``n`` that they hold) with their ``budget`` of tokens.

    A level's nodes are met by their parents, from the root down; nothing is gathered, however many leaves there are.
    """
    weights = F.create_map(*(F.lit(x) for k, v in [(("",) * (len(names) + 1), 1), *mixture.weights.items()] for x in ("\x1f".join(k), v)))
    amounts = None
    for depth in range(len(names)):
        path, parent = names[: depth + 1], names[:depth]
        nodes = leaves.groupBy(*path).agg((F.sum("n") * mixture.max_epochs).cast(WHOLE).alias("room"))
        nodes = nodes.withColumn("w", F.coalesce(F.try_element_at(weights, F.concat_ws("\x1f", *path)), F.lit(1)).cast(WHOLE))
        if amounts is None:
            nodes = nodes.withColumn("amount", F.least(F.lit(budget).cast(WHOLE), F.sum("room").over(Window.partitionBy()).cast(WHOLE)))  # a row for each domain
        else:
            nodes = nodes.join(amounts, parent)
        amounts = _shared(nodes, parent).select(*path, F.col("share").alias("amount"))
    return leaves.join(amounts, names).withColumnRenamed("amount", "budget")


def _order(seed: int, epoch: Column) -> Column:
    """A place in the seeded order of an epoch, 0 to 2**62."""
    return F.shiftright(F.xxhash64(F.lit(seed), epoch, "doc_id"), 2) + F.lit(1 << 61)


def mixed(docs: DataFrame, mixture: Mixture, domain: Column | None = None, tokens: Column | None = None, info: bool = False) -> DataFrame:
    """The rows of ``docs``, one for each epoch that takes them; with ``info`` as ``row``, and domain, n_tokens and epoch beside it."""
    levels = [F.coalesce(c.cast("string"), F.lit("(none)")) for c in (default_domain() if domain is None else domain, F.col("lang"), F.col("source"))]
    tokens = F.size(words(F.col("text"))).cast("long") if tokens is None else tokens
    names = ["l0", "l1", "l2"]
    leafed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *(c.alias(n) for c, n in zip(levels, names)), "doc_id", tokens.alias("n"))
    narrow = written(leafed.select(*names, "doc_id", "n"))
    leaves = written(narrow.groupBy(*names).agg(F.sum("n").alias("n"), F.count("*").alias("docs")))
    found = leaves.agg(F.sum("n").alias("n"), F.count("*").alias("leaves")).head()
    budgets = allocate(leaves, names, mixture, (found.n or 0) * mixture.budget[0] // mixture.budget[1])
    share = lambda sql: F.when(F.col("n") > 0, F.expr(sql)).otherwise(0).cast("long")
    plan = written(budgets.select(*names, share("budget DIV n").alias("epochs"), share("budget % n").alias("rest"), F.sqrt("docs").cast("long").alias("buckets")))
    # A table of leaves travels to each task where its rows are counted to be few; otherwise it is joined by the leaves.
    side = F.broadcast if found.leaves <= BROADCAST_LEAVES else lambda df: df

    # The bucket in which each leaf's prefix ends, then the last hash that is in it.
    placed = narrow.join(side(plan), names).withColumn("h", _order(mixture.seed, F.col("epochs")))
    placed = placed.withColumn("bucket", F.floor(F.col("h") / (F.lit(float(1 << 62)) / F.col("buckets"))).cast("long"))
    sums = placed.groupBy(*names, "rest", "bucket").agg(F.sum("n").alias("n")).select("*", F.expr("sum(n) OVER (PARTITION BY l0, l1, l2 ORDER BY bucket)").alias("upto"))
    ends = sums.where("upto > rest").groupBy(*names).agg(F.min(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before"))).alias("e")).select(*names, "e.bucket", "e.before")
    last = placed.join(side(ends), [*names, "bucket"])
    last = last.select(*names, "h", "rest", "bucket", (F.col("before") + F.expr("sum(n) OVER (PARTITION BY l0, l1, l2, bucket ORDER BY h)")).alias("upto"))
    last = last.groupBy(*names).agg(F.min(F.when(F.col("upto") > F.col("rest"), F.col("h"))).alias("bound"))
    bounds = written(plan.join(side(last), names, "left").select(*names, "epochs", F.coalesce("bound", F.lit((1 << 62) + 1)).alias("bound"), (F.col("rest") > 0).alias("more")))

    chosen = leafed.join(side(bounds), names)
    extra = (F.col("more") & (_order(mixture.seed, F.col("epochs")) < F.col("bound"))).cast("long")
    chosen = chosen.withColumn("taken", F.col("epochs") + extra).where("taken > 0")
    chosen = chosen.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("taken") - 1)))
    return chosen.select("row", F.col("l0").alias("domain"), F.col("n").alias("n_tokens"), "epoch") if info else chosen.select("row.*")


#: Production weights: domains to each other, and English to the other languages within the web.
PRODUCTION = Mixture(weights={("web",): 4, ("books",): 2, ("news",): 3, ("forum",): 1, ("web", "en"): 3})


def op8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixed(table(spark, sf_dir, "documents"), PRODUCTION, info=True)
    return out.select("row.doc_id", "domain", "row.lang", "row.source", "epoch", "n_tokens")
