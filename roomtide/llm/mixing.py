"""Mixing sources by temperature, realised as budgeted permutations of blocks.

A source's share of the tokens is raised to an exponent between 0 and 1 and the
shares are normalised. The exponent is bisected: the largest that keeps the entropy
of the weights at the target, or, where that would repeat a source more often than
allowed, the smallest that does not. If even the plain shares break the limit, they
are taken.

Weights times the budget are token budgets. A source's documents lie in BLOCKS
blocks by a code of their key. Whole epochs take all blocks; the last takes blocks in
an order permuted for that epoch while the budget lasts, and of the first block that
does not fit the documents that do. A row of the result carries its epoch and the
code that orders its block, so sorting by them gives the mixture.

No text is shuffled: what decides a row is one line per source and the row itself.

Defined results: a null source is the empty one; a null or empty text has no tokens
and goes with its block; a source without tokens is not in the mixture; rows of
equal key lie in one block, and which of equal rows is the last to fit does not show
in the result; very long texts are counted whole; an empty table gives no rows; other
columns are kept, and one that has the name of a result is an error unless a prefix is
given.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialise

BLOCKS = 4096
# Target entropy as a share of that of equal weights, and epochs of a source at most.
ENTROPY = 0.995
EPOCHS = 4
SEED = 42
_GRID = 32
_DIGITS = 9


def tokens(text: Column) -> Column:
    """Words of the whole text."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def _code(*parts: Column) -> Column:
    """32 bits of the MD5 of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("long")


def block_of(key: Column, seed: int = SEED) -> Column:
    return F.pmod(_code(F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit(""))),
                  F.lit(BLOCKS)).cast("int")


def block_order(source: Column, epoch: Column, block: Column, seed: int = SEED) -> Column:
    """The code by which the blocks of a source are permuted in an epoch."""
    return F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), source, epoch.cast("string"),
                                         block.cast("string"))), 1, 16)


def _narrow(shares: DataFrame, holds, low_holds: bool) -> float:
    """The exponent in 0..1 where a condition turns, found by _GRID points at a time.

    `holds` makes, for an exponent, a Boolean aggregate over the sources; it is true
    up to some exponent (low_holds) or from one on.
    """
    low, high = 0.0, 1.0
    while True:
        points = [low + (high - low) * i / _GRID for i in range(_GRID + 1)]
        if not low < points[1] < high:
            return low if low_holds else high
        got = shares.agg(*(holds(a).alias(f"p{i}") for i, a in enumerate(points))).first()
        if low_holds:
            last = max((i for i, ok in enumerate(got) if ok), default=None)
            if last is None or last == _GRID:
                return 0.0 if last is None else points[-1]
            low, high = points[last], points[last + 1]
        else:
            first = min((i for i, ok in enumerate(got) if ok), default=None)
            if first is None or first == 0:
                return 1.0 if first is None else points[0]
            low, high = points[first - 1], points[first]


def weights(stats: DataFrame, total: int, n: int, budget: int, entropy: float,
            epochs: float) -> tuple[DataFrame, float]:
    """source, tokens, weight of each source, and the exponent."""
    p = F.col("tokens") / F.lit(float(total))
    shares = stats.withColumn("p", p)
    power = lambda a: F.pow("p", F.lit(a))

    def even(a: float) -> Column:
        # The entropy of p^a / sum p^a.
        z = F.sum(power(a))
        return F.log(z) - F.lit(a) * F.sum(power(a) * F.log("p")) / z >= entropy * math.log(n)

    def rare(a: float) -> Column:
        return F.max(power(a) / F.col("tokens")) * F.lit(float(budget)) / F.sum(power(a)) <= epochs

    exponent = max(_narrow(shares, even, True) if n > 1 else 1.0, _narrow(shares, rare, False))
    z = shares.agg(F.sum(power(exponent))).first()[0]
    return shares.select("source", "tokens",
                         F.round(power(exponent) / F.lit(z), _DIGITS).alias("weight")), exponent


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", *,
        budget: int | None = None, entropy: float = ENTROPY, epochs: float = EPOCHS,
        seed: int = SEED, prefix: str = "") -> DataFrame:
    """The rows of the mixture: all columns of docs, `epoch` and `block_order`.

    `budget` is in tokens, by default as many as docs has; `prefix` goes before the two names.
    """
    names = (f"{prefix}epoch", f"{prefix}block_order")
    if {n.lower() for n in names} & {c.lower() for c in docs.columns}:
        raise ValueError("the rows already have columns of these names; give a prefix")
    own = F.coalesce(F.col(source).cast("string"), F.lit(""))
    marked = docs.withColumns({"__source": own, "__block": block_of(F.col(key), seed)})
    blocks = materialise(marked.select("__source", "__block", tokens(F.col(text)).alias("n"))
                         .groupBy("__source", "__block").agg(F.sum("n").alias("tokens")), "blocks")
    stats = blocks.groupBy(F.col("__source").alias("source")).agg(
        F.sum("tokens").alias("tokens")).where("tokens > 0")
    total, n = stats.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.count("*")).first()
    out = [*docs.columns, *names]
    if not total:
        return marked.where("false").withColumns(
            {names[0]: F.lit(0), names[1]: F.lit("")}).select(*out)
    given = total if budget is None else budget
    weighted, _ = weights(stats, total, n, given, entropy, epochs)
    plan = weighted.withColumn("budget", F.floor(F.col("weight") * F.lit(float(given)))) \
        .withColumn("full", F.floor(F.col("budget") / F.col("tokens")).cast("int")) \
        .withColumn("rest", F.col("budget") - F.col("full") * F.col("tokens"))
    # The first block, in the order of the last epoch, that the rest does not cover.
    ordered = (blocks.withColumnRenamed("tokens", "size")
               .join(plan.withColumnRenamed("source", "__source"), "__source")
               .withColumn("place", block_order(F.col("__source"), F.col("full"),
                                                F.col("__block"), seed)))
    before = Window.partitionBy("__source").orderBy("place", "__block").rowsBetween(
        Window.unboundedPreceding, -1)
    cut = (ordered.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
           .where("before + size > rest").groupBy("__source")
           .agg(F.min(F.struct("place", "__block", (F.col("rest") - F.col("before")).alias("left"),
                               "full")).alias("c"))
           .select("__source", F.col("c.place").alias("__cut"), F.col("c.__block").alias("__at"),
                   F.col("c.left").alias("__left"), F.col("c.full").alias("__full")))
    # One line per source; Spark sends it to the tasks if it is small.
    cut = materialise(cut, "cut")
    placed = marked.join(cut, "__source").withColumn(
        "__place", block_order(F.col("__source"), F.col("__full"), F.col("__block"), seed))
    last = F.when((F.col("__place") < F.col("__cut")), F.col("__full")).otherwise(
        F.col("__full") - 1)
    whole = (placed.where(last >= 0).withColumn(names[0], F.explode(F.sequence(F.lit(0), last)))
             .withColumn(names[1], block_order(F.col("__source"), F.col(names[0]),
                                               F.col("__block"), seed)))
    inside = Window.partitionBy("__source").orderBy("__code", "__key", "__n").rowsBetween(
        Window.unboundedPreceding, 0)
    part = (placed.where("__block = __at and __place = __cut")
            .withColumns({"__n": tokens(F.col(text)), "__key": F.col(key).cast("string"),
                          "__code": _code(F.lit(str(seed)), F.coalesce(
                              F.col(key).cast("string"), F.lit("")))})
            .withColumn("__sum", F.sum("__n").over(inside)).where("__sum <= __left")
            .withColumns({names[0]: F.col("__full"), names[1]: F.col("__place")}))
    return whole.select(*out).unionByName(part.select(*out))
