"""What each of five filters removes, in every order in which they can be applied.

Failures of a row are bits of a mask: A too few words, B too few different words, C too
many capitals, D odd signs, E the text of a smaller id. The first four come from the
row alone. For E a counting Bloom sketch goes ahead:

1. Every text sets a few counters of one block of the sketch, chosen by its hash. Tasks
   add up their own counters and the sums are merged. A text with a counter of one is
   guaranteed to be unique, as a copy would have raised all its counters.
2. One bit per counter is left, set where it is above one: BLOCK_BITS to a block, at most
   MOST_BLOCKS blocks, so the merged sketch has at most MOST_BLOCKS * BLOCK_BITS / 8 bytes
   (64 MB) and is broadcast. It has about BITS_PER_ROW counters a row up to that size; with
   more rows it clears fewer texts, and results stay the same.
3. Only texts that are not cleared are shuffled, once for each task that has them, for the
   smallest id of each whole text. Rows that are not this id fail E.

Flags and labels are joined by id, without texts, and added up: one count per part, mask
and labels. Orders are worked out on these counts, of which there are at most 128 a part.
A filter's share of the removals over all orders (its Shapley share, times 120) is, for
a mask of k bits, 120/k for each of them, as each of k failing filters is first equally
often.

Defined results: a null text is an empty one; a null part is the empty string; a row
without an id never fails E, makes no other row fail it and has no labels; rows of equal
id and text are no copies of each other; of several labels of an id the largest
count; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise, scratch

FILTERS = "ABCDE"
LEAST_WORDS = 200
ODD_SIGNS = "[#$%&*|]"
SEPARATORS = " \t\n\x0b\f\r"

BLOCK_BITS = 32768
MOST_BLOCKS = 16384
BITS_PER_ROW = 16
COUNTERS = 4


def with_mask(rows: DataFrame, text: str = "text") -> DataFrame:
    """The rows with `mask`, the bits of A to D from the least on."""
    inner = F.btrim(F.col(text), F.lit(SEPARATORS))
    # In steps, as each is used more than once below. No words give one empty part.
    cut = rows.withColumns({"words": F.split(inner, "[\\x20\\x09-\\x0D]+"),
                            "none": (inner == "").cast("int")})
    counted = cut.withColumns({
        "n": F.size("words") - F.col("none"),
        "distinct": F.size(F.array_distinct("words")) - F.col("none")})
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = (F.col("n") < LEAST_WORDS, 100 * F.col("distinct").cast("long") < 50 * F.col("n"),
             100 * capitals.cast("long") > 3 * F.length(text), F.rlike(text, F.lit(ODD_SIGNS)))
    mask = sum((f.cast("int") * (1 << i) for i, f in enumerate(fails)), F.lit(0))
    return counted.withColumn("mask", mask).drop("words", "none", "n", "distinct")


# --- the sketch --------------------------------------------------------------------------
def blocks_for(rows: int) -> int:
    return max(1, min(MOST_BLOCKS, -(-rows * BITS_PER_ROW // BLOCK_BITS)))


def block_of(text: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(blocks)).cast("int")


def counters_of(text: Column) -> Column:
    """The different counters of a text in its block."""
    code = F.xxhash64(F.lit(COUNTERS), text)
    return F.array_distinct(F.array(*(
        F.shiftrightunsigned(code, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int")
        for i in range(COUNTERS))))


def sketch(texts: DataFrame, blocks: int, text: str = "text") -> DataFrame:
    """Blocks of the merged sketch as bitmaps of the counters above one. A block without
    any has no row."""
    set_by = texts.select(block_of(F.col(text), blocks).alias("block"),
                          F.explode(counters_of(F.col(text))).alias("counter"))
    counted = set_by.groupBy("block", "counter").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return counted.groupBy("block").agg(
        F.bitmap_construct_agg(F.col("counter").cast("long")).alias("above_one"))


def _is_set(bitmap: Column, counter: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (counter / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.call_function("shiftright", byte.cast("int"), counter % 8).bitwiseAND(F.lit(1)) == 1


def may_repeat(counters: Column, bitmap: Column) -> Column:
    """Whether no counter of a text is one."""
    return F.coalesce(F.forall(counters, lambda c: _is_set(bitmap, c)), F.lit(False))


# --- flags and counts --------------------------------------------------------------------
def flagged(docs: DataFrame, key: str = "doc_id", text: str = "text",
            part: str = "lang") -> DataFrame:
    """One row per document: `key`, `part` and `mask` with all five bits."""
    whole = docs.select(F.col(f"`{key}`").alias("key"),
                        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
                        F.coalesce(F.col(f"`{part}`"), F.lit("")).alias("part"))
    blocks = blocks_for(docs.count())
    merged = materialise(sketch(whole.where("key IS NOT NULL"), blocks), "filter_audit_sketch")
    # Bounded: at most MOST_BLOCKS rows of BLOCK_BITS / 8 bytes.
    checked = whole.withColumn("block", block_of(F.col("text"), blocks)).join(
        F.broadcast(merged), "block", "left")
    repeat = (F.col("key").isNotNull() & F.col("above_one").isNotNull()
              & may_repeat(counters_of(F.col("text")), F.col("above_one")))
    facts = with_mask(checked.select(
        "key", "part", "text", F.when(repeat, F.col("text")).alias("repeat")))
    # Written: one pass over the texts, and what is left of them is read on its own.
    facts = materialise(facts.drop("text"), "filter_audit_facts")
    clear = facts.where("repeat IS NULL").select("key", "part", "mask")
    maybe = facts.where("repeat IS NOT NULL")
    first = maybe.groupBy("repeat").agg(F.min("key").alias("key")).select(
        "key", F.sha2("repeat", 256).alias("code"), F.lit(True).alias("first"))
    # The id and the digest of its text: an id may come with several texts.
    late = maybe.select("key", "part", "mask", F.sha2("repeat", 256).alias("code")).join(
        first, ["key", "code"], "left")
    e = 1 << FILTERS.index("E")
    return clear.unionByName(late.select(
        "key", "part", (F.col("mask") + F.when(F.col("first").isNull(), F.lit(e))
                        .otherwise(F.lit(0))).alias("mask")))


def mask_counts(flags: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows per part, mask and labels: `n`, `good` and `toxic`."""
    marks = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # Rows without an id have no label; apart, they make no hot key.
    known = flags.where("key IS NOT NULL").join(marks, "key", "left")
    unknown = flags.where("key IS NULL").select(
        "key", "part", "mask", F.lit(None).cast("int").alias("good"),
        F.lit(None).cast("int").alias("toxic"))
    return known.unionByName(unknown).groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def orders(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step."""
    every = list(permutations(filters))
    steps = F.array(*(F.struct(
        F.lit("".join(order)).alias("filter_order"), F.lit(i + 1).alias("step"),
        F.lit(sum(1 << filters.index(f) for f in order[:i])).alias("before"),
        F.lit(1 << filters.index(order[i])).alias("own")) for order in every
        for i in range(len(filters))))
    mask = F.col("mask")
    fails = mask.bitwiseAND(F.col("own")) > 0
    earlier = mask.bitwiseAND(F.col("before")) > 0

    def total(of: str, when: Column) -> Column:
        return F.sum(F.when(when, F.col(of)).otherwise(F.lit(0)))

    share = F.col("n") * F.lit(len(every)) / F.greatest(F.bit_count(mask), F.lit(1))
    return counts.select("part", "mask", "n", "good", "toxic", F.explode(steps).alias("s")).select(
        "part", "mask", "n", "good", "toxic", "s.*").groupBy("part", "filter_order", "step").agg(
        total("n", ~fails & ~earlier).alias("kept"),
        total("n", fails & ~earlier).alias("removed"),
        total("n", fails & earlier).alias("redundant"),
        total("n", mask == F.col("own")).alias("unique_fails"),
        total("good", fails & ~earlier).alias("good_lost"),
        total("toxic", fails & ~earlier).alias("toxic_lost"),
        F.sum(F.when(fails, share.cast("long")).otherwise(F.lit(0).cast("long"))).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          part: str = "lang") -> DataFrame:
    """Counts per part, order and step of what the filters remove."""
    with scratch(docs.sparkSession):
        counts = materialise(mask_counts(flagged(docs, key, text, part), labels, key),
                             "filter_audit_counts", outlive=True)
    return orders(counts)
