"""Filter audit: sketch, flags and counts against applying the filters one after another."""

import random
import re
from collections import defaultdict
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from roomtide.llm import filter_audit as fa
from odd_rows import ODD, empty, odd  # noqa: F401

LABELS = "doc_id long, quality int, toxic int"


def failing(rows):
    """For every (id, text, part) the letters that it fails."""
    ids = defaultdict(list)
    for i, t, _ in rows:
        if i is not None:
            ids[t or ""].append(i)
    out = []
    for i, t, _ in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append("".join(f for f, bad in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words),
            100 * len(re.findall("[A-Z]", t)) > 3 * len(t), re.search("[#$%&*|]", t),
            i is not None and min(ids[t]) < i)) if bad))
    return out


def expected(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    fails = failing(rows)
    out = {}
    for part in {p or "" for _, _, p in rows}:
        own = [(i, f) for (i, _, p), f in zip(rows, fails) if (p or "") == part]
        share = defaultdict(int)
        for order in permutations("ABCDE"):
            left = own
            for k, letter in enumerate(order):
                gone = [(i, f) for i, f in left if letter in f]
                kept = [(i, f) for i, f in left if letter not in f]
                out[part, "".join(order), k + 1] = [
                    len(kept), len(gone), sum(letter in f for _, f in own) - len(gone),
                    sum(f == letter for _, f in own), sum(i in good for i, _ in gone),
                    sum(i in toxic for i, _ in gone)]
                share[letter] += len(gone)
                left = kept
        for (p, order, k), row in out.items():
            if p == part:
                row.append(share[order[k - 1]])
    return out


def audited(docs, labels):
    return {(r["part"], r["filter_order"], r["step"]): list(r)[3:]
            for r in fa.audit(docs, labels).collect()}


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def some_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        many = rng.choice((3, 150, 199, 200, 230))
        pool = rng.choice((20, 100, 400))
        text = " ".join(f"{'W' if rng.random() < 0.1 else 'w'}{rng.randrange(pool)}" for _ in range(many))
        text += rng.choice(("", "", " #", " |x", "\n"))
        rows.append((i, text, rng.choice(("en", "de", None))))
        while rng.random() < 0.4:
            rows.append((rng.randrange(5 * n), text, rng.choice(("en", "de", "", None))))
    rng.shuffle(rows)
    return rows


def test_against_filters_applied_in_turn(spark):
    rows = some_rows(120, 1)
    labels = [(i, random.Random(i).randrange(2), random.Random(-i).randrange(2)) for i in range(0, 400, 2)]
    labels += [(0, 1, None), (2, None, 1), (None, 1, 1), (4, 0, 0), (4, 1, 1)]
    got = audited(table(spark, rows), spark.createDataFrame(labels, LABELS))
    assert got == expected(rows, labels)


def test_odd_rows(spark, odd, empty):  # noqa: F811
    labels = [(8, 1, 0), (None, 1, 1), (99, 1, 1), (5, 1, 1)]
    rows = [(r[0], r[1], r[2]) for r in ODD]
    assert audited(odd, spark.createDataFrame(labels, LABELS)) == expected(rows, labels)
    assert fa.audit(empty, spark.createDataFrame(labels, LABELS)).count() == 0
    none = audited(odd, spark.createDataFrame([], LABELS))
    assert none == expected(rows, [])


def test_one_part_of_one_row_has_all_its_zeros(spark):
    got = audited(table(spark, [(1, "a " * 3, "xx")]), spark.createDataFrame([], LABELS))
    assert len(got) == 600 and {k[0] for k in got} == {"xx"}


def test_an_id_with_several_texts(spark):
    rows = [(1, "a", "en"), (1, "b", "en"), (2, "a", "en"), (0, "b", "en"), (1, "a", "en"), (None, "a", "en")]
    assert audited(table(spark, rows), spark.createDataFrame([], LABELS)) == expected(rows, [])


def test_the_sketch_clears_unique_texts_and_no_other(spark):
    n = 4000
    rows = [(f"text {i}",) for i in range(n)] + [(f"text {i}",) for i in range(0, n, 10)] * 3
    texts = spark.createDataFrame(rows, "text string")
    for blocks in (1, 3, fa.blocks_for(n)):
        merged = fa.sketch(texts, blocks)
        assert merged.count() <= blocks
        joined = texts.withColumn("block", fa.block_of(F.col("text"), blocks)).join(
            merged, "block", "left")
        again = joined.where(fa.may_repeat(fa.counters_of(F.col("text")), F.col("above_one")))
        kept = {r["text"] for r in again.collect()}
        twice = {f"text {i}" for i in range(0, n, 10)}
        assert twice <= kept
        # Four counters of 32 768 and 4 000 texts: hardly any text is in doubt without need.
        assert len(kept - twice) < 0.05 * n


def test_the_sketch_counts_as_counters_do(spark):
    rng = random.Random(4)
    texts = [f"t{rng.randrange(300)}" for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    each = df.select("text", fa.counters_of(F.col("text")).alias("c")).collect()
    count = np.zeros(fa.BLOCK_BITS, int)
    for r in each:
        for c in r["c"]:
            count[c] += 1
    bitmap = np.frombuffer(bytes(fa.sketch(df, 1).collect()[0]["above_one"]), np.uint8)
    assert (np.unpackbits(bitmap, bitorder="little") == (count > 1)).all()


def test_the_sketch_has_a_bound():
    assert fa.blocks_for(0) == 1 and fa.blocks_for(10 ** 12) == fa.MOST_BLOCKS
    assert fa.MOST_BLOCKS * fa.BLOCK_BITS // 8 <= 64 << 20


def test_unique_texts_are_not_shuffled(spark):
    flags = fa.flagged(table(spark, [(i, f"text {i}", "en") for i in range(2000)]))
    assert flags.where("mask >= 16").count() == 0
    plan = flags._jdf.queryExecution().executedPlan().toString()
    clear = plan[:plan.index("isnotnull(repeat")]
    assert "Exchange" not in clear
