"""Infill: cuts against a regular expression, the index against all offsets, round trips."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roomtide.llm import infill, text as tx
from odd_rows import ODD, empty, odd  # noqa: F401

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected(key, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    code = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(code[i:i + 8], 16) for i in range(0, 32, 8)]
    n = len(tokens)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:low]), "".join(tokens[low:high]), "".join(tokens[high:])
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def made(rows, key="doc_id"):
    out = infill.transform(rows, ["doc_id", "text"], key).withColumn(
        "back", infill.restore(F.col("output"), F.col("form"))).collect()
    for r in out:
        assert tuple(r)[2:7] == expected(r["doc_id"], r["text"]), r["doc_id"]
        assert r["back"] == (r["text"] or "")
    return out


def test_odd_rows(odd, empty):  # noqa: F811
    assert len(made(odd)) == len(ODD)
    assert infill.transform(empty, ["doc_id"]).count() == 0
    clash = odd.withColumn("form", F.lit(1)).withColumn("key", F.lit(2))
    with pytest.raises(ValueError):
        infill.transform(clash, ["form"])
    assert infill.transform(clash, ["form", "key", "text"], prefix="x_").count() == len(ODD)


def test_marks_and_their_halves(spark):
    texts = ["<P>", "a <S> b", "<M", "M>", "<P x> <", "< P>", "ends <", "<<", "<P<S", "é<\U0001F600 >P>"]
    rows = [(i, t) for t in texts for i in range(40)]
    forms = {r["form"] for r in made(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert forms == {"plain", "psm", "spm"}


def test_random_texts(spark):
    rng = random.Random(6)
    parts = ["a", "bc", "é", "\U0001F600", " ", "  ", "\t", "\n", "\x0b", "\x85", "\xa0", "中文", "<", ">"]
    rows = [(rng.randrange(10 ** 6) - 1000, "".join(rng.choice(parts) for _ in range(rng.randrange(60))))
            for _ in range(600)]
    made(spark.createDataFrame(rows, "doc_id long, text string"))


def test_shares_of_the_forms(spark):
    rows = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"))
    n = {r["form"]: r["count"] for r in infill.transform(rows, ["doc_id"]).groupBy("form").count().collect()}
    assert abs(n["plain"] / 20000 - 0.5) < 0.02 and abs(n["spm"] / (n["spm"] + n["psm"]) - 0.8) < 0.02


def block_of(texts):
    return next(tx.blocks(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["t"]), "t",
                          size=1 << 30))


@pytest.mark.parametrize("bound", [0, 3, 127])
def test_every_boundary_is_within_the_bound_and_exact(bound):
    rng = random.Random(bound)
    texts = ["", " ", "a", "a " * 5000, "x" * 9000 + " y" * 4000,
             " ".join("w" * rng.choice((1, 2, 3, 300)) for _ in range(3000)), "é\U0001F600 " * 700, None]
    offsets, own = infill.boundaries(block_of(texts))
    for i, t in enumerate(texts):
        ends = [m.end() for m in TOKEN.finditer(t or "")]
        assert offsets[own[i]:own[i + 1]].tolist() == [0, *ends]
    index = infill.fit(offsets, own, bound)
    assert np.abs(index.residual).max() <= bound
    assert (index.offsets(np.arange(len(offsets))) == offsets).all()


def test_even_texts_need_few_segments():
    offsets, own = infill.boundaries(block_of(["word " * 20000] * 3))
    index = infill.fit(offsets, own)
    assert len(index.first) == 3 and index.residual.dtype == np.int8
