"""The corpus pipeline: every stage on its own input, and its parts against brute force."""

import functools
import re

import corpus_pipeline as pipeline
from odd_rows import empty, odd  # noqa: F401
from roomtide.llm import pii
from roomtide.llm.queries import QUERIES
from test_texts import brute_spans

SF = "/root/testdata/sf0.001"


def words(text):
    return text.encode().lower().split()


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, tables = docs.columns, [docs]
    for name, stage in pipeline.STAGES:
        tables.append(pipeline.materialise(stage(spark, tables[-1], SF), name))
    rows = [{r["doc_id"]: r for r in t.collect()} for t in tables]
    assert all(t.columns == columns for t in tables[:-1])
    raw, good, one, clean, safe, mixed = rows

    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    judged = [d for d in raw if d in labels]
    assert sum((d in good) == bool(labels[d]) for d in judged) > 0.9 * len(judged)

    sets = {d: shingles(r["text"]) for d, r in good.items()}
    for d in good:
        linked = [e for e in good if e != d and sets[d] and
                  100 * len(sets[d] & sets[e]) >= 80 * len(sets[d] | sets[e])]
        assert d in one or linked
        assert d not in one or not [e for e in linked if e in one]

    items = [re.sub(r"[\W_]", "", r["text"].lower())
             for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for d, r in one.items():
        flat = re.sub(r"[\W_]", "", r["text"].lower())
        assert (d in clean) == (not any(i in flat for i in items))

    assert set(safe) == set(clean)
    for d, r in safe.items():
        assert not brute_spans(r["text"]) and r["n_chars"] == len(r["text"])
        if not brute_spans(clean[d]["text"]):
            assert r["text"] == clean[d]["text"]
    assert set(mixed) <= set(safe)
    assert all(mixed[d]["text"] == safe[d]["text"] for d in mixed)


def test_odd_rows(spark, odd, empty, monkeypatch):
    # How well the tagger learns does not matter here.
    monkeypatch.setattr(pii, "learn", functools.partial(pii.learn, rounds=1))
    for docs in (odd, empty):
        columns = docs.columns
        for name, stage in pipeline.STAGES:
            docs = pipeline.materialise(stage(spark, docs, SF), name)
            assert docs.columns[:len(columns)] == columns
        docs.count()


def test_near_duplicates_with_shared_and_null_ids(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a, "s"), (1, b, "s"), (2, b + " more", "s"), (None, a + " more", "s"),
            (None, c, "s"), (None, c, "s"), (None, c, "t"), (3, None, "s"), (4, "", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for parts in (1, 5):
        got = pipeline.keep_one_of_each_group(spark, docs.repartition(parts), SF).collect()
        assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(
            [(1, a), (1, b), (None, c), (3, None), (4, "")], key=str)


def test_short_items_drop_no_document(spark, tmp_path):
    long = "which of these seven planets is the largest one"
    spark.createDataFrame([(1, "42"), (2, "yes"), (3, long)], "item_id long, text string") \
        .write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(1, "its eyes saw 1421 birds"), (2, f"asked: {long}? yes"),
                                  (3, "yes, 42")], "doc_id long, text string")
    kept = pipeline.keep_uncontaminated(spark, docs, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 3]
    got = QUERIES["op6_decontaminate"]
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert {r["doc_id"]: r["n_hits"] for r in got(spark, str(tmp_path)).collect()} == {1: 2, 2: 2, 3: 2}


def test_registered():
    import __spark_entry__ as contract
    assert contract.queries()["pipeline"] is pipeline.run
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in QUERIES) == 1
