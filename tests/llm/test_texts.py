"""Operators on single texts: brute force, exact round trips and held-out accuracy."""

import hashlib
import itertools
import random
import re
import sys

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from odd_rows import empty, odd  # noqa: F401
from roomtide.llm import (chat, decontaminate, language, licenses, mixing, pii, quality)
from roomtide.llm import text as tx
from roomtide.llm.queries import ORACLES, QUERIES

# Executors do not import test modules.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SMALL = "/root/testdata/sf0.001"


def block_of(*texts):
    return next(tx.blocks(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())],
                                                     names=["text"]), "text"))


# --- words and hashes ------------------------------------------------------------------
@given(st.lists(st.text(alphabet="ab \t\n\x1c\x85é中", max_size=30), min_size=1, max_size=6))
@settings(max_examples=150, deadline=None)
def test_words(texts):
    block = block_of(*texts)
    found = tx.words(block)
    for i, t in enumerate(texts):
        own = slice(found.limits[i], found.limits[i + 1])
        got = [bytes(block.data[a:b]) for a, b in zip(found.start[own], found.end[own])]
        assert got == t.encode().split()
    every = [(w, c) for t, lo, hi in zip(texts, found.limits[:-1], found.limits[1:])
             for w, c in zip(t.encode().split(), found.code[lo:hi].tolist())]
    assert len({c for _, c in every}) == len({w for w, _ in every}) == len(set(every))
    chars = tx.characters(block)
    assert [chars.points[a:b].tolist() for a, b in zip(chars.limits[:-1], chars.limits[1:])] == [
        [ord(c) for c in t] for t in texts]


def test_blocks_cover_all_rows():
    texts = ["x" * n for n in (0, 5, 300, 0, 90, 1, 100)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    for size, most in ((1, 100), (100, 2), (10 ** 6, 3)):
        got = list(tx.blocks(batch, "text", size, most))
        assert [b.first for b in got] == list(np.cumsum([0] + [b.n for b in got])[:-1])
        assert sum(b.n for b in got) == len(texts)
        assert sum(len(b.data) for b in got) == sum(len(t or "") for t in texts)


# --- quality ---------------------------------------------------------------------------
def test_pairs_by_sum_of_squares():
    """The linear-time score equals the sum over all pairs of features."""
    rng = np.random.default_rng(0)
    machine = quality.Machine(np.sort(rng.normal(size=(2, quality.RANGES - 1))), 0.3,
                              rng.normal(size=quality.BUCKETS + 2 * quality.RANGES),
                              rng.normal(size=(quality.BUCKETS + 2 * quality.RANGES, 3)))
    text, bucket = np.array([0, 0, 0, 2]), np.array([4, 9, 77, 4])
    count, dense = np.array([1, 5, 2, 3]), rng.normal(size=(3, 2))
    of, feature, x = machine.rows(text, bucket, count, dense)
    for t in range(3):
        f, v = feature[of == t], x[of == t]
        raw = machine.bias + (machine.weights[f] * v).sum() + sum(
            (machine.factors[f[i]] @ machine.factors[f[j]]) * v[i] * v[j]
            for i in range(len(f)) for j in range(i))
        assert machine.score(text, bucket, count, dense)[t] == pytest.approx(1 / (1 + np.exp(-raw)))


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = QUERIES["op1_quality_classifier"](spark, sf).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_quality_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(5, 1), (9, 0), (9, 0), (10, None), (None, 1), (4, 1), (13, 0)],
                                   "doc_id long, quality int")
    machine = quality.train(odd, labels)
    got = quality.score(odd, machine, odd.columns, out="__s")
    assert got.columns == [*odd.columns, "__s"] and got.count() == odd.count()
    assert got.where("`__s` is null or isnan(`__s`) or not `__s` between 0 and 1").count() == 0
    assert quality.score(empty, machine, ["doc_id"]).collect() == []
    none = quality.train(empty, labels.where("false"))
    assert {r["score"] for r in quality.score(odd, none, ["doc_id"]).collect()} == {0.5}


# --- personal data ---------------------------------------------------------------------
PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
            r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2 and not (14 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == 3 and not 10 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], s[0], s[2]))


@given(st.text(alphabet="a@.-+0129 ()é\n", max_size=60))
@settings(max_examples=400, deadline=None)
def test_base_spans(text):
    assert pii.base_spans(text) == brute_spans(text)


@pytest.mark.parametrize("text", [
    "a@b.c@d.e.f", "1.2.3.4.5.6.7.8", "1.2.3.999.1.2.3.4", "4111 1111 1111 1111 4111-1111-1111-1111",
    "+1 (555) 010-9999 +1(2)", "0000000000000000", "001.002.003.004", "a@@b.c", "@b.c", "a@b.", "a@b..c",
    "256.1.1.1", "0000256.1.1.1", "00000000255.1.1.1"])
def test_base_spans_cases(text):
    assert pii.base_spans(text) == brute_spans(text)


@pytest.fixture(scope="module")
def network(spark):
    return pii.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_tagger_on_held_out_text(network):
    """Trained on documents; tried on notations and surroundings of its own."""
    cases = {"email": ["jo.doe @ mail1.example.com", "ann[@]mail.example.org"],
             "phone": ["(394) 555-4006", "394-555-4006"], "ip": ["10.20.30.40"],
             "card": ["4111.1111.1111.1111", "4111 1111 1111 1111"]}
    right = total = 0
    for kind, said in cases.items():
        for s in said:
            for before in ("the thing onered at ", "enred with the. "):
                text = f"{before}{s} and the rest of it."
                more = pii.added_spans(network, tx.characters(block_of(text)), [text])[0]
                found = pii.reconcile(text, pii.base_spans(text), more)
                total += 1
                right += any(pii.KINDS[k] == kind and text[a:b] == s for k, a, b in found)
    assert right >= 0.6 * total


def test_gradient(network):
    """The hand-written gradient agrees with differences of the loss."""
    rng = np.random.default_rng(3)
    p = pii.new_network(1)
    x, y = rng.integers(0, pii.CLASSES, (9, 4)), np.zeros((9, 4), dtype=int)
    y[2:5, 1] = (1, 2, 2)
    _, grad = pii._step(p, x, y)
    for name in p:
        for _ in range(4):
            at = tuple(int(rng.integers(n)) for n in p[name].shape)
            if name == "move" and not pii.ALLOWED[at]:
                continue
            old, two = p[name][at], []
            for d in (1e-5, -1e-5):
                p[name][at] = old + d
                two.append(pii._step(p, x, y)[0])
            p[name][at] = old
            assert grad[name][at] == pytest.approx((two[0] - two[1]) / 2e-5, abs=1e-7)


def test_windows_without_digits_add_nothing(network):
    text = "word " * 400 + "call +1 (555) 010-9999 now " + "word " * 400
    spans = pii.added_spans(network, tx.characters(block_of(text)), [text])[0]
    assert all(any(c.isdigit() or c == "@" for c in text[a:b]) for _, a, b, _ in spans)


def long_email(n, k):
    """A rewritten email of n characters, which the base pattern does not match."""
    words = ("maria", "office", "north", "sales", "weber", "data", "lab", "contact", "team", "info")
    name = ".".join(words[(k + i) % len(words)] for i in range(n // 10))[:n // 2 - 3]
    host = ".".join(words[(k * 3 + i) % len(words)] for i in range(n // 4))
    said = f"{name}[@]{host}"[:n - 4].rstrip(".") + ".org"
    return said


@pytest.mark.parametrize("n", [26, 64, 99, 140, 200])
def test_pii_long_spans_are_found_alike_at_every_offset(network, n):
    said = long_email(n, n)
    assert len(said) <= n and not pii.base_spans(said)
    near, after = "the note went out on monday and was then sent on to ", " and nobody else wrote " * 20
    # Only how far from the beginning it stands differs.
    texts = [("x" + " lorem ipsum dolor" * 70)[:at] + " " + near + said + after
             for at in (*range(0, 260, 3), 700, 1111)]
    more = pii.added_spans(network, tx.characters(block_of(*texts)), texts)
    found = [any(text[a:b] == said for _, a, b in pii.reconcile(text, [], own))
             for text, own in zip(texts, more)]
    assert all(found) or not any(found), found
    # The shorter ones are like those it was trained on.
    assert all(found) or n > 64


def test_pii_windows_hold_the_surroundings_of_every_flag():
    rng = np.random.default_rng(3)
    for n, share in ((1, 1), (50, 0.1), (5000, 0.001), (5000, 0.01), (5000, 0.5), (3000, 1)):
        flags = rng.random(n) < share
        windows = pii.windows_around(flags)
        for at in np.flatnonzero(flags):
            assert any(a <= max(0, at - pii.MARGIN) and min(n, at + pii.MARGIN + 1) <= b
                       for a, b in windows)
        assert all(b - a <= pii.STRETCH for a, b in windows)
        assert sum(b - a for a, b in windows) <= 2.2 * n + 2 * pii.MARGIN


def test_pii_pieces_cut_by_edges_are_joined():
    path = np.array([4, 4, 0, 1, 2, 2, 0, 3, 4])
    margin = np.ones(9)
    assert pii.pieces_of(path, margin, 100, 109, 500) == [
        (1, 100, 102, 1.0, True, False), (0, 103, 106, 1.0, False, False), (1, 107, 109, 1.0, False, True)]
    assert pii.pieces_of(path, margin, 0, 9, 9) == [
        (0, 3, 6, 1.0, False, False), (1, 7, 9, 1.0, False, False)]
    whole = [(0, 5, 9, 1.0, False, False)]
    chain = [(1, 50, 100, 1.0, False, True), (1, 60, 160, 3.0, True, True), (1, 120, 170, 2.0, True, False)]
    assert sorted(pii.joined(whole + chain)) == [(0, 5, 9, 1.0), (1, 50, 170, pytest.approx(2.2292, abs=1e-4))]
    # What does not go on, or does not overlap, is dropped.
    assert pii.joined([chain[0], (0, 60, 160, 1.0, True, False), (1, 120, 170, 1.0, True, False)]) == []


def test_pii_best_paths_by_enumeration():
    rng = np.random.default_rng(7)
    p = {"move": np.where(pii.ALLOWED, rng.normal(size=(pii.TAGS, pii.TAGS)), pii._NEVER)}
    e = rng.normal(size=(4, 3, pii.TAGS)) * 2
    tags, margin = pii.best_paths(p, e)
    for j in range(3):
        best = max(itertools.product(range(pii.TAGS), repeat=4), key=lambda way: sum(
            e[t, j, way[t]] for t in range(4)) + sum(p["move"][way[t], way[t + 1]] for t in range(3)))
        assert tags[:, j].tolist() == list(best)
        assert np.allclose(margin[:, j], [e[t, j, best[t]] - e[t, j, 0] for t in range(4)])


def test_pii_odd_rows(odd, empty, network):
    rows = pii.find(odd, network, odd.columns).collect()
    assert len(rows) == odd.count()
    for r in rows:
        text = r["text"] or ""
        base = pii._digest(brute_spans(text)) if len(text) < 20000 else r["base"]
        assert r["base"] == base
        assert set(filter(None, base.split(","))) <= set(r["spans"].split(","))
        assert (r["clean"] is None) == (r["text"] is None)
    assert pii.find(empty, network, ["doc_id"]).collect() == []
    assert pii.redact("a b@c.de 1.2.3.4", [(0, 2, 8), (1, 9, 16)]) == "a [EMAIL] [IP]"
    x, _ = pii.windows_of([])
    assert len(x) == 0 and pii.learn(x, x) is not None


# --- chat ------------------------------------------------------------------------------
def test_a_watched_template_is_caught_where_it_rewrites(spark):
    """Reported is the first turn whose output does not go on from the one before."""
    rng = random.Random(3)
    rows, want = [], {}
    for conv in range(40):
        turns = [(rng.choice(("user", "assistant", "system")), "x" * rng.choice((1, 80, 81, 300)) + "<|")
                 for _ in range(rng.randrange(1, 12))]
        rows += [(conv, i, *t) for i, t in enumerate(turns)]
        outs = [chat.shortened(turns[:i]) for i in range(len(turns) + 1)]
        want[conv] = next((i for i in range(len(turns)) if not outs[i + 1].startswith(outs[i])), -1)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.format_conversations(df, watched=chat.shortened).collect()
    assert {r["conv_id"]: r["watched_rewrote"] for r in got} == want
    assert len(set(want.values())) > 3 and {r["rewrote"] for r in got} == {-1}
    plain = chat.format_conversations(df).collect()
    assert {r["watched_rewrote"] for r in plain} == {None}
    assert [r["formatted"] for r in plain] == [r["formatted"] for r in got]
    with pytest.raises(ValueError):
        chat.format_conversations(df, turn_local=True, watched=chat.shortened)


@given(st.text(alphabet="<|\\im_start>e\n", max_size=40))
def test_escapes_are_reversible(text):
    assert "<|" not in chat.escape(text) and chat.unescape(chat.escape(text)) == text
    assert "\n" not in chat.escape_role(text) and chat.unescape_role(chat.escape_role(text)) == text


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "odd\n\\role", ""]),
                          st.text(alphabet="<|\\im_end>a\n", max_size=20)), max_size=8))
@settings(max_examples=60, deadline=None)
def test_spans_by_rendering(turns):
    out, spans, rewrote = chat.turn_spans(chat.marked, turns)
    assert rewrote == -1 and "".join(out[a:b] for a, b in spans) == out
    for i, (turn, span) in enumerate(zip(turns, spans)):
        a, b = chat.content_span(chat.marked, turns[:i], turn, span, out, chat.escape(turn[1]))
        assert chat.unescape(out[a:b]) == turn[1]


def latest_only(turns):
    """A template that drops the thoughts of all but the last turn."""
    return "".join(f"[{r}]{t}" + ("(thought)" if i == len(turns) - 1 else "")
                   for i, (r, t) in enumerate(turns))


def test_rewriting_templates_are_found(spark):
    rows = [(1, i, "user", f"t{i}") for i in range(5)] + [(2, 0, "user", "alone")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r["rewrote"] for r in chat.format_conversations(df, latest_only).collect()}
    assert got == {1: 1, 2: -1}


def with_header(turns):
    return ("<s>system: be kind\n" if turns else "") + chat.marked(turns)


def last_hundred(turns):
    return chat.marked(turns[-100:])


def test_templates_see_the_whole_conversation(spark):
    turns = [(("user", "assistant")[i % 2], f"text {i}") for i in range(150)]
    df = spark.createDataFrame([(1, i, *t) for i, t in enumerate(turns)],
                               "conv_id long, turn long, role string, text string")
    head = chat.format_conversations(df, with_header).collect()[0]
    assert (head["rewrote"], head["formatted"]) == (-1, with_header(turns))
    assert [head["formatted"][s.start:s.end] for s in head["spans"]] == [t for _, t in turns]
    last = chat.format_conversations(df, last_hundred).collect()[0]
    assert (last["rewrote"], last["formatted"]) == (100, last_hundred(turns))
    assert last["formatted_chars"] == len(last["formatted"])
    assert chat.format_conversations(df, turn_local=True).collect() == \
        chat.format_conversations(df).collect()
    with pytest.raises(Exception, match="turn_local is wrong"):
        chat.format_conversations(df, with_header, turn_local=True).collect()


def test_long_and_odd_conversations(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"<|turn|> {i}\n") for i in range(300)]
    rows += [(2, None, None, None), (2, 0, "assistant", "x"), (2, 0, "assistant", "x"),
             (None, 1, "assistant", ""), (3, 0, "user\n", "\\<\\|")]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], "conv_id long, turn long, role string, "
                               "text string, n_turns int, spans string").repartition(3)
    got = {r["conv_id"]: r for r in chat.format_conversations(df).collect()}
    assert set(got) == {1, 2, 3, None}
    for name, r in got.items():
        own = sorted(((t, role or "", text or "") for c, t, role, text in rows if c == name),
                     key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        text = chat.marked([t[1:] for t in own])
        assert r["formatted"] == text and r["formatted_chars"] == len(text) and r["rewrote"] == -1
        assert r["turns_sha256"] == hashlib.sha256(
            "".join(f"{a}\n{b}\n" for _, a, b in own).encode()).hexdigest()
        loss = "".join(b for _, a, b in own if a == "assistant")
        assert (r["loss_chars"], r["loss_sha256"]) == (
            len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert [chat.unescape(text[s.start:s.end]) for s in r["spans"]] == [b for _, _, b in own]
    assert chat.format_conversations(df.where("false")).collect() == []


# --- mixing ----------------------------------------------------------------------------
def test_mixture_meets_budget_and_targets(spark):
    rows = [(i, f"s{min(i % 7, i % 3)}", "w " * (i % 50 + 1)) for i in range(3000)]
    rows += [(5000 + i, "rare", "w " * 5) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix(df, entropy=0.99).withColumn("n", mixing.tokens(F.col("text"))).collect()
    total = sum(len(t.split()) for _, _, t in rows)
    by, own = {}, {}
    for r in got:
        by[r["source"]] = by.get(r["source"], 0) + r["n"]
    for _, s, t in rows:
        own[s] = own.get(s, 0) + len(t.split())
    assert all(by[s] / own[s] <= mixing.EPOCHS for s in own)
    assert max(by[s] / own[s] for s in own) > 3.5  # the limit, not the entropy, decides here
    assert 0.99 * total < sum(by.values()) <= total
    seen = [(r["doc_id"], r["epoch"]) for r in got]
    assert len(seen) == len(set(seen))
    for s in own:
        full = by[s] // own[s]
        for e in range(full):
            assert sum(r["n"] for r in got if r["source"] == s and r["epoch"] == e) == own[s]


def test_mixing_odd_rows(odd, empty):
    got = mixing.mix(odd)
    assert got.columns == [*odd.columns, "epoch", "block_order"]
    assert 0 < got.agg(F.sum(mixing.tokens(F.col("text")))).first()[0] <= \
        odd.agg(F.sum(mixing.tokens(F.col("text")))).first()[0]
    assert mixing.mix(empty).collect() == []


# --- decontamination -------------------------------------------------------------------
def brute_edits(item, text):
    """Least edit distance of the item to any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def plain(text):
    return "".join(c.lower() for c in text if c.isalpha() or c in "0123456789")


def test_decontamination_against_brute_force(spark):
    rnd = random.Random(4)
    make = lambda n: " ".join("".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(2, 8)))
                              for _ in range(n))
    items = [(i, make(rnd.randrange(12, 30))) for i in range(12)] + [
        (50, "abc"), (51, ""), (52, None), (53, "?!"), (54, "tiny ité")]
    docs = []
    for d in range(60):
        text = list(rnd.choice(items[:12])[1])
        for _ in range(rnd.randrange(0, 12)):
            at = rnd.randrange(len(text))
            rnd.choice([lambda: text.insert(at, "x"), lambda: text.pop(at),
                        lambda: text.__setitem__(at, "z")])()
        docs.append((d, f"{make(10)} {''.join(text)} {make(8)}"))
    docs += [(90, None), (91, ""), (92, items[0][1].upper().replace(" ", "-")), (93, make(3) + " tiny ITÉ")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for d, t in docs:
        for i, s in items:
            m = len(plain(s or ""))
            if m and (e := brute_edits(plain(s), plain(t or ""))) <= decontaminate.budget(m):
                want[d, i] = e
    for chars in (decontaminate.ITEM_CHARS, 400):
        rows = decontaminate.find(df, bench, ["doc_id"], item_chars=chars).collect()
        assert {(r["doc_id"], h["item_id"]): h["edits"] for r in rows for h in r["hits"]} == want
    by = dict(docs)
    for r in rows:
        for h in r["hits"]:
            stretch = plain(by[r["doc_id"]][h["start"]:h["end"]])
            assert brute_edits(stretch, plain(dict(items)[h["item_id"]])) <= h["edits"] + 2


def test_both_ways_give_the_same_hits_and_every_occurrence(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "FILTER_BITS", 1 << 16)
    rnd = random.Random(8)
    make = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 8)))
                              for _ in range(n))
    items = [(i, make(rnd.randrange(5, 40))) for i in range(30)]
    items += [(100, items[3][1]), (3, items[3][1]), (200, "abc")]
    docs, want = [], {}
    for d in range(80):
        said = [rnd.choice(items[:30]) for _ in range(rnd.randrange(5))]
        text = make(6)
        for _, s in said:
            text += f" {s.title()}. {make(rnd.randrange(4, 9))}"
        docs.append((d % 70, text))
        want[text] = sorted(i for i, _ in said)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    ways = [{(r["doc_id"], r["text"]): sorted(tuple(h) for h in r["hits"]) for r in decontaminate.find(
        df, bench, ["doc_id", "text"], item_chars=n).collect()} for n in (decontaminate.ITEM_CHARS, 0)]
    assert ways[0] == ways[1] and len(ways[0]) == 80
    for (_, text), hits in ways[0].items():
        exact = sorted(h[0] for h in hits if h[0] < 100 and h[3] == 0)
        assert exact == want[text]
        # Equal items are found alike; no two stretches of one item overlap.
        assert [h[1:] for h in hits if h[0] == 3] == [h[1:] for h in hits if h[0] == 100]
        for h, other in itertools.combinations([h for h in hits], 2):
            assert h[0] != other[0] or h[2] <= other[1] or other[2] <= h[1]


def test_decontamination_odd_rows(spark, odd, empty):
    bench = spark.createDataFrame([(1, "seven of them in the house"), (None, "x" * 200)],
                                  "item_id long, text string")
    for n in (decontaminate.ITEM_CHARS, 0):
        assert decontaminate.find(odd, bench, odd.columns, out="__hits", item_chars=n).count() == odd.count()
        assert decontaminate.find(empty, bench, ["doc_id"], item_chars=n).collect() == []
    assert decontaminate.find(empty, bench, ["doc_id"]).collect() == []
    assert {len(r["hits"]) for r in decontaminate.find(odd, bench.where("false"), ["doc_id"]).collect()} == {0}


# --- licenses --------------------------------------------------------------------------
def test_licenses_whole_changed_and_repeated(spark, odd, empty):
    gpl, mit = licenses.NOTICES["GPL-3.0"], licenses.NOTICES["MIT-text"]
    short = " ".join(mit.split()[:20])
    docs = [(0, "some words " + gpl + " and " + gpl), (1, mit.upper().replace(" ", "\n  ")),
            (2, mit.replace("free of charge", "gratis and for nothing")), (3, short),
            (4, "this work is licensed under nothing"), (5, "é中 " + licenses.NOTICES["MIT"])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["matches"] for r in licenses.scan(df, ["doc_id"]).collect()}
    assert [(m.license, m.coverage) for m in got[0]] == [("GPL-3.0", 1.0)] * 2
    assert [docs[0][1][m.start:m.end] for m in got[0]] == [gpl[:-1]] * 2
    assert [(m.license, m.coverage) for m in got[1]] == [("MIT-text", 1.0)]
    assert got[2][0].license == "MIT-text" and 0.9 < got[2][0].coverage < 1
    assert not [m for m in got[3] if m.license == "MIT-text"] and got[4] == []
    assert [docs[5][1][m.start:m.end] for m in got[5]] == ["Released under the MIT License"]
    assert licenses.scan(odd, odd.columns).count() == odd.count()
    assert licenses.scan(empty, ["doc_id"]).collect() == []
    assert {len(r["matches"]) for r in licenses.scan(df, ["doc_id"], notices={"n": "", "p": "..."})
            .collect()} == {0}


def test_licenses_of_like_wording(spark):
    said = {
        "This work is licensed under the GNU General Public License, version 2.": {"GPL-2.0"},
        "This work is licensed under the GNU General Public License, version 3.": {"GPL-3.0"},
        "This work is licensed under the GNU Lesser General Public License, version 3.": {"LGPL-3.0"},
        "This work is licensed under the GNU Affero General Public License, version 3.": {"AGPL-3.0"},
        "Licensed under the Apache License, Version 1.1.": {"Apache-1.1"},
        "Licensed under the Apache License, Version 2.0.": {"Apache-2.0"},
        "Licensed under the Mozilla Public License, Version 2.0.": {"MPL-2.0"},
        "Licensed under CC BY 4.0": {"CC-BY-4.0"}, "Licensed under CC BY-SA 4.0": {"CC-BY-SA-4.0"},
        "Licensed under CC BY-NC 4.0": {"CC-BY-NC-4.0"},
        "Licensed under CC BY-NC-SA 3.0": {"CC-BY-NC-SA-3.0"},
        "Released under the ISC License.": {"ISC"}, "Released under the MIT License.": {"MIT"},
        "Released under the Other License.": set(),
        "GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991\n\nCopyright (C) 1991 Free Software "
        "Foundation, Inc.": {"GPL-2.0-body"},
    }
    df = spark.createDataFrame([(i, f"words before {t} words behind") for i, t in enumerate(said)],
                               "doc_id long, text string")
    got = {r["doc_id"]: {m["license"] for m in r["matches"]}
           for r in licenses.scan(df, ["doc_id"]).collect()}
    assert got == dict(enumerate(said.values()))
    every = spark.createDataFrame(list(licenses.NOTICES.items()), "name string, text string")
    for r in licenses.scan(every, ["name"]).collect():
        assert r["name"] in {m["license"] for m in r["matches"] if m["coverage"] == 1}


# --- language --------------------------------------------------------------------------
def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    lang = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op8_language_id"](spark, sf).join(lang, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.95


def test_language_rejects_what_is_far(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train(docs)
    df = spark.createDataFrame([(1, "Это совсем другой язык, которого никто не видел"),
                                (2, "12 34 !!"), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in language.predict(df, model, F.lit(False)).collect()}
    assert got[1]["rejected"] and got[1]["lang_pred"] in model.names
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (2, 3)] == [("und", 0.0)] * 2


def test_language_odd_rows(odd, empty):
    model = language.train(odd)
    rows = language.predict(odd, model, F.lit(False)).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert language.predict(empty, model, F.lit(True)).collect() == []
    none = language.train(empty)
    assert {r["lang_pred"] for r in language.predict(odd, none, F.lit(True)).collect()} == {"und"}


# --- all queries -----------------------------------------------------------------------
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    from oracle_check import compare, connect
    assert compare(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) == ""


# --- licenses and languages by brute force ---------------------------------------------
def best_alignment(item, text):
    """Matched words and limits of the best local alignment of two word lists, over the whole
    table: a match counts 2; a change, a gap and an extra word cost 1."""
    rows = [[(0, 0, j) for j in range(len(text) + 1)]]
    best = (0, 0, 0, 0)
    for i, a in enumerate(item, 1):
        row = [(0, 0, 0)]
        for j, b in enumerate(text, 1):
            score, same, begin = rows[-1][j - 1]
            ways = [(score + (2 if a == b else -1), same + (a == b), begin)]
            ways += [(s - 1, n, at) for s, n, at in (rows[-1][j], row[j - 1])]
            value = max(ways, key=lambda w: w[0])
            row.append(value if value[0] > 0 else (0, 0, j))
            if row[-1][0] > best[0]:
                best = (row[-1][0], row[-1][1], row[-1][2], j)
        rows.append(row)
    return best


def test_licenses_against_the_whole_alignment_table(spark):
    rng = random.Random(9)
    split = lambda t: re.findall("[a-z0-9]+", t.lower())
    names = ["MIT", "GPL-2.0", "GPL-3.0", "Apache-2.0", "LGPL-2.1", "CC-BY-4.0", "CC-BY-NC-4.0", "ISC",
             "BSD-3-Clause-text", "MPL-2.0", "Zlib-text", "MIT-tag"]
    notices = {n: licenses.NOTICES[n] for n in names}
    texts = []
    for _ in range(60):
        said = split(notices[rng.choice(names)])
        for _ in range(rng.choice((0, 0, 1, 2))):
            at = rng.randrange(len(said))
            said[at:at + rng.randrange(2)] = rng.choice(([], ["other"], ["a", "b"]))
        texts.append(" ".join(["some", "code"] * rng.randrange(4) + said + ["and", "more"] * rng.randrange(4)))
    known = licenses.Templates(notices)
    found = {}
    for t, k, share, _, _ in licenses.matches(known, block_of(*texts), licenses.COVERAGE):
        found.setdefault(t, {})[known.names[k]] = share
    telling = set(licenses.TELLING)
    sure = 0
    for t, text in enumerate(texts):
        words = split(text)
        for name in names:
            item = split(notices[name])
            _, same, begin, end = best_alignment(item, words)
            told = lambda ws: {licenses.TELLING[w] for w in ws if w in telling}
            stretch = words[begin:end]
            fits = same >= licenses.COVERAGE * len(item) and {
                w for w in item if any(c.isdigit() for c in w)} <= set(stretch) and (
                told(stretch) == told(item) or name in licenses.WITH_HOLDER)
            got = found.get(t, {}).get(name)
            # Found is only what the whole table finds, with no better share.
            assert got is None or fits and got <= same / len(item) + 1e-9, (name, text)
            # Winnowing promises every template that shares a run of so many words.
            run = min(licenses.GRAM + licenses.WINNOW - 1, len(item))
            shared = {tuple(words[i:i + run]) for i in range(len(words))} & {
                tuple(item[i:i + run]) for i in range(len(item) - run + 1)}
            if fits and shared and same >= 0.9 * len(item):
                sure += 1
                assert got == pytest.approx(same / len(item)), (name, text)
    assert sure >= 25


def test_holders_tags_and_whole_licenses(spark):
    clause = licenses.NOTICES["BSD-3-Clause-text"]
    holders = ["the copyright holder", "the Apache Software Foundation", "MIT", "the ISC", "the Boost authors"]
    texts = [clause.replace("the copyright holder", h) for h in holders]
    texts += ["# SPDX-License-Identifier: MIT\nimport os", "SPDX-License-Identifier: GPL-2.0-only"]
    texts += [f"Copyright 2020 somebody. {licenses.NOTICES[n]} int main" for n in ("MIT-whole", "Zlib-whole")]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: {m["license"]: m["coverage"] for m in r["matches"]}
           for r in licenses.scan(rows, ["doc_id"]).collect()}
    assert all(got[i]["BSD-3-Clause-text"] > 0.85 for i in range(5))
    assert "MIT-tag" in got[5] and set(got[6]) == {"GPL-2.0-only-tag"}
    assert got[7]["MIT-whole"] == got[8]["Zlib-whole"] == 1.0
    nc = spark.createDataFrame([(1, "Licensed under CC BY-NC 4.0.")], "doc_id long, text string")
    assert [m["license"] for m in licenses.scan(nc, ["doc_id"]).first()["matches"]] == ["CC-BY-NC-4.0"]


def test_centroids_by_brute_force(spark):
    """Prediction names the language of the centroid of largest cosine, computed plainly."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(120)
    model = language.train(docs)
    rows = docs.select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in language.predict(docs, model, F.lit(False)).collect()}
    assert len(model.centres) > len(model.names) > 1
    for r in rows:
        counts = language.vectors(block_of(r["text"]))[0].astype(float)
        vector = language.weighted(np.array([counts]), model.idf)[0]
        best, name = -1.0, None
        for centre, of in zip(model.centres, model.of):
            cosine = sum(float(a) * float(b) for a, b in zip(vector, centre) if a)
            if cosine > best + 1e-9:
                best, name = cosine, model.names[of]
        assert got[r["doc_id"]]["lang_pred"] == name
        assert got[r["doc_id"]]["score"] == pytest.approx(best, abs=1e-5)


def test_names_that_clash_are_errors_with_a_way_out(spark, odd):  # noqa: F811
    clash = odd.withColumns({"epoch": F.lit(7), "block_order": F.lit("x"), "__meta0": F.lit(1)})
    with pytest.raises(ValueError):
        mixing.mix(clash)
    mixed = mixing.mix(clash, prefix="m_")
    assert mixed.columns == [*clash.columns, "m_epoch", "m_block_order"]
    assert mixed.select("epoch").distinct().collect()[0][0] == 7
    plain = mixing.mix(odd)
    assert sorted(map(str, mixed.select("doc_id", "m_epoch", "m_block_order").collect())) == sorted(
        str(r).replace("epoch", "m_epoch").replace("block_order", "m_block_order")
        for r in plain.select("doc_id", "epoch", "block_order").collect())
    machine = quality.train(odd, spark.createDataFrame([(5, 1), (9, 0)], "doc_id long, quality int"))
    with pytest.raises(ValueError):
        quality.score(clash, machine, ["doc_id", "score"])
    scored = quality.score(clash, machine, ["__meta0", "score", "text"], out="s")
    assert scored.columns == ["__meta0", "score", "text", "s"] and scored.count() == odd.count()
    for run in (lambda: pii.find(clash.withColumn("base", F.lit(1)), pii.new_network(1), ["base"]),
                lambda: licenses.scan(clash.withColumn("matches", F.lit(1)), ["matches"]),
                lambda: decontaminate.find(clash, spark.createDataFrame([], "item_id long, text string"),
                                           ["hits"])):
        with pytest.raises(ValueError):
            run()
