"""Near duplicates, repeated passages and neighbours against brute force."""

import collections
import random

import numpy as np
import pyarrow as pa
import pytest

from odd_rows import empty, odd  # noqa: F401
from roomtide.llm import jaccard, neighbours, substrings
from roomtide.llm import text as tx
from roomtide.llm.components import components

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return (text or "").encode().split()


def shingles(text):
    w = words((text or "").translate(FOLD))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    group = list(range(len(sets)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, (d, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if (a and 100 * len(a & b) >= 80 * len(a | b)):
                group[find(i)] = find(j)
    least = {}
    for i, (d, a) in enumerate(sets):
        if a and d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(a), least.get(find(i)) if a else d)
                   for i, (d, a) in enumerate(sets)), key=str)


def copies(seed, n_groups, size, length):
    """Groups of near copies: each copy changes a few words of its group's text."""
    rnd = random.Random(seed)
    out, doc = [], 0
    for g in range(n_groups):
        base = [f"w{rnd.randrange(60)}" for _ in range(length)]
        for c in range(size):
            text = list(base)
            for _ in range(rnd.randrange(0, 4)):
                text[rnd.randrange(length)] = f"x{rnd.randrange(10 ** 6)}"
            out.append((doc, " ".join(text)))
            doc += 1
    return out


@pytest.mark.parametrize("tile", [3, 512])
def test_jaccard_against_brute_force(spark, tile):
    rows = copies(1, 4, 30, 70) + [(1000 + i, t) for i, (_, t) in enumerate(copies(2, 6, 3, 12))]
    rows += [(2000, rows[0][1]), (2001, rows[0][1].upper()), (2002, "a b"), (2003, "A  b"), (2004, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in jaccard.jaccard_components(df, tile=tile).collect()), key=str)
    assert got == brute_components(rows)


def test_jaccard_small_fragments(spark, monkeypatch):
    """Many fragments of the count of own n-grams give the same result as one."""
    rows = copies(5, 5, 12, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(jaccard, "FRAGMENT", 500)
    got = sorted((tuple(r) for r in jaccard.jaccard_components(df).collect()), key=str)
    assert got == brute_components(rows)


def test_jaccard_odd_rows(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = sorted((tuple(r) for r in jaccard.jaccard_components(odd).collect()), key=str)
    assert got == brute_components(rows)
    assert jaccard.jaccard_components(empty).collect() == []


def test_bounds_of_links():
    for n in range(1, 400):
        least = jaccard.least_overlap(n)
        assert 100 * least >= 80 * n > 100 * (least - 1)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}


def brute_kept(rows, window):
    count = collections.Counter()
    lists = [words(t) for _, t in rows]
    for w in lists:
        count.update(tuple(w[i:i + window]) for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, lists):
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), b" ".join(
            x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=str)


@pytest.mark.parametrize("window,anchor", [(35, 12), (9, 4), (6, 6)])
def test_repeats_against_brute_force(spark, window, anchor):
    rnd = random.Random(window)
    shared = [[f"s{rnd.randrange(40)}" for _ in range(rnd.randrange(window - 2, 3 * window))]
              for _ in range(6)]
    rows = []
    for d in range(60):
        text = []
        for _ in range(rnd.randrange(1, 5)):
            text += [f"w{rnd.randrange(200)}" for _ in range(rnd.randrange(0, 30))]
            if rnd.random() < 0.7:
                part = rnd.choice(shared)
                cut = rnd.randrange(0, 5)
                text += part[cut:len(part) - rnd.randrange(0, 5)]
        if rnd.random() < 0.2:
            text += ["again"] * rnd.randrange(0, 3 * window)
        rows.append((d, " ".join(text)))
    rows += [(60, rows[3][1]), (3, rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = substrings.remove_repeats(df, window=window, anchor=anchor).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_kept(rows, window)


def test_windows_alike_in_half_their_code_differ(spark):
    """Two windows with one anchor and equal low halves of their codes are no repeat."""
    rest = " ".join(f"w{i}" for i in range(34))
    texts = [f"x{i} {rest}" for i in range(300_000)]
    codes, lead = [], []
    for block in tx.blocks(pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"]), "text"):
        codes.append(tx.Rolling(tx.words(block).code, 1).of(
            np.arange(block.n) * 35, np.arange(1, block.n + 1) * 35))
        lead.append(substrings._runs(block, 35, 12)["lead"])
    codes, lead = np.concatenate(codes), np.concatenate(lead)
    # The first word is the one that differs, so an anchor with a lead is the same run of words.
    alike = np.flatnonzero((lead > 0) & (lead == np.bincount(lead).argmax()))
    alike = alike[np.argsort(codes[alike].astype(np.uint32))]
    low = codes[alike].astype(np.uint32)
    at = np.flatnonzero(low[1:] == low[:-1])[0]
    pair = [texts[alike[at]], texts[alike[at + 1]]]
    assert pair[0] != pair[1]
    df = spark.createDataFrame(list(enumerate(pair)), "doc_id long, text string")
    got = substrings.remove_repeats(df).collect()
    assert {(r["doc_id"], r["n_removed"], r["kept"]) for r in got} == {
        (0, 0, pair[0]), (1, 0, pair[1])}


def test_repeats_odd_rows(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = substrings.remove_repeats(odd).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_kept(rows, 35)
    assert substrings.remove_repeats(empty).collect() == []


def inner(x, y):
    total = 0.0  # sum() would add with corrections
    for a, b in zip(x, y):
        total += a * b
    return total


def brute_nearest(queries, candidates, k):
    out = []
    for q, x in queries:
        near = sorted((-inner(x, y), c)
                      for c, y in candidates if c != q and len(x) == len(y))
        out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(near[:k])]
    return sorted(out)


def test_neighbours_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.normal(size=6).astype(np.float32)]) for i in range(400)]
    rows += [(1000 + i, rows[i][1]) for i in range(30)]
    rows += [(2000 + i, [1e-30 * (i + 1), 0.0, 3e30]) for i in range(7)]
    rows += [(3000 + i, [5e-324 * (i + 1)] * 2) for i in range(4)]
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 7)
    monkeypatch.setattr(neighbours, "CANDIDATE_BLOCK", 16)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    asked = [r for r in rows if r[0] % 20 == 0]
    got = neighbours.nearest(df.where("vec_id % 20 = 0"), df).collect()
    assert sorted(tuple(r) for r in got) == brute_nearest(asked, rows, 20)


def test_neighbours_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (60, [nan, 1.0]), (80, [inf, 1.0]),
            (100, [None, 1.0]), (120, []), (None, [1.0, 1.0]), (1, [0.5, 0.5]), (2, [0.5, 9.0]),
            (2, [0.5, 9.0]), (3, [1.0, 2.0, 3.0]), (140, [0.0, 1.0])]
    df = spark.createDataFrame([(*r, "x", 3) for r in rows],
                               "vec_id long, embedding array<float>, rank string, score int")
    got = sorted(tuple(r) for r in neighbours.nearest(df.where("vec_id % 20 = 0"), df).collect())
    assert got == [(0, 1, 1, 0.5), (0, 2, 2, 0.5), (0, 3, 2, 0.5), (0, 4, 140, 0.0),
                   (140, 1, 2, 9.0), (140, 2, 2, 9.0), (140, 3, 1, 0.5), (140, 4, 0, 0.0)]
    assert neighbours.nearest(df.where("false"), df).collect() == []
    assert neighbours.nearest(df, df.where("false")).collect() == []


def thue_morse(n):
    """Two words of n letters whose polynomials modulo 2**64 are equal for every base."""
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [128, 256, 1024, 4096])
def test_words_with_equal_polynomials_are_told_apart(spark, n):
    one, other = thue_morse(n)
    texts = [one, other, one.upper(), one + " ", f"{one} x"]
    block = next(tx.blocks(pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"]), "t"))
    plain, folded = tx.words(block).code, tx.words(block, fold=True).code
    assert plain[0] != plain[1] and plain[0] != plain[2] and plain[0] == plain[3]
    assert folded[0] != folded[1] and folded[0] == folded[2]
    rest = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(
        [one, other, one, f"{one} {rest}", f"{other} {rest}"])], "doc_id long, text string")
    found = {r[0]: r[2] for r in jaccard.jaccard_components(docs).collect()}
    assert (found[0], found[1], found[2]) == (0, 1, 0)
    removed = {r["doc_id"]: r["n_removed"] for r in substrings.remove_repeats(docs).collect()}
    # The words after the first are the same in both, the windows with the first are not.
    assert removed == {0: 0, 1: 0, 2: 0, 3: 40, 4: 40}


def exact_neighbours(queries, candidates, k):
    """(query, rank) -> (vec_id, score), numbers that are none first, then largest, then id."""
    out = {}
    for q, x in queries:
        scores = []
        for c, y in candidates:
            if c != q and len(x) == len(y):
                total = 0.0
                for a, b in zip(x, y):
                    total += a * b
                scores.append((total == total, -total if total == total else 0.0, c, total))
        for rank, (_, _, c, total) in enumerate(sorted(scores)[:k]):
            out[q, rank + 1] = (c, repr(total))
    return out


@pytest.mark.parametrize("size", [1e-320, 1e-170, 1e-160, 1e-3, 1.0, 1e150, 1e160, 1e200, 1e300])
def test_neighbours_at_every_magnitude(spark, size):
    rng = np.random.default_rng(int(abs(np.log10(size))))
    special = [(1, 0, 0, 0), (1, -1, 1, 1), (0.3, 0.1, 0.7, 0.9), (0, 0, 0, -1), (1, 1, 1, 1)]
    queries = [(-1 - i, [float(v) for v in x]) for i, x in enumerate(special)]
    # The same, as large or small as the candidates.
    queries += [(-11 - i, [float(v) * size for v in x]) for i, x in enumerate(special)]
    candidates = [(i, [float(v) for v in rng.normal(size=4) * size]) for i in range(40)]
    candidates += [(100 + i, [float(v) * size for v in x]) for i, x in enumerate(special)]
    candidates += [(200 + i, [float(v) for v in rng.normal(size=4)]) for i in range(3)]
    usable = [(i, x) for i, x in queries if any(x)]
    schema = "vec_id long, embedding array<double>"
    got = neighbours.nearest(spark.createDataFrame(queries, schema),
                             spark.createDataFrame(candidates, schema)).collect()
    want = exact_neighbours(usable, [(i, x) for i, x in candidates if any(x)], 20)
    assert {(r[0], r[1]): (r[2], repr(r[3])) for r in got} == want


def test_neighbours_of_mixed_magnitudes(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 7)
    monkeypatch.setattr(neighbours, "CANDIDATE_BLOCK", 11)
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in np.sign(rng.normal(size=5)) * rng.choice([0, 1, 0.5], 5)
                 * 10.0 ** rng.integers(-200, 200)]) for i in range(120)]
    schema = "vec_id long, embedding array<double>"
    every = spark.createDataFrame(rows, schema)
    got = neighbours.nearest(every.where("vec_id % 5 = 0"), every, 6).collect()
    rows = [(i, x) for i, x in rows if any(x)]
    want = exact_neighbours([r for r in rows if r[0] % 5 == 0], rows, 6)
    assert {(r[0], r[1]): (r[2], repr(r[3])) for r in got} == want


def test_groups_of_blocks_are_bounded():
    for dim in (1, 64, 4096):
        for n in (1, 10, 10 ** 6):
            q, c = neighbours.group_sizes(max(1, n // 20), n, dim)
            assert q * c <= neighbours.TASK_TILES * 1.2
            assert q == 1 or q * neighbours.QUERY_BLOCK * dim * 9 <= neighbours.GROUP_BYTES
            assert c == 1 or c * neighbours.CANDIDATE_BLOCK * dim * 9 <= neighbours.GROUP_BYTES
