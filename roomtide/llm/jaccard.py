"""Jaccard self-join on word n-grams by vertical partitioning, and its components.

Texts with equal sets are one class; only classes are compared. All n-grams have
one global order, rarest first, which is cut into fragments. The sets are joined
fragment by fragment: each counts its part of an overlap, and the parts are summed
per pair.

What keeps the join small, all of it exact:

- A class whose own n-grams, those no other class has, exceed what a link leaves
  room for has no link. Counting them takes one pass over packed fragments.
- Two linked classes share one of the first n-grams of either (prefix), and each
  must hold enough shared n-grams for the overlap that their sizes ask for.
- In the list of an n-gram every class is first paired with one leader only. Pairs
  inside a component found that way change nothing and are not made. What is left
  of a list is compared in tiles inside a task, which returns pairs only if their
  sizes, components and bitmaps allow a link.

Defined results: a text without words has an empty set and no link; a text shorter
than n words is one n-gram; repeated rows share a class; rows without a key are compared
like others; very long texts are worked on whole, one to a block; an empty table gives
no rows; other columns are ignored. N-grams and sets are told apart by 64 bits.

What grows with the texts is joined by exchanges at every size, never by broadcast. Of
joins on an n-gram or a component the small side is written first, so that Spark can
split a frequent one. Work tables are dropped; the result is a table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise, scratch
from . import text as tx
from .components import components

N = 5
PERCENT = 80
# N-grams of one fragment of the count of own n-grams, and classes of one tile.
FRAGMENT = 2_000_000
TILE = 512
# Fragments of the global order that overlaps are counted in.
CUTS = 8
_BITS = 1024
_BLOCK = 2 << 20
# Classes that are put in order at a time.
_CLASSES = 1000


def least_overlap(n, percent: int = PERCENT):
    """The fewest n-grams a set of n shares with any set linked to it."""
    return -(-percent * n // 100)


def shingle_sets(block: tx.Block, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes of every text in ascending order, and the texts' limits."""
    found = tx.words(block, fold=True)
    codes, limits = tx.grams(found, n)
    size = np.diff(found.limits)
    short = np.flatnonzero((size > 0) & (size < n))
    whole = tx.Rolling(found.code, 1).of(found.limits[:-1][short], found.limits[1:][short])
    text = np.concatenate((np.repeat(np.arange(block.n), np.diff(limits)), short))
    codes = np.concatenate((codes, whole))
    order = np.lexsort((codes, text))
    text, codes = text[order], codes[order]
    new = np.ones(len(codes), dtype=bool)
    new[1:] = (codes[1:] != codes[:-1]) | (text[1:] != text[:-1])
    return codes[new], np.searchsorted(text[new], np.arange(block.n + 1))


def _sums(values: np.ndarray, limits: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=tx.U64)
    np.cumsum(values, out=total[1:])
    return total[limits[1:]] - total[limits[:-1]]


def set_names(codes: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """A 64-bit code of each set, whatever the order of its members."""
    with np.errstate(over="ignore"):
        return tx.mix(_sums(tx.mix(codes), limits) + np.diff(limits).astype(tx.U64))


def _measure(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tx.blocks(batch, "text"):
                codes, limits = shingle_sets(block, n)
                names = set_names(codes, limits)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(block.first, block.n),
                    pa.array(np.diff(limits).astype(np.int64)),
                    pa.array(names.view(np.int64))], names=["doc_id", "n_shingles", "class"])

    return run


def _pack(n: int, fragments: int):
    """Of every block, the n-grams that only one of its classes has, by fragment.

    N-grams that several classes of the block have are sent once, without a class:
    they make other blocks' copies shared, and a frequent one is never gathered
    from every text. Within its fragment an n-gram is known by 32 bits; two that
    fall together only look shared.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tx.blocks(batch, "text", _BLOCK):
                codes, limits = shingle_sets(block, n)
                size = np.diff(limits)
                names = set_names(codes, limits)
                _, one, which = np.unique(names, return_index=True, return_inverse=True)
                text = np.repeat(np.arange(block.n), size)
                mine = one[which][text] == text
                codes, text = codes[mine], text[mine]
                order = np.argsort(codes, kind="stable")
                codes, text = codes[order], text[order]
                begins = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))) \
                    if len(codes) else np.zeros(0, np.int64)
                alone = np.diff(np.concatenate((begins, [len(codes)]))) == 1
                codes, owner = codes[begins], np.where(alone, text[begins], -1)
                place = ((codes >> tx.U64(32)) * tx.U64(fragments) >> tx.U64(32)).astype(np.int64)
                rest = codes.astype(np.uint32)
                order = np.lexsort((owner, place))
                place, owner, rest = place[order], owner[order], rest[order]
                edges = np.searchsorted(place, np.arange(fragments + 1))
                rows = []
                for f in np.flatnonzero(np.diff(edges)):
                    part = slice(edges[f], edges[f + 1])
                    who, counts = np.unique(owner[part], return_counts=True)
                    rows.append((int(f), np.where(who < 0, 0, names[who]).astype(tx.U64).tobytes(),
                                 np.where(who < 0, 0, size[who]).astype(np.int32).tobytes(),
                                 counts.astype(np.int32).tobytes(), rest[part].tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[0] for r in rows], pa.int32())]
                        + [pa.array([r[i] for r in rows], pa.binary()) for i in range(1, 5)],
                        names=["fragment", "names", "sizes", "counts", "rest"])

    return run


def _join(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_py() for v in column), dtype=kind)


def _own(buckets: int):
    """Of a fragment: how many of its n-grams each class has alone, by class bucket."""
    def run(table: pa.Table) -> pa.Table:
        names, sizes = _join(table["names"], tx.U64), _join(table["sizes"], np.int32)
        counts, rest = _join(table["counts"], np.int32), _join(table["rest"], np.uint32)
        entry = np.repeat(np.arange(len(names)), counts)
        order = np.argsort(rest, kind="stable")
        rest, name = rest[order], names[entry[order]]
        new = np.ones(len(rest), dtype=bool)
        new[1:] = rest[1:] != rest[:-1]
        begins = np.flatnonzero(new)
        same = np.ones(len(rest), dtype=bool)
        same[1:] = new[1:] | (name[1:] == name[:-1])
        alone = np.logical_and.reduceat(same, begins) & (name[begins] != 0)
        who, own = np.unique(name[begins][alone], return_counts=True)
        known, at = np.unique(names, return_index=True)
        n = sizes[at[np.searchsorted(known, who)]]
        bucket = (who % tx.U64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        full = np.flatnonzero(np.diff(edges))
        cut = lambda v, kind: pa.array(
            [v[order[edges[b]:edges[b + 1]]].astype(kind).tobytes() for b in full], pa.binary())
        return pa.table({"bucket": pa.array(full.astype(np.int32)), "names": cut(who, tx.U64),
                         "sizes": cut(n, np.int32), "own": cut(own, np.int32)})

    return run


def _lonely(percent: int):
    """Of a class bucket: the classes with too many own n-grams for any link."""
    def run(table: pa.Table) -> pa.Table:
        names, sizes = _join(table["names"], tx.U64), _join(table["sizes"], np.int32)
        who, at, entry = np.unique(names, return_index=True, return_inverse=True)
        own = np.bincount(entry, weights=_join(table["own"], np.int32), minlength=len(who))
        n = sizes[at].astype(np.int64)
        return pa.table({"class": who[own > n - least_overlap(n, percent)].view(np.int64)})

    return run


def _expand(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tx.blocks(batch, "text"):
                codes, limits = shingle_sets(block, n)
                names = set_names(codes, limits)
                size = np.diff(limits)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(names.view(np.int64), size)),
                    pa.array(np.repeat(size, size).astype(np.int32)),
                    pa.array(codes.view(np.int64))], names=["class", "n", "gram"])

    return run


def _order(percent: int):
    """A class's shared n-grams in the global order, its prefix, fragments and bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, _CLASSES) for b in batches
                      for at in range(0, b.num_rows, _CLASSES)):
            rows = []
            for name, n, grams in zip(*(batch.column(c) for c in ("class", "n", "grams"))):
                df = grams.values.field("df").to_numpy()
                gram = grams.values.field("gram").to_numpy()
                size = n.as_py()
                own = size - len(gram)
                room = size - least_overlap(size, percent)
                if own > room:
                    continue
                order = np.lexsort((gram, df))
                gram, df = gram[order], df[order]
                # The order goes by frequency first, so this cuts it into runs.
                part = np.minimum(np.log2(df).astype(np.int64), CUTS - 1)
                edges = np.searchsorted(part, np.arange(CUTS + 1))
                bits = np.zeros(_BITS, dtype=np.uint8)
                bits[gram.view(tx.U64) % tx.U64(_BITS)] = 1
                rows.append((name.as_py(), size, own, gram[:room + 1 - own].tolist(),
                             [{"fragment": int(f), "grams": np.sort(
                                 gram[edges[f]:edges[f + 1]]).tobytes()}
                              for f in np.flatnonzero(np.diff(edges))],
                             np.packbits(bits).tobytes()))
            names = ["class", "n", "own", "prefix", "segments", "bits"]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()),
                     pa.list_(pa.struct([("fragment", pa.int32()), ("grams", pa.binary())])),
                     pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return run


_SET_COLUMNS = ("class long, n int, own int, prefix array<long>, "
         "segments array<struct<fragment: int, grams: binary>>, bits binary")


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [len(np.intersect1d(np.frombuffer(x.as_py(), np.int64),
                                  np.frombuffer(y.as_py(), np.int64), assume_unique=True))
               for x, y in zip(batch.column("x"), batch.column("y"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(got, pa.int64())],
            names=["a", "b", "part"])


def links(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose overlap, summed over the fragments, makes a link."""
    parts = sets.select("class", F.explode("segments").alias("s")).select(
        "class", "s.fragment", "s.grams")
    left = parts.select(F.col("class").alias("a"), "fragment", F.col("grams").alias("x"))
    right = parts.select(F.col("class").alias("b"), "fragment", F.col("grams").alias("y"))
    overlap = (pairs.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "x", "y")
               .mapInArrow(_partial, "a long, b long, part long")
               .groupBy("a", "b").agg(F.sum("part").alias("overlap")))
    size = sets.select("class", "n")
    return (overlap.join(size.toDF("a", "na"), "a").join(size.toDF("b", "nb"), "b")
            .where(F.lit(100) * F.col("overlap")
                   >= F.lit(percent) * (F.col("na") + F.col("nb") - F.col("overlap")))
            .select("a", "b", "overlap"))


def _fits(na, oa, nb, ob, percent: int):
    """Whether two sets of na and nb n-grams, oa and ob of them their own, can be linked."""
    shared = F.least(F.col(na) - F.col(oa), F.col(nb) - F.col(ob))
    return F.lit(100 + percent) * shared >= F.lit(percent) * (F.col(na) + F.col(nb))


def _tile_pairs(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_a, out_b = [], []
            for i, j, members in zip(*(batch.column(c) for c in ("i", "j", "members"))):
                at = members.values
                block, name, comp, n, own = (at.field(c).to_numpy() for c in (
                    "block", "class", "component", "n", "own"))
                n, shared = n.astype(np.int64), (n - own).astype(np.int64)
                bits = np.frombuffer(b"".join(v.as_py() for v in at.field("bits")),
                                     tx.U64).reshape(len(n), -1)
                x = np.flatnonzero(block == i.as_py())
                y = np.flatnonzero(block == j.as_py())
                both = n[x][:, None] + n[y][None, :]
                need = percent * both
                ok = (comp[x][:, None] != comp[y][None, :]) & (
                    (100 + percent) * np.minimum(shared[x][:, None], shared[y][None, :]) >= need)
                if i.as_py() == j.as_py():
                    ok &= name[x][:, None] < name[y][None, :]
                p, q = np.nonzero(ok)
                p, q = x[p], y[q]
                for at0 in range(0, len(p), 1 << 16):
                    a, b = p[at0:at0 + (1 << 16)], q[at0:at0 + (1 << 16)]
                    apart = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64)
                    good = (100 + percent) * (shared[a] + shared[b] - apart) \
                        >= 2 * percent * (n[a] + n[b])
                    a, b = name[a[good]], name[b[good]]
                    out_a.append(np.minimum(a, b))
                    out_b.append(np.maximum(a, b))
            if out_a:
                pairs = np.unique(np.stack((np.concatenate(out_a), np.concatenate(out_b))), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])],
                                                 names=["a", "b"])

    return run


def _rest(sets: DataFrame, found: DataFrame, percent: int, tile: int) -> DataFrame:
    """Pairs that share a prefix n-gram, are in different components and may be linked."""
    labelled = sets.join(found.withColumnRenamed("node", "class"), "class", "left").select(
        F.explode("prefix").alias("gram"), "class",
        F.coalesce("component", "class").alias("component"), "n", "own", "bits")
    contested = materialise(labelled.groupBy("gram")
                            .agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                 F.count("*").alias("size"))
                            .where("low <> high").select(
                                "gram", F.ceil(F.col("size") / tile).cast("int").alias("blocks")),
                            "contested")
    # Both blocks of a tile are in its row; a list of up to `tile` classes is one tile.
    placed = labelled.join(contested, "gram").withColumn(
        "block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tiles = (placed.select("*", other)
             .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
             .groupBy("gram", "i", "j")
             .agg(F.collect_list(F.struct("block", "class", "component", "n", "own", "bits"))
                  .alias("members"))
             .where(F.size("members") > 1))
    return (tiles.select("i", "j", "members").mapInArrow(_tile_pairs(percent), "a long, b long")
            .distinct())


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N,
                       percent: int = PERCENT, tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    own = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    with scratch(docs.sparkSession):
        sized = materialise(own.mapInArrow(
            _measure(n), f"doc_id {kind}, n_shingles long, class long"), "sized")
        label = _labelled(own, sized, n, percent, tile)
        smallest = materialise(label.groupBy("component").agg(
            F.min("doc_id").alias("component_id")), "smallest")
        full = label.join(smallest, "component")
        empty = sized.where("n_shingles = 0").select("doc_id", "n_shingles",
                                                     F.col("doc_id").alias("component_id"))
        return materialise(full.select("doc_id", "n_shingles", "component_id").unionByName(empty),
                           "components", outlive=True)


def _candidates(own: DataFrame, sized: DataFrame, n: int, percent: int) -> DataFrame:
    """The classes that may have links: those without too many n-grams of their own, and
    a row's key of each."""
    total = sized.agg(F.sum("n_shingles")).first()[0] or 0
    fragments = max(1, -(-total // FRAGMENT))
    lonely = (own.select("text")
              .mapInArrow(_pack(n, fragments), "fragment int, names binary, sizes binary, "
                                               "counts binary, rest binary")
              .groupBy("fragment").applyInArrow(_own(fragments), "bucket int, names binary, "
                                                                 "sizes binary, own binary")
              .groupBy("bucket").applyInArrow(_lonely(percent), "class long"))
    return sized.where("n_shingles > 0").groupBy("class").agg(
        F.min("doc_id").alias("doc_id")).join(lonely, "class", "left_anti")


def _sets(own: DataFrame, sized: DataFrame, n: int, percent: int) -> DataFrame:
    """One row per class that may have links: its shared n-grams in the global order."""
    with scratch(own.sparkSession):
        near = materialise(_candidates(own, sized, n, percent), "near")
        # Classes that come along, as theirs is the key of another row, do no harm.
        wanted = own.join(near.select("doc_id").hint("merge"), "doc_id", "left_semi")
        grams = wanted.select("text").mapInArrow(_expand(n), "class long, n int, gram long")
        # A text without an id can only be told by its class.
        nameless = own.where("doc_id is null").select("text").mapInArrow(
            _expand(n), "class long, n int, gram long").join(
                near.select("class"), "class", "left_semi")
        grams = materialise(grams.unionByName(nameless).distinct(), "grams")
        shared = materialise(grams.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1"),
                             "shared")
        return materialise(
            grams.join(shared.hint("merge"), "gram").groupBy("class", "n")
            .agg(F.collect_list(F.struct("df", "gram")).alias("grams"))
            .mapInArrow(_order(percent), _SET_COLUMNS), "sets", outlive=True)


def _labelled(own: DataFrame, sized: DataFrame, n: int, percent: int, tile: int) -> DataFrame:
    """doc_id, n_shingles and the component, named by a class, of the rows with words."""
    sets = _sets(own, sized, n, percent)
    lists = sets.select(F.explode("prefix").alias("gram"), "class", "n", "own")
    leaders = materialise(
        lists.groupBy("gram")
        .agg(F.min(F.struct((F.col("own") * 1000 / F.col("n")).cast("int"), "class",
                            "n", "own")).alias("top"), F.count("*").alias("size"))
        .where("size > 1").select("gram", F.col("top.class").alias("lead"),
                                  F.col("top.n").alias("ln"), F.col("top.own").alias("lo")),
        "leaders")
    stars = (lists.join(leaders, "gram").where("class <> lead")
             .where(_fits("n", "own", "ln", "lo", percent))
             .select(F.least("class", "lead").alias("a"), F.greatest("class", "lead").alias("b"))
             .distinct())
    first = materialise(components(links(stars, sets, percent)), "stars")
    rest = links(_rest(sets, first, percent, tile), sets, percent)
    named = first.withColumnRenamed("component", "to")
    bridges = (rest.select("a", "b")
               .join(named.toDF("a", "ta"), "a", "left").join(named.toDF("b", "tb"), "b", "left")
               .select(F.coalesce("ta", "a").alias("a"), F.coalesce("tb", "b").alias("b")))
    second = components(bridges)
    return materialise(sized.where("n_shingles > 0")
                       .join(first.toDF("class", "c1"), "class", "left")
                       .withColumn("c1", F.coalesce("c1", "class"))
                       .join(second.toDF("c1", "c2"), "c1", "left")
                       .select("doc_id", "n_shingles", F.coalesce("c2", "c1").alias("component")),
                       "label")
