"""Secrets by patterns and by sliding-window entropy, in DataFrame functions only.

Base spans come from three fixed patterns. The entropy scan adds strings that look
random: in every candidate, a run of at least WIDTH characters of a class, a window of
WIDTH characters moves by one. Its counts per character change by one that enters and
one that leaves, and so does the sum of c*log2(c) over the counts, from which the
Shannon entropy is log2(WIDTH) - sum / WIDTH. The sum is kept in whole millionths, so
that no error gathers on the way. A candidate of which some window reaches the floor
of its class gives one span, from the first such window to the end of the last.
Candidates that the allow-list names (words, paths, numbers, dates, UUIDs,
placeholders) are passed over, and so are added spans that touch a base span.

A row is worked on where it lies: nothing is shuffled. Work grows with the text, by a
factor log k for k matches in one text; the state of a candidate is a few numbers and
one count per character of the class, whatever its length.

Defined results: a null or empty text has no spans; spans are in code points, end
exclusive; a row given twice has the same spans twice; an empty table gives no rows;
very long texts are searched whole; other columns are kept, and one that has the name
of a result is an error unless a prefix is given.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- base patterns (fixed values of the data contract) ---------------------------------
KINDS = ("assign", "access", "hex")
ASSIGN = (r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6

# --- entropy -----------------------------------------------------------------------------
WIDTH = 20
SCALE = 1_000_000


@dataclass(frozen=True)
class CharacterClass:
    """Characters a candidate consists of, as a pattern and one by one, and the entropy in
    bits that a window must reach."""

    name: str
    pattern: str
    letters: str
    floor: float


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CLASSES = (
    CharacterClass("random_hex", "[0-9A-Fa-f]", "0123456789abcdefABCDEF", 3.0),
    CharacterClass("random_base64", "[A-Za-z0-9+/_=-]",
                   UPPER + UPPER.lower() + "0123456789+/_=-", 3.75),
)
# Candidates that match one of these as a whole are no secrets.
ALLOWED = (
    r"[A-Za-z+/_=-]+",  # words, names and paths without a digit
    r"[0-9+/_=-]+",  # numbers, dates
    r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",  # UUIDs
    r"(?i).*(example|sample|placeholder|dummy|changeme|xxxx).*",
)

_SPAN = "array<struct<start:int,end:int>>"


def running_sum(values: Column) -> Column:
    """Sums of every beginning of an array, in log2(size) passes that each add what stands
    1, 2, 4, … places before."""
    size = F.size(values)
    passes = F.sequence(F.lit(0), F.greatest(
        F.lit(0), F.ceil(F.log2(size.cast("double"))).cast("int") - 1))

    def add(sums: Column, i: Column) -> Column:
        by = F.least(F.call_function("shiftleft", F.lit(1), i), size)
        return F.zip_with(sums, F.concat(F.array_repeat(F.lit(0), by),
                                         F.slice(sums, F.lit(1), size - by)),
                          lambda a, b: a + b)

    return F.when(size > 0, F.aggregate(passes, values, add)).otherwise(values)


def _lengths(texts: Column) -> Column:
    return F.transform(texts, F.length)


def spans(text: Column, pattern: str, found: Column) -> Column:
    """Where the matches `found` of a pattern lie: what is between them is cut out, too, and
    the lengths of both add up to the places. Texts without a match are not cut."""
    between = F.slice(_lengths(F.split(text, pattern)), F.lit(1), F.size(found))
    ends = running_sum(F.zip_with(between, _lengths(found), lambda a, b: a + b))
    return F.when(F.size(found) > 0, F.zip_with(
        ends, found, lambda end, said: F.struct((end - F.length(said)).alias("start"),
                                                end.alias("end")))
        ).otherwise(F.array().cast(_SPAN))


def _all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _terms() -> list[int]:
    """c * log2(c) in millionths for every count a window can hold."""
    return [round(c * math.log2(c) * SCALE) if c else 0 for c in range(WIDTH + 1)]


def most_sum(floor: float) -> int:
    """The largest sum of terms with which a window's entropy reaches the floor."""
    return math.floor(WIDTH * (math.log2(WIDTH) - floor) * SCALE)


def hot_part(codes: Column, kind: CharacterClass) -> Column:
    """The first place and the end of the windows that reach the floor, both null if none
    does. `codes` numbers the characters of a candidate from 1."""
    terms = F.array(*(F.lit(t).cast("long") for t in _terms()))
    start = F.struct(F.array_repeat(F.lit(0), len(kind.letters)).alias("counts"),
                     F.lit(0).cast("long").alias("sum"),
                     F.lit(None).cast("int").alias("first"),
                     F.lit(None).cast("int").alias("end"))

    def term(count: Column) -> Column:
        return F.get(terms, count)

    def move(state: Column, i: Column) -> Column:
        comes = F.get(codes, i)
        goes = F.when(i >= WIDTH, F.get(codes, i - WIDTH)).otherwise(F.lit(0))
        had, left = F.get(state["counts"], comes - 1), F.get(state["counts"], goes - 1)
        total = state["sum"] + F.when(comes == goes, F.lit(0)).otherwise(
            term(had + 1) - term(had)
            + F.when(goes > 0, term(left - 1) - term(left)).otherwise(F.lit(0)))
        counts = F.transform(state["counts"], lambda c, k: c
                             + F.when(k + 1 == comes, F.lit(1)).otherwise(F.lit(0))
                             - F.when(k + 1 == goes, F.lit(1)).otherwise(F.lit(0)))
        hot = (i >= WIDTH - 1) & (total <= most_sum(kind.floor))
        return F.struct(counts.alias("counts"), total.alias("sum"),
                        F.coalesce(state["first"], F.when(hot, i - (WIDTH - 1))).alias("first"),
                        F.when(hot, i + 1).otherwise(state["end"]).alias("end"))

    return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, move,
                       lambda state: F.struct(state["first"], state["end"]))


def _coded(found: Column, kind: CharacterClass) -> Column:
    """Candidates as their place and the numbers of their characters."""
    return F.transform(found, lambda m: F.struct(
        m["at"]["start"].alias("start"), F.transform(
            F.split(m["said"], ""), lambda c: F.instr(F.lit(kind.letters), c)).alias("codes")))


def _measured(coded: Column, kind: CharacterClass) -> Column:
    return F.transform(coded, lambda m: F.struct(
        m["start"].alias("start"), hot_part(m["codes"], kind).alias("hot")))


def _allowed(said: Column) -> Column:
    out = F.lit(False)
    for pattern in ALLOWED:
        out = out | F.rlike(said, F.lit(f"^(?:{pattern})$"))
    return out


def _untouched(added: Column, base: Column) -> Column:
    """The added spans, disjoint and in order, that share no place with a base span.

    Base spans that begin before an added one ends, less those that end before it begins,
    are those that touch it. Both counts are places in a sorted array.
    """
    def before(marks: Column, own: Column) -> Column:
        """How many marks are smaller than, or for ends as small as, each of the own."""
        mixed = F.array_sort(F.concat(marks, own))
        placed = F.filter(F.transform(mixed, lambda m, i: F.struct(
            m["mine"].alias("mine"), i.alias("place"))), lambda m: m["mine"] >= 0)
        return F.transform(placed, lambda m, i: m["place"] - i)

    def marks(items: Column, field: str, late: int, mine: bool) -> Column:
        return F.transform(items, lambda s, i: F.struct(
            s[field].alias("at"), F.lit(late).alias("late"),
            (i if mine else F.lit(-1)).alias("mine")))

    begun = before(marks(base, "start", 1, False), marks(added, "end", 0, True))
    over = before(marks(base, "end", 0, False), marks(added, "start", 1, True))
    clear = F.zip_with(begun, over, lambda a, b: a == b)
    return F.when((F.size(base) > 0) & (F.size(added) > 0), F.filter(
        added, lambda s, i: F.get(clear, i))).otherwise(added)


def _digest(items: Column, names: tuple[str, ...]) -> Column:
    kinds = F.array(*map(F.lit, names))
    return F.array_join(F.transform(items, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(items: Column, kind: int) -> Column:
    return F.transform(items, lambda s: F.struct(
        s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


NAMES = KINDS + tuple(c.name for c in CLASSES)
FOUND = ("n_assign", "n_access", "n_hex", "base", "spans")


def find(docs: DataFrame, keep: list[str], text: str = "text", prefix: str = "") -> DataFrame:
    """The columns `keep` with counts of base spans, and `base` and `spans` (base and added)
    as lists of kind:start:end by start, then kind; `prefix` goes before these names."""
    if {prefix + c for c in FOUND} & set(keep):
        raise ValueError("the rows already have columns of these names; give a prefix")
    # Work columns are one struct each, so that no name of a kept column can clash.
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    kept = F.struct(*(F.col(f"`{c}`") for c in keep)).alias("k")
    one = docs.select(kept, whole.alias("t"))
    two = one.select(
        "k", "t", _all(F.col("t"), ASSIGN).alias("assign"), _all(F.col("t"), ACCESS).alias("access"),
        _all(F.col("t"), HEX).alias("hex"),
        _all(F.col("t"), CLASSES[1].pattern + f"{{{WIDTH},}}").alias("c1"))
    three = two.select(
        "k", "t", F.when(F.size("assign") > 0, F.filter(
            F.arrays_zip(spans(F.col("t"), ASSIGN, F.col("assign")).alias("at"),
                         _lengths(_all(F.col("t"), ASSIGN, 2)).alias("n")),
            lambda m: m["n"] >= ASSIGN_LEAST)).alias("assign"),
        spans(F.col("t"), ACCESS, F.col("access")).alias("access"),
        spans(F.col("t"), HEX, F.col("hex")).alias("hex"), "c1",
        # A run of hexadecimal digits lies in a run of the wider class.
        F.when(F.size("c1") > 0, _all(F.col("t"), CLASSES[0].pattern + f"{{{WIDTH},}}"))
        .otherwise(F.array().cast("array<string>")).alias("c0"))
    base = [F.coalesce(F.transform("assign", lambda m: m["at"]), F.array().cast(_SPAN)),
            F.col("access"), F.col("hex")]
    four = three.select(
        "k", "t", *(F.size(b).cast("long").alias(f"n{i}") for i, b in enumerate(base)),
        F.array_sort(F.concat(*(_of_kind(b, i) for i, b in enumerate(base)))).alias("base"),
        *(F.filter(F.arrays_zip(
            spans(F.col("t"), kind.pattern + f"{{{WIDTH},}}", F.col(f"c{i}")).alias("at"),
            F.transform(f"c{i}", lambda s: F.when(~_allowed(s), s)).alias("said")),
            lambda m: m["said"].isNotNull()).alias(f"c{i}") for i, kind in enumerate(CLASSES)))
    five = four.select("k", "n0", "n1", "n2", "base", *(
        _coded(F.col(f"c{i}"), kind).alias(f"c{i}") for i, kind in enumerate(CLASSES)))
    six = five.select("k", "n0", "n1", "n2", "base", *(
        _measured(F.col(f"c{i}"), kind).alias(f"c{i}") for i, kind in enumerate(CLASSES)))
    seven = six.select("k", "n0", "n1", "n2", "base", *(F.transform(
        F.filter(f"c{i}", lambda m: m["hot"]["first"].isNotNull()), lambda m: F.struct(
            (m["start"] + m["hot"]["first"]).alias("start"),
            (m["start"] + m["hot"]["end"]).alias("end"))).alias(f"c{i}")
        for i in range(len(CLASSES))))
    eight = seven.select("k", "n0", "n1", "n2", "base", F.array_sort(F.concat("base", *(
        _of_kind(_untouched(F.col(f"c{i}"), F.col("base")), len(KINDS) + i)
        for i in range(len(CLASSES))))).alias("all"))
    made = [F.col("n0"), F.col("n1"), F.col("n2"), _digest(F.col("base"), NAMES),
            _digest(F.col("all"), NAMES)]
    return eight.select(*(F.col("k").getField(c).alias(c) for c in keep),
                        *(c.alias(prefix + name) for name, c in zip(FOUND, made)))
