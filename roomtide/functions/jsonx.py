"""JSON text to columns.

An object becomes a map<string,string>; nested values stay JSON text. Text that
is not an object (malformed, an array, NULL) becomes the empty map, so every
lookup on it yields the default. A JSON null member reads as the text "null",
which is how it differs from a missing member. Of a member given twice the last one counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _last_of_each(parsed: Column) -> Column:
    """The map with the last entry of each key; maps without repeats pass untouched."""
    entries = F.map_entries(parsed)
    last = F.filter(entries, lambda e, i: ~F.exists(
        F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]))
    single = F.size(F.array_distinct(F.map_keys(parsed))) == F.size(parsed)
    return F.when(single, parsed).otherwise(F.map_from_entries(last))


def _members(parsed: Column) -> Column:
    return F.coalesce(_last_of_each(parsed), F.create_map().cast("map<string,string>"))


def json_map(text: Column) -> Column:
    """For projections, which parse a text once however often its map is named."""
    return _members(F.from_json(text, "map<string,string>"))


def json_maps(texts: Column, parse: Column) -> Column:
    """An array of (text, item): the texts and, where `parse` holds, their members. In two
    steps, as within a lambda every use of a parsed text would parse it again."""
    parsed = F.transform(texts, lambda t: F.struct(
        t.alias("text"), F.when(parse, F.from_json(t, "map<string,string>")).alias("item")))
    return F.transform(parsed, lambda e: F.struct(
        e["text"].alias("text"), F.when(parse, _members(e["item"])).alias("item")))


def field(parsed: Column, key: str, default: str = "") -> Column:
    present = F.coalesce(F.map_contains_key(parsed, key), F.lit(False))
    return F.when(present, F.coalesce(parsed[key], F.lit("null"))).otherwise(default)


def json_elements(text: Column) -> Column:
    """Elements of a JSON array as text; null members and text that is no array give "{}"."""
    parsed = F.from_json(text, "array<string>")
    empty = F.lit("{}")
    return F.coalesce(
        F.transform(parsed, lambda e: F.coalesce(e, empty)), F.array(empty)
    )


def descend(df: DataFrame, column: str, path: tuple[str, ...], out: str,
            default: str = "") -> DataFrame:
    """Add `out` = the text at `path` below the JSON object in `column`.

    One projection per level: a parsed map is referenced more than once by a
    lookup, and separate projections keep Catalyst from parsing it again.
    """
    text = column
    for depth, key in enumerate(path):
        level = f"_{out}_{depth}"
        df = df.withColumn(level, json_map(F.col(text)))
        df = df.withColumn(out, field(F.col(level), key, default)).drop(level)
        text = out
    return df
