"""Delivered content ("material slots") out of API logs.

Every slot is a row of SLOTS; one operator reads the logs once, whatever the
number of slots. A log first yields one candidate per slot it passes the gate
of, then each candidate yields its elements.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.jsonx import field, json_elements, json_map, json_maps


@dataclass(frozen=True)
class Slot:
    """Where a slot lies and what its row is made of.

    action, gate  logs of this action whose raw text contains the gate
    path          members below `data` that lead to the slot; () is `data` itself
    many          the slot is an array: one row per element
    id, title, index_type, is_lock
                  (place, member): place "page" is `data`, "parent" the object
                  around an array, "item" the slot or element, "host" the host
                  of the room; None leaves the field empty (a title NULL)
    payload       what the data column holds: "item" or the "raw" log text
    keep          "titled": title not empty; "present": slot there and not null;
                  "all": every gated log gives a row
    """

    label: str
    action: str
    gate: str = ""
    path: tuple[str, ...] = ()
    many: bool = False
    id: tuple[str, str] | None = None
    title: tuple[str, str] | None = None
    index_type: tuple[str, str] | None = None
    is_lock: tuple[str, str] | None = None
    payload: str = "item"
    keep: str = "all"


_ID, _TITLE = ("item", "id"), ("item", "title")
_PARENT_TITLE = ("parent", "title")
_INDEX_TYPE = ("page", "index_type")

# Actions, gates, member names and labels of the 19 slots.
SLOTS = {
    "slot_client_guide": Slot(
        "clientGuide", "app/clientGuide", id=("item", "g_id"), title=_TITLE,
        index_type=_INDEX_TYPE, payload="raw", keep="titled"),
    "slot_startup_ads": Slot(
        "startUpAds", "app/startUpAds", "adid", ("ad",), True, id=("item", "adid"),
        title=_TITLE, index_type=_INDEX_TYPE, keep="titled"),
    "slot_floating_ball": Slot(
        "xuanfuqiu", "app/index", '"suspension"', ("suspension",), title=_TITLE),
    "slot_banner": Slot(
        "banner", "app/index", "banner", ("banner",), True, id=_ID, title=_TITLE,
        index_type=_INDEX_TYPE, keep="titled"),
    "slot_entrance": Slot(
        "entrance", "app/index", "entrance", ("entrance",), True, id=_ID, title=_TITLE,
        index_type=_INDEX_TYPE, keep="titled"),
    "slot_daily_stock": Slot(
        "daily_gold_stock", "app/index", "daily_gold_stock", ("daily_gold_stock", "data"),
        True, id=_ID, title=_PARENT_TITLE, index_type=_INDEX_TYPE, keep="titled"),
    "slot_channel_stock": Slot(
        "channel_daily_gold_stock", "app/index", "channel_daily_gold_stock",
        ("channel_daily_gold_stock", "data"), True, id=_ID, title=_PARENT_TITLE,
        index_type=_INDEX_TYPE, is_lock=("parent", "is_lock"), keep="titled"),
    "slot_live_ball": Slot(
        "live_xuanfuqiu", "app/newInfoCircle", "red_packet", ("circle", "red_packet"),
        id=("host", "p_uid"), title=_TITLE, keep="titled"),
    "slot_hot_list": Slot("index_tuyereHotList", "app/tuyereHotList"),
    "slot_special_stocks": Slot(
        "index_special_stocks", "app/index", "index_special_stocks",
        ("index_special_stocks",), index_type=_INDEX_TYPE, is_lock=("item", "is_unlock")),
    "slot_market": Slot("index_market", "app/homePage", "recommend"),
    "slot_headlines": Slot("index_market_headlines", "app/index", "market_headlines"),
    "slot_hot_button": Slot("tuyereHotList_button", "api/indexPlateInfo", "route"),
    "slot_top_banner": Slot(
        "index_top_banner", "app/index", "index_banner", ("index_banner",),
        title=_TITLE, keep="present"),
    "slot_live_tab_banner": Slot(
        "live_tab_recommend_banner", "app/compositeVideo", "banner", ("banner",), True,
        id=_ID, title=_TITLE, keep="present"),
    "slot_planner_banner": Slot(
        "lcs_main_banner", "app/newInfoCircle", "banner", ("banner",), True,
        id=_ID, title=_TITLE, keep="present"),
    "slot_live_notice": Slot(
        "index_live_notice", "app/index", "index_live_notice", ("index_live_notice",),
        id=_ID, title=_TITLE),
    "slot_recommend_live": Slot(
        "index_recommend_live", "app/index", "index_recommend_live",
        ("index_recommend_live",), True, id=_ID, title=_TITLE,
        index_type=("item", "tag_text"), keep="present"),
    "slot_live_tab_live": Slot(
        "live_tab_recommend_live", "app/compositeVideo", '"live":', ("live",), True,
        id=_ID, title=_TITLE, keep="present"),
}
_HOST_PATH = ("planner", "planner_info")


def _column(path: tuple[str, ...]) -> str:
    return "_page" + "".join(f".{key}" for key in path)


def _parsed(path: tuple[str, ...]) -> Column:
    return F.col(f"`{_column(path)}`")


def _parents(slots: list[Slot]) -> list[tuple[str, ...]]:
    """Every object on the way to a wanted slot or host, outer ones first."""
    ends = [s.path[:-1] for s in slots]
    ends += [_HOST_PATH for s in slots if s.id and s.id[0] == "host"]
    steps = {path[:depth] for path in ends for depth in range(1, len(path) + 1)}
    return sorted(steps, key=lambda path: (len(path), path))


def _text(slot: Slot) -> Column:
    return field(_parsed(slot.path[:-1]), slot.path[-1]) if slot.path else F.col("_inner")


def _gate(slot: Slot) -> Column:
    passed = F.col("data").contains(slot.gate) if slot.gate else F.lit(True)
    if slot.keep == "present":
        passed = passed & ~_text(slot).isin("", "null")
    elif slot.keep == "titled" and slot.path:
        passed = passed & (_text(slot) != "")
    return passed


def _early(slot: Slot, place: tuple[str, str] | None) -> Column:
    """A value that lies outside the element, else empty."""
    if place is None or place[0] == "item":
        return F.lit("")
    paths = {"page": (), "parent": slot.path[:-1], "host": _HOST_PATH}
    return field(_parsed(paths[place[0]]), place[1])


def _per_slot(values: list[Column]) -> Column:
    """The value of the candidate's slot.

    It names the slot number even when there is one slot only: a condition that
    depends on the generated number stays above the JSON parses, where one that
    did not would be pushed down and repeat them.
    """
    out = F.when(F.col("_slot") == 0, values[0])
    for number, value in enumerate(values[1:], 1):
        out = out.when(F.col("_slot") == number, value)
    return out


def _constant(values: list) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("_slot") + 1)


def _value(slots: list[Slot], name: str) -> Column:
    """id, title, index_type or is_lock: an element member if the slot reads one."""
    places = [getattr(s, name) for s in slots]
    member = _constant([p[1] if p and p[0] == "item" else None for p in places]).cast("string")
    item = F.col("e.item")
    present = F.coalesce(F.map_contains_key(item, F.coalesce(member, F.lit(""))), F.lit(False))
    return F.when(member.isNull(), F.col(f"_{name}")) \
        .when(present, F.coalesce(F.try_element_at(item, member), F.lit("null"))).otherwise("")


def slot_events(api_log: DataFrame, slots: dict[str, Slot] | None = None, *,
                live_ball_planners: tuple[str, ...] = fixed.LIVE_BALL_PLANNERS) -> DataFrame:
    """The 10 slot columns of every wanted slot, from one scan of the logs."""
    wanted = list((slots or SLOTS).values())
    actions = sorted({s.action for s in wanted})
    logs = (
        api_log.where(F.col("action").isin(*actions))
        .select("deviceId", "log_time", "action", "data")
        .withColumn("_outer", json_map(F.col("data")))
        .withColumn("code", field(F.col("_outer"), "code"))
        .withColumn("_inner", field(F.col("_outer"), "data"))
        .withColumn("_page", json_map(F.col("_inner")))
    )
    for path in _parents(wanted):
        logs = logs.withColumn(_column(path), json_map(field(_parsed(path[:-1]), path[-1])))

    of_action = F.lit(None)
    for action in actions:
        numbers = [n for n, s in enumerate(wanted) if s.action == action]
        of_action = F.when(F.col("action") == action, F.lit(numbers)).otherwise(of_action)
    names = ("id", "title", "index_type", "is_lock")
    candidates = (
        logs.withColumn("_slot", F.explode(of_action))
        .where(_per_slot([_gate(s) for s in wanted]))
        .select("deviceId", "log_time", "action", "data", "code", "_slot",
                _per_slot([_text(s) for s in wanted]).alias("_text"),
                *[_per_slot([_early(s, getattr(s, n)) for s in wanted]).alias(f"_{n}")
                  for n in names])
    )
    # The element is parsed inside the generator: a filter on what is read from
    # it would otherwise be pushed below the parse and parse it again.
    reads_item = [any(p and p[0] == "item" for p in (s.id, s.title, s.index_type, s.is_lock))
                  for s in wanted]
    texts = F.when(_constant([s.many for s in wanted]), json_elements(F.col("_text"))) \
        .otherwise(F.array("_text"))
    items = candidates.withColumn("e", F.explode(json_maps(texts, _constant(reads_item))))
    untitled = _constant([s.title is None for s in wanted])
    raw = _constant([s.payload == "raw" for s in wanted])
    rows = items.select(
        "deviceId", "log_time", "action",
        F.when(raw, F.col("data")).otherwise(F.col("e.text")).alias("data"),
        _constant([s.label for s in wanted]).alias("type"), _value(wanted, "id").alias("id"),
        F.when(~untitled, _value(wanted, "title")).alias("title"), "code",
        _value(wanted, "index_type").alias("index_type"),
        _value(wanted, "is_lock").alias("is_lock"),
        _constant([s.keep for s in wanted]).alias("_keep"))
    ball = SLOTS["slot_live_ball"].label
    return rows.where(
        ((F.col("_keep") != "titled") | (F.col("title") != ""))
        & ((F.col("type") != ball) | F.col("id").isin(*live_ball_planners))
    ).select(*fixed.SLOT_EVENT)


def slot_event(api_log: DataFrame, name: str, **options) -> DataFrame:
    return slot_events(api_log, {name: SLOTS[name]}, **options)


def slot_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("type").agg(F.count("*").alias("n"))
