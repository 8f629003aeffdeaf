"""Logical tables derived from the given parquet tables.

Every frame is a projection of `events`, `orders` or `conversations`, so its
size follows theirs; only `session` groups. Clocks in the files carry no zone
and are read as UTC. Attributes that must vary independently of one another use
coprime moduli of the same id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed, scalars
from ..session import materialise

EVENTS = ("event_id bigint, ts timestamp, user_id bigint, event_type string, "
          "value double, props string")
ORDERS = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
          "o_totalprice double, o_orderdate timestamp, o_orderpriority string")

FIRST_DAY = "2024-01-01"
SNAPSHOT_DAYS = 15
TIME_SCALE = 5000

_sessions: dict[tuple[str, str], DataFrame] = {}


def _utc(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    _utc(spark)
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def event_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    _utc(spark)
    reader = spark.readStream.schema(EVENTS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # The pattern lets the table be one file or a folder of files.
    return reader.parquet(f"{sf_dir}/events.parquet*")


def _pick(index: Column, values: tuple) -> Column:
    out = F.lit(values[-1])
    for i, value in reversed(list(enumerate(values[:-1]))):
        out = F.when(index == i, F.lit(value)).otherwise(out)
    return out


def _mod(column: str, n: int) -> Column:
    return F.col(column) % n


def _text(column: Column) -> Column:
    return column.cast("string")


def _scaled(ts: Column, scale: int) -> Column:
    """Squeeze event time towards the first day so short gaps and windows occur."""
    if scale == 1:
        return ts
    base = F.unix_micros(F.lit(FIRST_DAY).cast("timestamp"))
    return F.timestamp_micros(base + F.floor((F.unix_micros(ts) - base) / scale))


def _client_time(at: Column) -> Column:
    """What clients say the time is: mostly right, some fast or slow, some far off, no time
    or nothing."""
    i = "event_id"
    return (F.when(_mod(i, 29) == 0, "").when(_mod(i, 31) == 0, _text(F.unix_seconds(at)))
            .when(_mod(i, 37) == 0, scalars.second_text(at - F.expr("INTERVAL 40 DAYS")))
            .when(_mod(i, 19) == 0, scalars.second_text(at - F.expr("INTERVAL 2 HOURS")))
            .when(_mod(i, 23) == 0, scalars.second_text(at + F.expr("INTERVAL 90 MINUTES")))
            .otherwise(scalars.second_text(at)))


def heartbeat_rows(events: DataFrame, time_scale: int = 1) -> DataFrame:
    """The 16 heartbeat columns, plus event_id for the replay fixtures."""
    i = "event_id"
    second = (
        F.when((_mod(i, 4) == 2) & (_mod(i, 17) == 0), "1.5")
        .when(_mod(i, 4) == 1, "")
        .when(_mod(i, 4) >= 2, _text(F.floor("value") % 60))
    )
    return events.withColumn("logtime", _scaled(F.col("ts"), time_scale)).select(
        i,
        _client_time(F.col("logtime")).alias("c_time"),
        F.when(_mod(i, 11) == 0, "")
        .otherwise(F.concat(F.lit("d"), F.get_json_object("props", "$.k"))).alias("device_id"),
        F.concat(F.lit('{"is_small_window":"'), _text(_mod(i, 2)), F.lit('"}')).alias("ext"),
        F.when(_mod(i, 53) == 0, "null").when(_mod(i, 47) == 0, "")
        .otherwise(F.col("event_type")).alias("extra_id"),
        F.lit("app").alias("fr"),
        F.concat(F.lit("10.0.0."), _text(_mod("user_id", 256))).alias("ip"),
        F.when(_mod(i, 13) == 0, "").when(_mod(i, 5) == 0, "0").otherwise("1").alias("is_online"),
        "logtime",
        _text(_mod("user_id", 7)).alias("p_uid"),
        F.lit("hb").alias("record_type"),
        F.lit("").alias("refer"),
        F.lit("live").alias("source"),
        _pick(_mod(i, 3), (fixed.ROOM_VIDEO, fixed.ROOM_TEXT, fixed.BIG_LIVE)).alias("type"),
        F.lit("1").alias("u_type"),
        F.when(_mod(i, 7) == 0, "").otherwise(_text(F.col("user_id"))).alias("uid"),
        second.alias("second"),
    )


def heartbeat(spark: SparkSession, sf_dir: str, time_scale: int = 1) -> DataFrame:
    return heartbeat_rows(events(spark, sf_dir), time_scale).select(*fixed.HEARTBEAT_COLUMNS)


def heartbeat_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw heartbeat records: (event_id, body). Some are broken, some lack members."""
    rows = heartbeat_rows(events(spark, sf_dir))
    named = [F.col(c) for c in fixed.HEARTBEAT_COLUMNS if c not in ("logtime", "p_uid")]
    body = F.to_json(F.struct(
        *named, scalars.micro_text(F.col("logtime")).alias("logtime")))
    # to_json drops NULL members; p_uid is spelled out to carry a JSON null.
    p_uid = F.when(_mod("event_id", 9) == 0, "null").otherwise(
        F.concat(F.lit('"'), F.col("p_uid"), F.lit('"')))
    # Some records give a member twice; the last one counts.
    first = F.when(_mod("event_id", 29) == 0, '{"extra_id":"first","p_uid":').otherwise('{"p_uid":')
    body = F.concat(first, p_uid, F.lit(","), F.substr(body, F.lit(2)))
    return rows.select(
        "event_id",
        F.when(_mod("event_id", 37) == 0, F.concat(F.lit("["), body, F.lit("]")))
        .when(_mod("event_id", 41) == 0, F.expr("NULL"))
        .when(_mod("event_id", 43) == 0, F.concat(F.lit("not json "), body))
        .otherwise(body).alias("body"))


def _day_number(ts: Column) -> Column:
    return F.datediff(F.to_date(ts), F.to_date(F.lit(FIRST_DAY)))


def session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scheduled session per room and day, 09:00-21:00; every tenth lasts a minute.

    Grouping `events` is the only way to know which rooms and days exist. The
    result is written once per application and read back, so that the joins on
    it do not group `events` again.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _sessions:
        _sessions[key] = materialise(session_rows(events(spark, sf_dir)), "session")
    _utc(spark)
    return _sessions[key]


def session_rows(events: DataFrame) -> DataFrame:
    days = events.groupBy(
        F.col("event_type").alias("circle_id"),
        _day_number(F.col("ts")).cast("bigint").alias("day")).agg(F.count("*").alias("n"))
    # At most one row per room and day reaches this window.
    last = F.max("day").over(Window.partitionBy("circle_id"))
    room = (F.when(F.col("circle_id") == "click", 0).when(F.col("circle_id") == "error", 1)
            .when(F.col("circle_id") == "purchase", 2).when(F.col("circle_id") == "signup", 3)
            .otherwise(4))
    midnight = F.unix_seconds(F.lit(FIRST_DAY).cast("timestamp")) + F.col("day") * 86400
    start = F.timestamp_seconds(midnight + 9 * 3600)
    long_end = F.timestamp_seconds(midnight + 21 * 3600)
    short_end = F.timestamp_seconds(midnight + 9 * 3600 + 60)
    return (
        days.withColumn("last_day", last)
        .withColumn("id", F.col("day") * 5 + room)
        .select(
            "id", "circle_id",
            F.when(_mod("id", 37) == 0, 1).otherwise(2).alias("u_type"),
            _mod("id", 7).alias("uid"),
            F.concat(F.lit("live "), _text(F.col("id"))).alias("title"),
            start.alias("start_time"),
            F.when(_mod("id", 10) == 0, short_end).otherwise(long_end).alias("end_time"),
            F.when(F.col("day") == F.col("last_day"), 1)
            .when(_mod("id", 31) == 0, 2).otherwise(0).alias("live_status"),
            F.when(_mod("id", 41) == 0, 3).otherwise(4).alias("type"),
            F.when(_mod("id", 23) == 0, 0).otherwise(1).alias("audit"),
            F.when(_mod("id", 29) == 0, 1).otherwise(0).alias("status"),
        )
    )


def comment(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = "event_id"
    return events(spark, sf_dir).select(
        F.when(_mod(i, 7) == 0, fixed.PLANNER).otherwise(fixed.VIEWER).alias("u_type"),
        F.col("user_id").alias("uid"),
        _pick(_mod(i, 6), (0, 2, 8, 12, 13, 14)).alias("discussion_type"),
        F.when(_mod(i, 5) == 0, 1).otherwise(0).alias("is_robot"),
        _mod(i, 11).cast("int").alias("reply_id"),
        F.col("ts").alias("c_time"),
        F.col("event_type").alias("relation_id"),
    )


def income(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).where(F.col("event_type") == "purchase").select(
        _mod("user_id", 7).alias("p_uid"),
        F.col("value").alias("divide_money"),
        _mod("event_id", 2).cast("int").alias("status"),
        F.col("ts").alias("c_time"),
    )


def _quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), value, F.lit('"'))


def _title_member(turn: Column, key: str = "title") -> Column:
    """`,"title":...` with the four cases a title comes in: blank, null, missing, text."""
    return (
        F.when(turn % 7 == 0, f',"{key}":""').when(turn % 7 == 1, f',"{key}":null')
        .when(turn % 7 == 2, "")
        .otherwise(F.concat(F.lit(f',"{key}":"t'), _text(turn % 97), F.lit('"'))))


def _array_text(id_key: str, k: Column, c: Column, n: Column) -> Column:
    """A JSON array of n elements; n is at most 12, so the text stays small."""
    def element(i: Column) -> Column:
        return F.concat(
            F.lit(f'{{"{id_key}":"'), _text(c + i * i), F.lit('"'),
            _title_member(k + i), F.lit(',"tag_text":"tag'), _text(i % 3), F.lit('"}'))

    members = F.when(n > 0, F.transform(F.sequence(F.lit(1).cast("bigint"), n), element))
    return F.coalesce(F.array_join(members, ","), F.lit(""))


def api_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One API log per order, over 30 days. `variant` spreads the broken payloads."""
    _utc(spark)
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    rows = (
        spark.read.schema(ORDERS).parquet(f"{sf_dir}/orders.parquet")
        .select(
            "o_orderkey", "o_custkey",
            _pick(k % 11, fixed.API_ACTIONS).alias("action"),
            (F.floor(k / 11) % 13).alias("variant"),
            (F.floor("o_totalprice") % 13).alias("n"),
            F.timestamp_seconds(
                F.unix_seconds(F.lit(FIRST_DAY).cast("timestamp"))
                + F.datediff("o_orderdate", F.lit("1995-01-01").cast("date")) % 30 * 86400
                + k * 7919 % 86400).alias("log_time"),
        )
    )
    v, n, action = F.col("variant"), F.col("n"), F.col("action")

    def slot_array(id_key: str) -> Column:
        inner = _array_text(id_key, k, c, n)
        return (
            F.when(v == 4, '"oops"').when(v == 6, "null")
            .when((v == 5) & (n > 0), F.concat(F.lit("[null,"), inner, F.lit("]")))
            .when(v == 5, "[null]")
            .otherwise(F.concat(F.lit("["), inner, F.lit("]"))))

    def slot_object(extra: Column | None = None) -> Column:
        body = [F.lit('{"id":"'), _text(c), F.lit('"'), _title_member(k),
                F.lit(',"is_lock":"'), _text(k % 2), F.lit('","is_unlock":"'),
                _text(k % 3), F.lit('"')]
        if extra is not None:
            body += [F.lit(',"data":'), extra]
        return F.when(v == 6, "null").otherwise(F.concat(*body, F.lit("}")))

    # Texts used more than once are columns of their own, so they are built once.
    rows = rows.withColumn("arr", slot_array("id")).withColumn("obj", slot_object())
    arr, obj, stock = F.col("arr"), F.col("obj"), F.col("stock")
    rows = rows.withColumn("stock", slot_object(arr))
    index = F.concat(
        F.when(v == 8, "{").otherwise(F.concat(F.lit('{"banner":'), arr, F.lit(","))),
        F.when(v == 9, "").otherwise(F.concat(
            F.lit('"entrance":'), arr, F.lit(',"suspension":'), obj,
            F.lit(',"daily_gold_stock":'), stock,
            F.lit(',"channel_daily_gold_stock":'), stock,
            F.lit(',"index_special_stocks":'), obj, F.lit(","))),
        F.lit('"market_headlines":"m","index_banner":'), obj,
        F.lit(',"index_live_notice":'), obj,
        F.lit(',"index_recommend_live":'), arr, F.lit(',"index_type":"index"}'))
    p_uid = _pick(k % 3, (*fixed.LIVE_BALL_PLANNERS, "7"))
    inner = (
        F.when(action == "app/index", index)
        .when(action == "app/clientGuide", F.concat(
            F.lit('{"g_id":"'), _text(c), F.lit('"'), _title_member(k),
            F.lit(',"index_type":"guide"}')))
        .when(action == "app/startUpAds", F.concat(
            F.lit('{"ad":'), slot_array("adid"), F.lit(',"index_type":"ads"}')))
        .when(action == "app/newInfoCircle", F.concat(
            F.lit('{"planner":{"planner_info":{"p_uid":"'), p_uid,
            F.lit('","name":"n"}},"circle":{"red_packet":'), obj,
            F.lit('},"banner":'), arr, F.lit("}")))
        .when(action == "app/tuyereHotList", F.concat(F.lit('{"list":'), arr, F.lit("}")))
        .when((action == "app/homePage") & (v != 8),
              F.concat(F.lit('{"recommend":'), arr, F.lit("}")))
        .when(action == "app/homePage", F.concat(F.lit('{"other":'), arr, F.lit("}")))
        .when(action == "api/indexPlateInfo", F.concat(F.lit('{"route":'), obj, F.lit("}")))
        .when(action == "app/compositeVideo", F.concat(
            F.lit('{"banner":'), arr, F.lit(',"live":'), arr, F.lit("}")))
        .otherwise("{}"))
    payload = F.concat(F.lit('{"code":'), _text(k % 3), F.lit(',"msg":"ok","data":'),
                       F.when(v == 3, "null").otherwise(inner), F.lit("}"))
    data = (
        F.when(v == 0, F.expr("substring(payload, 1, length(payload) - 3)"))
        .when(v == 2, F.concat(F.lit("["), F.col("payload"), F.lit("]")))
        .when(v != 1, F.col("payload")))

    w = F.floor(k / 11) % 7
    beat = F.concat(
        F.lit('{"fr":'), F.when(w == 2, "null").otherwise('"app"'),
        F.lit(',"type":"'),
        _pick(k % 2, (fixed.ROOM_VIDEO, fixed.ROOM_TEXT)), F.lit('","extra_id":"r'),
        _text(c % 10), F.lit('","source":"s","is_small_window":"'), _text(k % 2),
        F.lit('","is_online":"1","p_uid":"'), _text(c % 7), F.lit('"}'))
    params = (
        F.when(action == fixed.HEARTBEAT_ACTION,
               F.when(w == 0, F.concat(F.lit('{"get":'), beat))
               .when(w == 1, '{"header":{"referer":"x"}}')
               .when(w == 2, F.concat(F.lit('{"get":'), beat, F.lit(',"header":null}')))
               .otherwise(F.concat(F.lit('{"get":'), beat, F.lit(',"header":{"referer":"ref'),
                                   _text(c % 10), F.lit('"}}'))))
        .when(action == fixed.DYNAMIC_DETAIL_ACTION,
              F.when(w == 0, '{"post":{}}').when(w == 1, '{"post":null,"x":"dynamic_id"}')
              .otherwise(F.concat(F.lit('{"post":{"dynamic_id":"'), _text(c % 50), F.lit('"}}'))))
        .when(action == fixed.VIEW_DETAIL_ACTION,
              F.when(w == 0, '{"get":{}}').when(w == 1, '{"x":"v_id"}')
              .otherwise(F.concat(F.lit('{"get":{"v_id":"'), _text(c % 50), F.lit('"}}')))))
    # A table has its texts ready; the one-element explode keeps conditions on the
    # text from being pushed into the expressions that build it.
    return rows.withColumn("payload", payload).select(
        "log_time", F.concat(F.lit("d"), _text(c)).alias("deviceId"), "action",
        F.explode(F.array(data)).alias("data"), params.alias("params"),
        F.when(k % 7 == 0, "").otherwise(_text(c)).alias("uid"),
        F.concat(F.lit("10.0.0."), _text(c % 256)).alias("client_ip"))


CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"


def room_comment_rows(conversations: DataFrame) -> DataFrame:
    odd = F.col("conv_id") + F.col("turn")
    at = F.timestamp_seconds(
        F.unix_seconds(F.lit(FIRST_DAY).cast("timestamp"))
        + F.col("conv_id") * 3600 + F.col("turn") * 60)
    return conversations.select(
        F.col("role").alias("uid"), F.col("role").alias("name"),
        _text(F.col("conv_id")).alias("relation_id"),
        F.when(odd % 13 == 0, "").otherwise(F.col("text")).alias("content"),
        F.when(odd % 11 == 0, "")
        .otherwise(scalars.local_to_iso(scalars.second_text(at))).alias("c_time"),
        F.concat(F.lit("title "), _text(_mod("conv_id", 5))).alias("title"))


def room_comment(spark: SparkSession, sf_dir: str) -> DataFrame:
    _utc(spark)
    return room_comment_rows(
        spark.read.schema(CONVERSATIONS).parquet(f"{sf_dir}/conversations.parquet"))


def room_comment_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    _utc(spark)
    return room_comment_rows(
        spark.readStream.schema(CONVERSATIONS).parquet(f"{sf_dir}/conversations.parquet*"))


def previous_snapshot(session: DataFrame) -> DataFrame:
    """Stored metric rows of the first days, plus keys the schedule no longer has.

    The last stored day still counts as running, so a refresh recomputes it.
    """
    day = _day_number(F.col("start_time"))
    kept = session.where(day < SNAPSHOT_DAYS)
    gone = kept.where(_mod("id", 10) == 3).withColumn("id", F.col("id") + 100000)
    rows = kept.unionByName(gone)

    def count(n: int) -> Column:
        return _mod("id", n)

    return rows.select(
        F.col("id").alias("live_id"), "circle_id", F.col("uid").alias("lcs_id"),
        F.lit(fixed.HOST_NAME).alias("lcs_name"), "start_time", "end_time",
        F.col("title").alias("live_title"),
        F.when(day == SNAPSHOT_DAYS - 1, 1).otherwise(0).alias("live_status"),
        *[count(3 + j).alias(name) for j, name in enumerate(
            fixed.SESSION_RECORD[8:22] + ("planner_comment_count", "planner_reply_count"))],
        *[(count(11 + j) / 4).alias(name) for j, name in enumerate(
            fixed.SESSION_RECORD[22:] + ("gift_income",))],
        F.lit("2024-01-15 00:00:00").cast("timestamp").alias("c_time"),
        F.lit("2024-01-15 00:00:00").cast("timestamp").alias("u_time"),
    )
