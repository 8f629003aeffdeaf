"""The same results in plain SQL over the given tables, for checking.

Nothing here is shared with the Spark code: the logical tables are derived again
in SQL, and what the jobs get by parsing JSON is computed without any JSON.
"""

from __future__ import annotations

VIDEO, TEXT, BIG = "'圈子视频直播'", "'圈子文字直播'", "'大直播'"
BASE = 1704067200000000  # 2024-01-01 00:00:00 in microseconds
CODE = f"CASE type WHEN {VIDEO} THEN 0 WHEN {TEXT} THEN 1 WHEN {BIG} THEN 2 ELSE 3 END"


def sec_text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def day_text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d')"


def micro_text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"


# The day of a client's clock text, or of the arrival where that is none or a day off.
CLIENT_DAY = """strftime(CASE WHEN abs(epoch_us(try_cast(h.c_time AS TIMESTAMP)) // 1000000
          - epoch_us(h.logtime) // 1000000) <= 86400 THEN CAST(h.c_time AS TIMESTAMP)
          ELSE h.logtime END, '%Y-%m-%d')"""


def hb(scale: int = 1) -> str:
    at = "ts" if scale == 1 else \
        f"make_timestamp({BASE} + (epoch_us(ts) - {BASE}) // {scale})"
    return f"""hb AS (
  SELECT event_id, CASE WHEN event_id % 29 = 0 THEN ''
      WHEN event_id % 31 = 0 THEN CAST(epoch_us(t) // 1000000 AS VARCHAR)
      WHEN event_id % 37 = 0 THEN {sec_text('t - INTERVAL 40 DAY')}
      WHEN event_id % 19 = 0 THEN {sec_text('t - INTERVAL 2 HOUR')}
      WHEN event_id % 23 = 0 THEN {sec_text('t + INTERVAL 90 MINUTE')}
      ELSE {sec_text('t')} END AS c_time,
    CASE WHEN event_id % 11 = 0 THEN '' ELSE 'd' || regexp_extract(props, '[0-9]+') END AS device_id,
    '{{"is_small_window":"' || CAST(event_id % 2 AS VARCHAR) || '"}}' AS ext,
    CASE WHEN event_id % 53 = 0 THEN 'null' WHEN event_id % 47 = 0 THEN '' ELSE event_type END AS extra_id,
    'app' AS fr, '10.0.0.' || CAST(user_id % 256 AS VARCHAR) AS ip,
    CASE WHEN event_id % 13 = 0 THEN '' WHEN event_id % 5 = 0 THEN '0' ELSE '1' END AS is_online,
    t AS logtime, CAST(user_id % 7 AS VARCHAR) AS p_uid, 'hb' AS record_type, '' AS refer,
    'live' AS source,
    CASE event_id % 3 WHEN 0 THEN {VIDEO} WHEN 1 THEN {TEXT} ELSE {BIG} END AS type,
    '1' AS u_type,
    CASE WHEN event_id % 7 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS uid,
    CASE WHEN event_id % 4 = 2 AND event_id % 17 = 0 THEN '1.5' WHEN event_id % 4 = 1 THEN ''
         WHEN event_id % 4 >= 2 THEN CAST(CAST(floor(value) AS BIGINT) % 60 AS VARCHAR) END AS "second"
  FROM (SELECT *, {at} AS t FROM events))"""


QUICK = 5000

SES = f"""days AS (
  SELECT event_type AS circle_id, datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS d
  FROM events GROUP BY 1, 2),
ses AS (
  SELECT id, circle_id, CASE WHEN id % 37 = 0 THEN 1 ELSE 2 END AS u_type, id % 7 AS uid,
    'live ' || CAST(id AS VARCHAR) AS title, make_timestamp(nine) AS start_time,
    make_timestamp(nine + CASE WHEN id % 10 = 0 THEN 60000000 ELSE 43200000000 END) AS end_time,
    CASE WHEN d = last_day THEN 1 WHEN id % 31 = 0 THEN 2 ELSE 0 END AS live_status,
    CASE WHEN id % 41 = 0 THEN 3 ELSE 4 END AS type, CASE WHEN id % 23 = 0 THEN 0 ELSE 1 END AS audit,
    CASE WHEN id % 29 = 0 THEN 1 ELSE 0 END AS status, d
  FROM (SELECT *, {BASE} + d * 86400000000 + 32400000000 AS nine,
      max(d) OVER (PARTITION BY circle_id) AS last_day,
      d * 5 + CASE circle_id WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2
        WHEN 'signup' THEN 3 ELSE 4 END AS id FROM days)),
el AS (SELECT * FROM ses WHERE live_status IN (0, 1) AND u_type = 2 AND type = 4 AND audit = 1 AND status = 0)"""

COM = """com AS (
  SELECT CASE WHEN event_id % 7 = 0 THEN 2 ELSE 1 END AS u_type, user_id AS uid,
    CASE event_id % 6 WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 8 WHEN 3 THEN 12 WHEN 4 THEN 13 ELSE 14 END
      AS discussion_type,
    CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS is_robot, CAST(event_id % 11 AS INTEGER) AS reply_id,
    ts AS c_time, event_type AS relation_id FROM events)"""

INC = """inc AS (
  SELECT user_id % 7 AS p_uid, value AS divide_money, CAST(event_id % 2 AS INTEGER) AS status, ts AS c_time
  FROM events WHERE event_type = 'purchase')"""

PREVIOUS_COUNTS = (
    "view_count", "view_count_robot", "first_view_count", "max_living_count",
    "new_follow_count", "new_follow_count_robot", "comment_count", "comment_count_robot",
    "comment_peoples", "comment_peoples_robot", "gift_count", "gift_count_robot",
    "share_count", "share_count_robot", "planner_comment_count", "planner_reply_count")
DWELL = ("old_user_staying_average", "old_user_staying_max", "old_user_staying_min",
         "new_user_staying_average", "new_user_staying_max", "new_user_staying_min")
# Names of the data contract.
METRIC_COLUMNS = [
    "live_id", "circle_id", "lcs_id", "lcs_name", "start_time", "end_time", "live_title",
    "live_status", "view_count", "view_count_robot", "first_view_count", "max_living_count",
    "new_follow_count", "new_follow_count_robot", "comment_count", "comment_count_robot",
    "comment_peoples", "comment_peoples_robot", "gift_count", "gift_count_robot", "share_count",
    "share_count_robot", "old_user_staying_average", "old_user_staying_max", "old_user_staying_min",
    "new_user_staying_average", "new_user_staying_max", "new_user_staying_min", "gift_income",
    "planner_comment_count", "planner_reply_count",
]
LIVE_INFO = [
    "circle_id", "notice_id", "p_uid", "live_title", "view_count", "first_view_count",
    "max_living_count", "new_follow_count", "comment_count", "comment_peoples", "gift_count",
    "share_count", "old_user_staying_average", "old_user_staying_max", "old_user_staying_min",
    "new_user_staying_average", "new_user_staying_max", "new_user_staying_min",
    "planner_comment_count", "planner_reply_count", "view_count_robot", "new_follow_count_robot",
    "comment_count_robot", "comment_peoples_robot", "gift_count_robot", "share_count_robot",
]


def _previous() -> str:
    counts = ", ".join(f"id % {3 + j} AS {c}" for j, c in enumerate(PREVIOUS_COUNTS))
    reals = ", ".join(f"(id % {11 + j}) / 4.0::DOUBLE AS {c}"
                      for j, c in enumerate((*DWELL, "gift_income")))
    return f"""prev AS (
  SELECT id AS live_id, circle_id, uid AS lcs_id, '#' AS lcs_name, start_time, end_time,
    title AS live_title, CASE WHEN d = 14 THEN 1 ELSE 0 END AS live_status, {counts}, {reals}
  FROM (SELECT * FROM ses WHERE d < 15 UNION ALL
        SELECT * REPLACE (id + 100000 AS id) FROM ses WHERE d < 15 AND id % 10 = 3))"""


PREV = _previous()


def views(src: str = "el", end: str = "end_time", earlier: str = "") -> str:
    """vd: viewer rows; vn: with newness; vm: per session. `earlier` adds viewers seen before."""
    halves = ", ".join(
        f"{fn}(CASE WHEN {cond} THEN dwell END) AS {name}_user_staying_{out}"
        for name, cond in (("old", "NOT is_new"), ("new", "is_new"))
        for fn, out in (("avg", "average"), ("max", "max"), ("min", "min")))
    return f"""vd AS (
  SELECT s.id AS live_id, h.extra_id, h.uid, h.device_id, min(s.start_time) AS ws, max(s.{end}) AS we,
    CAST(sum(CASE WHEN regexp_full_match(coalesce("second", ''), '[+-]?[0-9]+')
                  THEN coalesce(TRY_CAST("second" AS INTEGER), 30) ELSE 30 END) AS BIGINT) AS dwell,
    min(h.logtime) AS first_at
  FROM hb h JOIN {src} s ON h.extra_id = s.circle_id AND h.logtime BETWEEN s.start_time AND s.{end}
  WHERE h.type = {VIDEO} AND h.device_id <> '' GROUP BY 1, 2, 3, 4),
fs AS (SELECT extra_id, uid, min(first_at) AS f
  FROM (SELECT extra_id, uid, first_at FROM vd {earlier}) WHERE uid <> '' GROUP BY 1, 2),
vn AS (SELECT vd.*, coalesce(vd.uid <> '' AND fs.f BETWEEN ws AND we, FALSE) AS is_new
  FROM vd LEFT JOIN fs ON vd.extra_id = fs.extra_id AND vd.uid = fs.uid),
vm AS (SELECT live_id, count(DISTINCT device_id) AS view_count,
    count(DISTINCT CASE WHEN is_new THEN uid END) AS first_view_count,
    CAST(ceil(count(*) * 0.13::DOUBLE) AS BIGINT) AS peak, {halves} FROM vn GROUP BY 1)"""


def comments(src: str = "el", end: str = "end_time", viewer_only: bool = True) -> str:
    who = "u_type = 1 AND " if viewer_only else ""

    def pair(name: str, cond: str) -> str:
        return (f"count(*) FILTER (WHERE {who}{cond} AND is_robot = 0) AS {name}, "
                f"count(*) FILTER (WHERE {who}{cond} AND is_robot = 1) AS {name}_robot")

    people = ", ".join(
        f"count(DISTINCT c.uid) FILTER (WHERE {who}discussion_type = 0 AND is_robot = {r}) AS {n}"
        for r, n in ((0, "comment_peoples"), (1, "comment_peoples_robot")))
    return f"""cs AS (
  SELECT s.id AS live_id, c.* FROM com c JOIN {src} s
    ON c.relation_id = s.circle_id AND c.c_time BETWEEN s.start_time AND s.{end}),
cm AS (SELECT live_id, count(*) FILTER (WHERE is_robot = 1) AS view_count_robot,
    {pair('new_follow_count', 'discussion_type = 14')}, {pair('comment_count', 'discussion_type = 0')},
    {people}, {pair('gift_count', 'discussion_type = 8')},
    {pair('share_count', 'discussion_type IN (2, 12, 13)')},
    count(*) FILTER (WHERE c.u_type = 2 AND discussion_type = 0 AND reply_id = 0) AS planner_comment_count,
    count(*) FILTER (WHERE c.u_type = 2 AND discussion_type = 0 AND reply_id <> 0) AS planner_reply_count
  FROM cs c GROUP BY 1)"""


def gifts(src: str = "el") -> str:
    return f"""gm AS (SELECT s.id AS live_id, round(sum(divide_money), 2) AS gift_income
  FROM inc i JOIN {src} s ON i.p_uid = s.uid AND i.c_time BETWEEN s.start_time AND s.end_time
  WHERE i.status = 0 GROUP BY 1)"""


def capped(end: str = "end_time", s: str = "s") -> list[str]:
    span = f"date_diff('second', {s}.start_time, {s}.{end})"
    out = []
    for c in DWELL:
        if c.endswith("average"):
            out.append(f"least(coalesce(vm.{c}, 0::DOUBLE), CAST({span} AS DOUBLE)) AS {c}")
        else:
            out.append(f"least(coalesce(vm.{c}, 0), {span}) AS {c}")
    return out


def metrics(src: str = "el", end: str = "end_time", peak: str = "coalesce(peak, 0)",
            extra: str = "", earlier: str = "") -> str:
    """CTEs ending in sm, the session record of every session of `src`."""
    zeros = {c: f"coalesce({c}, 0) AS {c}" for c in METRIC_COLUMNS}
    zeros |= dict(zip(DWELL, capped(end), strict=True))
    zeros |= {"live_id": "s.id AS live_id", "circle_id": "s.circle_id", "lcs_id": "s.uid AS lcs_id",
              "lcs_name": "'#' AS lcs_name", "start_time": "s.start_time", "end_time": "s.end_time",
              "live_title": "s.title AS live_title", "live_status": "s.live_status",
              "max_living_count": f"{peak} AS max_living_count",
              "gift_income": "coalesce(gift_income, 0.0::DOUBLE) AS gift_income"}
    return f"""{views(src, end, earlier)}, {comments(src, end)}, {gifts(src)},
sm AS (SELECT {', '.join(zeros[c] for c in METRIC_COLUMNS)} FROM {src} s
  LEFT JOIN vm ON s.id = vm.live_id LEFT JOIN cm ON s.id = cm.live_id
  LEFT JOIN gm ON s.id = gm.live_id {extra})"""


TABLES = f"{hb()}, {SES}, {COM}, {INC}"
BASE_METRICS = f"WITH {TABLES}, {metrics()}"


def times(columns: list[str], alias: str = "") -> str:
    """The columns with both session times as text."""
    return ", ".join(
        f"{sec_text(alias + c)} AS {c}" if c in ("start_time", "end_time", "c_time", "u_time")
        else f"{alias}{c}" for c in columns)


def sm_text(c: str) -> str:
    return sec_text(c) if c in ("start_time", "end_time") else f"CAST({c} AS VARCHAR)"


def json_of(columns: list[str], text=sm_text) -> str:
    members = " || ',' || ".join(f"""'"{c}":"' || {text(c)} || '"'""" for c in columns)
    return f"'{{' || {members} || '}}'"


ROLLUP = ("view_count", "view_count_robot", "max_living_count", "comment_count",
          "comment_count_robot", "comment_peoples", "comment_peoples_robot")


def rollup() -> str:
    sums = ", ".join(
        f"CAST({'max' if c == 'max_living_count' else 'sum'}(coalesce(m.{c}, 0)) AS BIGINT) AS {c}"
        for c in ROLLUP)
    return f"""pr AS (SELECT e.uid AS lcs_id, count(*) AS notice_num,
    CAST(sum(coalesce(date_diff('second', m.start_time, m.end_time), 0)) AS BIGINT) AS live_times,
    {sums}, round(sum(coalesce(m.gift_income, 0)), 2) AS gift_income
  FROM el e LEFT JOIN sm m ON e.id = m.live_id GROUP BY 1)"""


PLANNER = ["notice_num", "live_times", "view_count", "view_count_robot", "max_living_count",
           "comment_count", "comment_count_robot", "comment_peoples", "comment_peoples_robot",
           "gift_income"]


def plain_text(c: str) -> str:
    return f"CAST({c} AS VARCHAR)"


_FINISHED = f"""UNION ALL SELECT h.extra_id, h.uid, h.logtime FROM hb h JOIN ses s
  ON h.extra_id = s.circle_id AND h.logtime BETWEEN s.start_time AND s.end_time
  WHERE h.type = {VIDEO} AND h.device_id <> ''
    AND s.id IN (SELECT live_id FROM prev WHERE live_status = 0)"""

# Sessions a refresh recomputes, with running ones reaching to `now`.
REFRESH = f"""WITH {TABLES}, {PREV},
nw AS (SELECT date_trunc('second', max(logtime)) AS n FROM hb),
op AS (SELECT s.*, CASE WHEN s.live_status = 1 THEN nw.n ELSE s.end_time END AS eff
  FROM ses s, nw WHERE s.live_status IN (0, 1) AND s.end_time > date_trunc('day', nw.n)
    AND s.id NOT IN (SELECT live_id FROM prev WHERE live_status = 0)),
cur AS (SELECT extra_id, count(DISTINCT type || '/' || device_id || '/' || uid) AS c FROM hb, nw
  WHERE logtime BETWEEN n - INTERVAL 60 SECOND AND n AND type IN ({VIDEO}, {TEXT}) GROUP BY 1),
{metrics('op', 'eff', 'greatest(coalesce(cur.c, 0), coalesce(prev.max_living_count, 0))',
         'LEFT JOIN cur ON s.circle_id = cur.extra_id LEFT JOIN prev ON s.id = prev.live_id',
         _FINISHED)}""" \
    .replace("coalesce(gift_income, 0.0::DOUBLE)", "coalesce(gm.gift_income, 0.0::DOUBLE)")
for _c in PREVIOUS_COUNTS:
    _t = "vm" if _c in ("view_count", "first_view_count") else "cm"
    REFRESH = REFRESH.replace(f"coalesce({_c}, 0) AS {_c}", f"coalesce({_t}.{_c}, 0) AS {_c}")


def presence(scale: int = QUICK) -> str:
    return f"""WITH {hb(scale)},
pres AS (SELECT extra_id, type, CASE WHEN uid <> '' THEN uid ELSE device_id END AS viewer, logtime, c_time
  FROM hb WHERE extra_id NOT IN ('', 'null') AND (uid <> '' OR device_id <> '') AND is_online = '1')"""


ONLINE = f"""{presence()},
on_ AS (SELECT make_timestamp(((epoch_us(logtime) // 10000000) + 1 + i) * 10000000) AS window_end,
    extra_id, type, count(DISTINCT viewer) AS online
  FROM pres, range(0, 6) r(i) GROUP BY 1, 2, 3)"""

POINTS = f"""pd AS (SELECT extra_id, type, count(*) AS points, count(DISTINCT device_id) AS device_id_count
  FROM hb WHERE is_online = '1' AND type IN ({VIDEO}, {TEXT}) GROUP BY 1, 2)"""
AVERAGE = """av AS (SELECT extra_id, type, points * 30 // device_id_count AS average FROM pd
  WHERE extra_id NOT IN ('', 'null') AND device_id_count > 0)"""
# The average does not depend on the clock, so the squeezed heartbeats serve.
WITH_AVERAGE = f"""{ONLINE}, {POINTS}, {AVERAGE}"""

GAPS = f"""{presence()},
secs AS (SELECT DISTINCT CAST(logtime AS DATE) AS day, extra_id, type, viewer,
    epoch_us(logtime) // 1000000 AS s FROM pres),
gaps AS (SELECT *, s - lag(s) OVER (PARTITION BY day, extra_id, type, viewer ORDER BY s) AS g FROM secs),
dw AS (SELECT day, extra_id, type, viewer, max(s) AS last_s,
    CAST(sum(CASE WHEN g IS NULL THEN 0 WHEN g <= 31 THEN g ELSE 15 END) AS BIGINT) AS inner_s
  FROM gaps GROUP BY 1, 2, 3, 4)"""

ACTIONS = ("app/index", "app/clientGuide", "app/startUpAds", "app/newInfoCircle",
           "app/tuyereHotList", "app/homePage", "api/indexPlateInfo", "app/compositeVideo",
           "app/realTimeCount", "api/fortuneCircleDynamicDetail", "api/getViewDetail")


def _title(turn: str, key: str = "title") -> str:
    return (f"""CASE ({turn}) % 7 WHEN 0 THEN ',"{key}":""' WHEN 1 THEN ',"{key}":null' WHEN 2 THEN '' """
            f"""ELSE ',"{key}":"t' || CAST(({turn}) % 97 AS VARCHAR) || '"' END""")


def _title_value(turn: str) -> str:
    return (f"CASE ({turn}) % 7 WHEN 0 THEN '' WHEN 1 THEN 'null' WHEN 2 THEN '' "
            f"ELSE 't' || CAST(({turn}) % 97 AS VARCHAR) END")


def _elem(id_key: str) -> str:
    return (f"""'{{"{id_key}":"' || CAST(c + i * i AS VARCHAR) || '"' || {_title('k + i')} || """
            f"""',"tag_text":"tag' || CAST(i % 3 AS VARCHAR) || '"}}'""")


def _array(id_key: str) -> str:
    members = f"coalesce(array_to_string([{_elem(id_key)} for i in range(1, n + 1)], ','), '')"
    return (f"""CASE WHEN v = 4 THEN '"oops"' WHEN v = 6 THEN 'null' """
            f"""WHEN v = 5 AND n > 0 THEN '[null,' || {members} || ']' WHEN v = 5 THEN '[null]' """
            f"""ELSE '[' || {members} || ']' END""")


_ACTION = "CASE o_orderkey % 11 " + " ".join(
    f"WHEN {i} THEN '{a}'" for i, a in enumerate(ACTIONS)) + " END"
_OBJ_BODY = (f"""'{{"id":"' || CAST(c AS VARCHAR) || '"' || {_title('k')} || ',"is_lock":"' || """
             """CAST(k % 2 AS VARCHAR) || '","is_unlock":"' || CAST(k % 3 AS VARCHAR) || '"'""")

_LOG_TIME = ("TIMESTAMP '2024-01-01 00:00:00' + to_seconds(datediff('day', DATE '1995-01-01', "
             "CAST(o_orderdate AS DATE)) % 30 * 86400 + o_orderkey * 7919 % 86400)")

# obj, arr, inner, payload: the texts a log is made of; ok: the payload parses.
API = f"""api0 AS (
  SELECT o_orderkey AS k, o_custkey AS c, {_ACTION} AS action, (o_orderkey // 11) % 13 AS v,
    (o_orderkey // 11) % 7 AS w, CAST(floor(o_totalprice) AS BIGINT) % 13 AS n,
    {sec_text(_LOG_TIME)} AS log_time FROM orders),
api1 AS (SELECT *, 'd' || CAST(c AS VARCHAR) AS "deviceId", CAST(k % 3 AS VARCHAR) AS code,
    {_title_value('k')} AS otitle, {_array('id')} AS arr, {_array('adid')} AS ads,
    CASE WHEN v = 6 THEN 'null' ELSE {_OBJ_BODY} || '}}' END AS obj FROM api0),
api2 AS (SELECT *, CASE WHEN v = 6 THEN 'null' ELSE {_OBJ_BODY} || ',"data":' || arr || '}}' END AS stock
  FROM api1),
api3 AS (SELECT *, CASE action
    WHEN 'app/index' THEN CASE WHEN v = 8 THEN '{{' ELSE '{{"banner":' || arr || ',' END
      || CASE WHEN v = 9 THEN '' ELSE '"entrance":' || arr || ',"suspension":' || obj
        || ',"daily_gold_stock":' || stock || ',"channel_daily_gold_stock":' || stock
        || ',"index_special_stocks":' || obj || ',' END
      || '"market_headlines":"m","index_banner":' || obj || ',"index_live_notice":' || obj
      || ',"index_recommend_live":' || arr || ',"index_type":"index"}}'
    WHEN 'app/clientGuide' THEN '{{"g_id":"' || CAST(c AS VARCHAR) || '"' || {_title('k')}
      || ',"index_type":"guide"}}'
    WHEN 'app/startUpAds' THEN '{{"ad":' || ads || ',"index_type":"ads"}}'
    WHEN 'app/newInfoCircle' THEN '{{"planner":{{"planner_info":{{"p_uid":"'
      || CASE k % 3 WHEN 0 THEN '1625572687' WHEN 1 THEN '71585119812862' ELSE '7' END
      || '","name":"n"}}}},"circle":{{"red_packet":' || obj || '}},"banner":' || arr || '}}'
    WHEN 'app/tuyereHotList' THEN '{{"list":' || arr || '}}'
    WHEN 'app/homePage' THEN CASE WHEN v = 8 THEN '{{"other":' ELSE '{{"recommend":' END || arr || '}}'
    WHEN 'api/indexPlateInfo' THEN '{{"route":' || obj || '}}'
    WHEN 'app/compositeVideo' THEN '{{"banner":' || arr || ',"live":' || arr || '}}'
    ELSE '{{}}' END AS inner_ FROM api2),
api4 AS (SELECT *, '{{"code":' || code || ',"msg":"ok","data":'
    || CASE WHEN v = 3 THEN 'null' ELSE inner_ END || '}}' AS payload FROM api3),
api AS (SELECT *, CASE v WHEN 0 THEN substring(payload, 1, length(payload) - 3)
    WHEN 1 THEN NULL WHEN 2 THEN '[' || payload || ']' ELSE payload END AS data,
    v NOT IN (0, 1, 2) AS ok, v NOT IN (0, 1, 2, 3) AS page FROM api4)"""

# Elements of the slot arrays that are read: pseudo elements have the text {}.
ELEMS = f"""els AS (
  SELECT k, i, CAST(c + i * i AS VARCHAR) AS id, {_title_value('k + i')} AS title,
    'tag' || CAST(i % 3 AS VARCHAR) AS tag, {_elem('id')} AS elem, {_elem('adid')} AS ad
  FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM api0 WHERE v NOT IN (4, 6))
  UNION ALL SELECT k, 0, '', '', '', '{{}}', '{{}}' FROM api0 WHERE v IN (4, 5))"""

SLOT_COLUMNS = '"deviceId", log_time, action, data, type, id, title, code, index_type, is_lock'


def _slot(label: str, where: str, *, data: str = "obj", id_: str = "''", title: str = "otitle",
          code: str = "code", index_type: str = "''", is_lock: str = "''",
          source: str = "api") -> str:
    return (f"SELECT \"deviceId\", log_time, action, {data} AS data, '{label}' AS type, {id_} AS id, "
            f"{title} AS title, {code} AS code, {index_type} AS index_type, {is_lock} AS is_lock "
            f"FROM {source} WHERE {where}")


_OBJ = "CASE WHEN ok THEN obj ELSE '' END"
_OBJ_TITLE = "CASE WHEN ok AND v <> 6 THEN otitle ELSE '' END"
_CODE = "CASE WHEN ok THEN code ELSE '' END"
_INNER = "CASE WHEN v = 3 THEN 'null' WHEN ok THEN inner_ ELSE '' END"
_PAGE_INDEX = "CASE WHEN ok THEN 'index' ELSE '' END"
_JOINED = "api JOIN els USING (k)"
_NO_TITLE = "CAST(NULL AS VARCHAR)"

SLOTS = {
    "slot_client_guide": _slot(
        "clientGuide", "action = 'app/clientGuide' AND page AND otitle <> ''", data="data",
        id_="CAST(c AS VARCHAR)", index_type="'guide'"),
    "slot_startup_ads": _slot(
        "startUpAds", "action = 'app/startUpAds' AND page AND title <> ''", data="ad", id_="id",
        title="title", index_type="'ads'", source=_JOINED),
    "slot_floating_ball": _slot(
        "xuanfuqiu", "action = 'app/index' AND v NOT IN (1, 3, 9)", data=_OBJ, title=_OBJ_TITLE,
        code=_CODE),
    "slot_banner": _slot(
        "banner", "action = 'app/index' AND page AND v <> 8 AND title <> ''", data="elem", id_="id",
        title="title", index_type="'index'", source=_JOINED),
    "slot_entrance": _slot(
        "entrance", "action = 'app/index' AND page AND v <> 9 AND title <> ''", data="elem",
        id_="id", title="title", index_type="'index'", source=_JOINED),
    "slot_daily_stock": _slot(
        "daily_gold_stock", "action = 'app/index' AND page AND v <> 9 AND otitle <> ''", data="elem",
        id_="id", index_type="'index'", source=_JOINED),
    "slot_channel_stock": _slot(
        "channel_daily_gold_stock", "action = 'app/index' AND page AND v <> 9 AND otitle <> ''",
        data="elem", id_="id", index_type="'index'", is_lock="CAST(k % 2 AS VARCHAR)",
        source=_JOINED),
    "slot_live_ball": _slot(
        "live_xuanfuqiu",
        "action = 'app/newInfoCircle' AND page AND v <> 6 AND otitle <> '' AND k % 3 < 2",
        id_="CASE k % 3 WHEN 0 THEN '1625572687' ELSE '71585119812862' END"),
    "slot_hot_list": _slot(
        "index_tuyereHotList", "action = 'app/tuyereHotList'", data=_INNER, title=_NO_TITLE,
        code=_CODE),
    "slot_special_stocks": _slot(
        "index_special_stocks", "action = 'app/index' AND v NOT IN (1, 3, 9)", data=_OBJ,
        title=_NO_TITLE, code=_CODE, index_type=_PAGE_INDEX,
        is_lock="CASE WHEN ok AND v <> 6 THEN CAST(k % 3 AS VARCHAR) ELSE '' END"),
    "slot_market": _slot(
        "index_market", "action = 'app/homePage' AND v NOT IN (1, 3, 8)", data=_INNER,
        title=_NO_TITLE, code=_CODE),
    "slot_headlines": _slot(
        "index_market_headlines", "action = 'app/index' AND v NOT IN (1, 3)", data=_INNER,
        title=_NO_TITLE, code=_CODE),
    "slot_hot_button": _slot(
        "tuyereHotList_button", "action = 'api/indexPlateInfo' AND v NOT IN (1, 3)", data=_INNER,
        title=_NO_TITLE, code=_CODE),
    "slot_top_banner": _slot(
        "index_top_banner", "action = 'app/index' AND page AND v <> 6"),
    "slot_live_tab_banner": _slot(
        "live_tab_recommend_banner", "action = 'app/compositeVideo' AND page", data="elem",
        id_="id", title="title", source=_JOINED),
    "slot_planner_banner": _slot(
        "lcs_main_banner", "action = 'app/newInfoCircle' AND page", data="elem", id_="id",
        title="title", source=_JOINED),
    "slot_live_notice": _slot(
        "index_live_notice", "action = 'app/index' AND v NOT IN (1, 3)", data=_OBJ,
        id_="CASE WHEN ok AND v <> 6 THEN CAST(c AS VARCHAR) ELSE '' END", title=_OBJ_TITLE,
        code=_CODE),
    "slot_recommend_live": _slot(
        "index_recommend_live", "action = 'app/index' AND page", data="elem", id_="id",
        title="title", index_type="tag", source=_JOINED),
    "slot_live_tab_live": _slot(
        "live_tab_recommend_live", "action = 'app/compositeVideo' AND page", data="elem",
        id_="id", title="title", source=_JOINED),
}
ALL_SLOTS = f"WITH {API}, {ELEMS}, se AS ({' UNION ALL '.join(SLOTS.values())})"

_GET = "w <> 1 AND w <> 0"
REPAIR = f"""SELECT CASE WHEN {_GET} THEN CASE k % 2 WHEN 0 THEN {VIDEO} ELSE {TEXT} END ELSE '' END AS type,
    CASE WHEN {_GET} THEN 'r' || CAST(c % 10 AS VARCHAR) ELSE '' END AS extra_id,
    CASE WHEN {_GET} THEN '1' ELSE '' END AS is_online,
    CASE WHEN w = 2 THEN 'null' WHEN {_GET} THEN 'app' ELSE '' END AS fr,
    CASE WHEN {_GET} THEN CAST(c % 7 AS VARCHAR) ELSE '' END AS p_uid,
    CASE WHEN {_GET} THEN 's' ELSE '' END AS source,
    CASE WHEN k % 7 = 0 THEN '' ELSE CAST(c AS VARCHAR) END AS uid, 1 AS u_type,
    CASE WHEN w = 1 THEN 'x' WHEN w IN (0, 2) THEN '' ELSE 'ref' || CAST(c % 10 AS VARCHAR) END AS refer,
    "deviceId" AS device_id, log_time AS c_time, '10.0.0.' || CAST(c % 256 AS VARCHAR) AS ip,
    replace(log_time, ' ', 'T') || '+00:00' AS logtime,
    '{{"is_small_window":"' || CASE WHEN {_GET} THEN CAST(k % 2 AS VARCHAR) ELSE '' END || '"}}' AS ext,
    '1' AS is_insert FROM api WHERE action = 'app/realTimeCount'"""

# A payload that fails to parse still mentions the member name, so it is counted under ''.
PAGE_KEY = """CASE WHEN v IN (0, 2) THEN '' WHEN k % 3 = 0 THEN '1625572687'
  WHEN k % 3 = 1 THEN '71585119812862' ELSE '7' END"""


def pv_uv(key: str, expr: str, where: str) -> str:
    return f"""WITH {API} SELECT substring(log_time, 1, 10) AS date, {expr} AS {key},
  count(DISTINCT "deviceId") AS uv, count(*) AS pv FROM api WHERE {where} GROUP BY 1, 2"""


PLANNER_PAGES = pv_uv("puid", PAGE_KEY, "action = 'app/newInfoCircle' AND v NOT IN (1, 3)")
_DETAIL_KEY = "CASE WHEN w = 1 THEN '' ELSE CAST(c % 50 AS VARCHAR) END"

CONV = """rc AS (SELECT role AS uid, role AS name, CAST(conv_id AS VARCHAR) AS relation_id,
    CASE WHEN (conv_id + turn) % 13 = 0 THEN '' ELSE text END AS content,
    CASE WHEN (conv_id + turn) % 11 = 0 THEN '' ELSE strftime(TIMESTAMP '2024-01-01 00:00:00'
      + to_seconds(conv_id * 3600 + turn * 60), '%Y-%m-%d %H:%M:%S') END AS c_time,
    'title ' || CAST(conv_id % 5 AS VARCHAR) AS title FROM conversations)"""
COMMENT_FEED = f"WITH {CONV} SELECT * FROM rc WHERE content <> '' AND c_time <> ''"
HEARTBEAT_FEED = "SELECT extra_id, {code} AS type, viewer AS uid, c_time FROM pres".format(code=CODE)


def coverage(seconds: int) -> str:
    def clock(x: str) -> str:
        return f"printf('%02d:%02d:%02d', ({x}) // 3600, ({x}) // 60 % 60, ({x}) % 60)"
    return f"""WITH d AS (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM events),
spine AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS dt FROM d),
sl AS (SELECT dt, i FROM spine, range(0, {86400 // seconds}) r(i)),
n AS (SELECT CAST(ts AS DATE) AS dt,
    date_diff('second', date_trunc('day', ts), date_trunc('second', ts)) // {seconds} AS i,
    count(*) AS n FROM events GROUP BY 1, 2)
SELECT strftime(sl.dt, '%Y-%m-%d') AS dt, {clock(f'sl.i * {seconds}')} AS slice_from,
  {clock(f'(sl.i + 1) * {seconds}')} AS slice_to, coalesce(n.n, 0) AS n
FROM sl LEFT JOIN n ON sl.dt = n.dt AND sl.i = n.i"""


HB_COLUMNS = ["c_time", "device_id", "ext", "extra_id", "fr", "ip", "is_online", "logtime", "p_uid",
              "record_type", "refer", "source", "type", "u_type", "uid", "second"]
_BROKEN = "event_id % 37 = 0 OR event_id % 41 = 0 OR event_id % 43 = 0"


def flat(c: str) -> str:
    value = f'coalesce("{c}", \'\')'
    if c == "p_uid":
        value = "CASE WHEN event_id % 9 = 0 THEN 'null' ELSE p_uid END"
    if c == "logtime":
        value = micro_text("logtime")
    return f"CASE WHEN {_BROKEN} THEN '' ELSE {value} END AS \"{c}\""


LIVE_NAMES = {"notice_id": "live_id", "p_uid": "lcs_id"}


def upsert_value(c: str) -> str:
    src = LIVE_NAMES.get(c, c)
    return f"CASE WHEN n.live_id IS NOT NULL THEN n.{src} ELSE o.{src} END AS {c}"


def within(table: str, at: str, closed: bool = False) -> str:
    """Between the last rows of the 5th and of the 20th: the first is in, the last if closed."""
    def last(day: int) -> str:
        return f"(SELECT max({at}) FROM {table} WHERE day(CAST({at} AS TIMESTAMP)) = {day})"
    return f"{at} >= {last(5)} AND {at} {'<=' if closed else '<'} {last(20)}"


SECONDS_OF_DAY = "date_diff('second', date_trunc('day', ts), date_trunc('second', ts))"

ORACLES = {
    "session_metrics": f"{BASE_METRICS} SELECT {times(METRIC_COLUMNS)} FROM sm",
    "session_view_metrics": f"""WITH {hb()}, {SES}, {views()} SELECT s.id AS live_id,
        coalesce(view_count, 0) AS view_count, coalesce(first_view_count, 0) AS first_view_count,
        coalesce(peak, 0) AS max_living_count FROM el s LEFT JOIN vm ON s.id = vm.live_id""",
    "session_gift_income": f"""WITH {SES}, {INC}, {gifts()} SELECT s.id AS live_id,
        coalesce(gift_income, 0.0::DOUBLE) AS gift_income FROM el s LEFT JOIN gm ON s.id = gm.live_id""",
    "session_dwell_metrics": f"""WITH {hb()}, {SES}, {views()} SELECT s.id AS live_id,
        {', '.join(capped())} FROM el s LEFT JOIN vm ON s.id = vm.live_id""",
    "session_heartbeats": f"""WITH {hb()}, {SES} SELECT s.id AS live_id,
        {sec_text('s.start_time')} AS start_time, {sec_text('s.end_time')} AS end_time, h.extra_id,
        h.device_id, h.uid, h.ext, h.fr, h.is_online, h.p_uid, h.c_time, h.type
        FROM hb h JOIN ses s ON h.extra_id = s.circle_id AND h.logtime BETWEEN s.start_time AND s.end_time
        WHERE s.live_status = 0 AND h.type = {VIDEO}""",
    "route_by_event_date": f"""WITH {hb()}, {SES} SELECT s.id AS live_id, h.device_id, h.uid, h.c_time,
        {CLIENT_DAY} AS dt FROM hb h JOIN ses s
        ON h.extra_id = s.circle_id AND h.logtime BETWEEN s.start_time AND s.end_time
        WHERE s.live_status = 0 AND h.type = {VIDEO}""",
    "session_heartbeats_days": f"""WITH {hb()}, {SES} SELECT s.id AS live_id, h.device_id, h.uid,
        h.c_time, {CLIENT_DAY} AS dt FROM hb h JOIN ses s
        ON h.extra_id = s.circle_id AND h.logtime BETWEEN s.start_time AND s.end_time
        WHERE s.live_status = 0 AND h.type = {VIDEO}""",
    "heartbeat_repair_merge": f"""WITH {API}, rp AS ({REPAIR}) SELECT c_time, device_id, ext, extra_id,
        fr, ip, is_online, c_time AS logtime, p_uid, '' AS record_type, refer, source, type,
        CAST(u_type AS VARCHAR) AS u_type, uid, '' AS "second", is_insert, substring(c_time, 1, 10) AS dt
        FROM rp""",
    "open_sessions": f"""WITH {hb()}, {SES} SELECT id, circle_id, u_type, uid, title,
        {sec_text('start_time')} AS start_time, {sec_text('end_time')} AS end_time, live_status FROM ses
        WHERE live_status IN (0, 1)
          AND end_time > (SELECT date_trunc('day', max(logtime)) FROM hb)""",
    "room_comments": f"""WITH {CONV} SELECT uid, name, relation_id, content,
        CASE WHEN c_time = '' THEN c_time ELSE replace(c_time, ' ', 'T') || '+08:00' END AS c_time, title
        FROM rc WHERE c_time <> '' AND CAST(c_time AS TIMESTAMP) - INTERVAL 8 HOUR
          >= TIMESTAMP '2024-01-02' AND CAST(c_time AS TIMESTAMP) - INTERVAL 8 HOUR < TIMESTAMP '2024-01-06'""",
    "viewer_dwell": f"""WITH {hb()}, {SES}, {views()}
        SELECT live_id, extra_id, uid, device_id, dwell FROM vd""",
    "new_viewers": f"""WITH {hb()}, {SES}, {views()}
        SELECT live_id, extra_id, uid, device_id, dwell FROM vn WHERE is_new""",
    "old_viewers": f"""WITH {hb()}, {SES}, {views()}
        SELECT live_id, extra_id, uid, device_id, dwell FROM vn WHERE NOT is_new""",
    "peak_online_estimate": f"""WITH {hb()}, {SES}, {PREV}, {views()} SELECT s.id AS live_id,
        greatest(coalesce(peak, 0), coalesce(prev.max_living_count, 0)) AS max_living_count
        FROM el s LEFT JOIN vm ON s.id = vm.live_id LEFT JOIN prev ON s.id = prev.live_id""",
    "planner_rollup": f"""{BASE_METRICS}, {rollup()}
        SELECT * FROM pr""",
    "metrics_refresh": f"{REFRESH} SELECT {times(METRIC_COLUMNS)} FROM sm",
    "metrics_refresh_stream": f"""{REFRESH} SELECT {times(METRIC_COLUMNS)} FROM sm UNION ALL
        SELECT {times(METRIC_COLUMNS)} FROM prev WHERE live_id NOT IN (SELECT live_id FROM sm)""",
    "metrics_insert_new": f"""WITH {TABLES}, {PREV}, {metrics()} SELECT {times(METRIC_COLUMNS)} FROM sm
        WHERE live_id NOT IN (SELECT live_id FROM prev)""",
    "metrics_upsert": f"""WITH {TABLES}, {PREV}, {metrics()}
        SELECT {', '.join(upsert_value(c) for c in LIVE_INFO)},
        CASE WHEN o.live_id IS NULL THEN '2024-02-01 00:00:00' ELSE '2024-01-15 00:00:00' END AS c_time,
        CASE WHEN o.live_id IS NULL THEN '2024-02-01 00:00:00' ELSE '2024-01-15 00:00:00' END AS u_time
        FROM prev o FULL JOIN sm n ON o.live_id = n.live_id""",
    "metrics_json_snapshot": f"""{BASE_METRICS} SELECT CAST(live_id AS VARCHAR) AS live_id,
        {json_of(METRIC_COLUMNS)} AS value FROM sm""",
    "snapshot_read": f"""{BASE_METRICS}, {rollup()}
        SELECT 'live' AS hash, CAST(live_id AS VARCHAR) AS key, {json_of(METRIC_COLUMNS)} AS value FROM sm
        UNION ALL SELECT 'host', CAST(lcs_id AS VARCHAR), {json_of(PLANNER, plain_text)} FROM pr""",
    "snapshot_flatten": f"""{BASE_METRICS} SELECT
        {', '.join(f'{sm_text(c)} AS {c}' for c in METRIC_COLUMNS[:29])} FROM sm""",
    "planner_snapshot_flatten": f"""{BASE_METRICS}, {rollup()} SELECT CAST(lcs_id AS VARCHAR) AS lcs_id,
        {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in PLANNER)} FROM pr""",
    "heartbeat_scan": f"""WITH {hb()} SELECT {', '.join(
        f'{micro_text("logtime")} AS logtime' if c == "logtime" else f'"{c}"' for c in HB_COLUMNS)}
        FROM hb WHERE type IN ({VIDEO}, {TEXT}) AND {within('hb', 'logtime')}""",
    "api_log_scan": f"""WITH {API} SELECT log_time, "deviceId", action, data FROM api
        WHERE action NOT IN ('{"', '".join(ACTIONS[8:])}') AND {within('api', 'log_time')}""",
    "api_log_token_scan": f"""WITH {API} SELECT log_time, "deviceId", action,
        CASE action WHEN 'app/newInfoCircle' THEN 'p_uid' WHEN 'api/getViewDetail' THEN 'v_id'
        ELSE 'dynamic_id' END AS token FROM api
        WHERE (action = 'app/newInfoCircle' AND v NOT IN (1, 3))
        OR (action IN ('api/getViewDetail', 'api/fortuneCircleDynamicDetail') AND w <> 0)""",
    "session_scan": f"""WITH {SES} SELECT id, circle_id, u_type, uid, title,
        {sec_text('start_time')} AS start_time, {sec_text('end_time')} AS end_time, live_status FROM el
        WHERE {within('ses', 'end_time')}""",
    "comment_scan": f"""WITH {COM} SELECT u_type, uid, discussion_type, is_robot, reply_id,
        {micro_text('c_time')} AS c_time, relation_id FROM com WHERE {within('com', 'c_time', True)}""",
    "income_scan": f"""WITH {INC} SELECT p_uid, divide_money, status, {micro_text('c_time')} AS c_time
        FROM inc WHERE status = 0 AND {within('inc', 'c_time', True)}""",
    "planner_sessions": f"WITH {SES} SELECT uid AS lcs_id, id AS live_id FROM el",
    "distinct_planners": f"WITH {SES} SELECT DISTINCT uid AS lcs_id FROM ses",
    "date_spine": """WITH d AS (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM events)
        SELECT strftime(unnest(generate_series(a, b, INTERVAL 1 DAY)), '%Y-%m-%d') AS dt FROM d""",
    "minute_coverage": coverage(60),
    "half_minute_coverage": coverage(30),
    "viewer_identity_set": f"""WITH {hb()}, {SES}, {views()},
        lg AS (SELECT live_id, device_id, uid,
          row_number() OVER (PARTITION BY live_id, device_id ORDER BY length(uid) DESC, uid DESC) AS rn FROM vd)
        SELECT DISTINCT live_id, CASE WHEN uid <> '' THEN uid ELSE device_id END AS identity
        FROM lg WHERE rn = 1""",
    "viewer_set_ttl": f"""WITH {hb()}, {SES}, {views()},
        lg AS (SELECT live_id, device_id, uid,
          row_number() OVER (PARTITION BY live_id, device_id ORDER BY length(uid) DESC, uid DESC) AS rn FROM vd),
        ids AS (SELECT DISTINCT live_id, CASE WHEN uid <> '' THEN uid ELSE device_id END AS identity
          FROM lg WHERE rn = 1)
        SELECT live_id, identity, {sec_text('end_time + INTERVAL 2 DAY')} AS expires_at
        FROM ids JOIN el ON ids.live_id = el.id
        WHERE end_time + INTERVAL 2 DAY > TIMESTAMP '2024-01-16 00:00:00'""",
    "slot_event_write": f"""{ALL_SLOTS} SELECT substring(log_time, 1, 10) AS dt, type, count(*) AS n
        FROM se GROUP BY 1, 2""",
    "partition_overwrite": f"""WITH {hb()} SELECT {day_text('logtime')} AS dt,
        count(*) FILTER (WHERE day(logtime) <> 10 OR type = {VIDEO}) AS n FROM hb GROUP BY 1""",
    "full_table_overwrite": f"""WITH {SES} SELECT id, circle_id, u_type, uid, title,
        {sec_text('start_time')} AS start_time, {sec_text('end_time')} AS end_time, live_status,
        type, audit, status FROM el""",
    "report_tsv": PLANNER_PAGES,
    "json_flatten": f"""WITH {hb()} SELECT event_id,
        CAST(CASE WHEN {_BROKEN} THEN 0 WHEN "second" IS NULL THEN 15 ELSE 16 END AS BIGINT) AS members,
        {flat('extra_id')}, {flat('p_uid')}, {flat('second')}, {flat('ext')} FROM hb""",
    "heartbeat_flatten": f"""WITH {hb()} SELECT event_id, {', '.join(flat(c) for c in HB_COLUMNS)} FROM hb""",
    "heartbeat_repair": f"WITH {API} {REPAIR}",
    "live_type_code": f"WITH {hb()} SELECT type, {CODE} AS code, count(*) AS n FROM hb GROUP BY 1, 2",
    "viewer_identity": f"""WITH {hb()} SELECT CASE WHEN uid <> '' THEN uid ELSE device_id END AS identity,
        CASE WHEN is_online = '' THEN '0' ELSE is_online END AS is_online, count(*) AS n
        FROM hb GROUP BY 1, 2""",
    "time_normalise": f"""SELECT event_id, {sec_text('ts')} AS cut,
        replace({sec_text('ts')}, ' ', 'T') || '+00:00' AS iso,
        {sec_text('ts + INTERVAL 8 HOUR')} AS "local" FROM events""",
    "scalar_suite": f"""SELECT event_id, contains(event_type, 'i') AS has_i,
        substring(event_type, 1, 3) AS head, replace(event_type, 'c', 'T') AS swapped,
        length(event_type) AS len, reverse(CAST(user_id AS VARCHAR)) AS salted_key,
        event_type || '-' || CAST(user_id AS VARCHAR) AS joined, printf('%.2f', value) AS two_decimals,
        strftime(ts, '%Y-%m-%d') AS first_date,
        strftime(ts + INTERVAL 1 DAY, '%Y-%m-%d') AS next_day,
        strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d') AS day_before, {SECONDS_OF_DAY} AS of_day,
        greatest(event_id, user_id) AS larger, least(event_id, user_id) AS smaller,
        CAST(ceil(value) AS BIGINT) AS up, event_id // 7 AS seventh,
        CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k, 30 AS default_int,
        CASE WHEN event_id % 2 = 1 OR user_id % 2 = 1 THEN 2 ELSE 1 END::BIGINT AS distinct_bits,
        greatest(event_id, user_id) AS top_of_array, regexp_extract(props, '[0-9]+') AS k_text,
        '{{"t":"' || event_type || '","v":"' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || '"}}' AS made,
        CASE WHEN value < 10 THEN 'low' WHEN value < 100 THEN 'mid' ELSE 'high' END AS band,
        CASE WHEN event_id % 7 = 0 THEN 'none' ELSE event_type END AS or_none FROM events""",
    **{name: f"WITH {API}, {ELEMS} {sql}" for name, sql in SLOTS.items()},
    "slot_event_all": f"{ALL_SLOTS} SELECT {SLOT_COLUMNS} FROM se",
    "slot_event_counts": f"{ALL_SLOTS} SELECT type, count(*) AS n FROM se GROUP BY 1",
    "points_by_viewer": f"""WITH {hb()} SELECT extra_id, type, device_id, uid, count(*) AS points FROM hb
        WHERE type IN ({VIDEO}, {TEXT}) GROUP BY 1, 2, 3, 4""",
    "points_by_viewer_sec": f"""WITH {hb()} SELECT extra_id, type, device_id, uid,
        coalesce("second", '30') AS sec, count(*) AS points FROM hb
        WHERE type IN ({VIDEO}, {TEXT}) GROUP BY 1, 2, 3, 4, 5""",
    "room_points_devices": f"WITH {hb()}, {POINTS} SELECT * FROM pd",
    "avg_dwell_by_room": f"WITH {hb()}, {POINTS}, {AVERAGE} SELECT * FROM av",
    "top_rooms": f"""WITH {hb()} SELECT extra_id, count(*) AS points FROM hb GROUP BY 1
        ORDER BY points DESC, extra_id LIMIT 5""",
    "online_now": f"{ONLINE} SELECT {sec_text('window_end')} AS window_end, extra_id, type, online FROM on_",
    "online_with_average": f"""{WITH_AVERAGE} SELECT {sec_text('window_end')} AS window_end, extra_id,
        {CODE} AS type, online, average FROM on_ JOIN av USING (extra_id, type)""",
    "peak_online_running": f"""{ONLINE} SELECT {sec_text('window_end')} AS window_end, extra_id, type, online,
        max(online) OVER (PARTITION BY extra_id, type ORDER BY window_end) AS peak FROM on_""",
    "dwell_gap_batch": f"""{GAPS} SELECT {day_text('day')} AS day, extra_id, type, viewer,
        inner_s + 15 AS seconds FROM dw""",
    "avg_dwell_stateful": f"""{GAPS} SELECT extra_id, type,
        CAST(sum(inner_s + 15) // count(*) AS BIGINT) AS average FROM dw GROUP BY 1, 2""",
    "watch_sessions": f"""{presence()},
        b AS (SELECT extra_id, type, viewer, epoch_us(logtime) // 1000000 AS s, count(*) AS n
          FROM pres GROUP BY 1, 2, 3, 4),
        g AS (SELECT *, CASE WHEN s - lag(s) OVER w <= 35 THEN 0 ELSE 1 END AS brk FROM b
          WINDOW w AS (PARTITION BY extra_id, type, viewer ORDER BY s)),
        r AS (SELECT *, sum(brk) OVER (PARTITION BY extra_id, type, viewer ORDER BY s) AS run FROM g)
        SELECT extra_id, type, viewer, {sec_text('make_timestamp(min(s) * 1000000)')} AS started,
          {sec_text('make_timestamp((max(s) + 35) * 1000000)')} AS ended, CAST(sum(n) AS BIGINT) AS beats
        FROM r GROUP BY extra_id, type, viewer, run""",
    "heartbeat_feed": f"{presence(1)} {HEARTBEAT_FEED}",
    "comment_feed": COMMENT_FEED,
    "pv_uv_planner": PLANNER_PAGES,
    "pv_uv_view": pv_uv("v_id", _DETAIL_KEY, "action = 'api/getViewDetail' AND w <> 0"),
    "dynamic_detail_counts": f"""WITH {API} SELECT substring(log_time, 1, 10) AS date,
        {_DETAIL_KEY} AS dynamic_id, count(*) AS count FROM api
        WHERE action = 'api/fortuneCircleDynamicDetail' AND w <> 0 GROUP BY 1, 2""",
    # A replayed stream closes the windows and silences that lie before the watermark.
    "online_now_stream": f"""{ONLINE} SELECT {sec_text('window_end')} AS window_end, extra_id, type, online
        FROM on_ WHERE epoch_ms(window_end) <= (SELECT epoch_ms(max(logtime)) - 5000 FROM pres)""",
    "online_with_average_stream": f"""{WITH_AVERAGE} SELECT {sec_text('window_end')} AS window_end, extra_id,
        {CODE} AS type, online, average FROM on_ JOIN av USING (extra_id, type)
        WHERE epoch_ms(window_end) <= (SELECT epoch_ms(max(logtime)) - 5000 FROM pres)""",
    "dwell_state": f"""{GAPS} SELECT {day_text('day')} AS day, extra_id, type, viewer,
        inner_s + CASE WHEN last_s + 35 < (SELECT max(s) - 5 FROM secs) THEN 15 ELSE 0 END AS seconds FROM dw""",
    "dwell_stretches_stream": f"""{GAPS},
        runs AS (SELECT *, sum(CASE WHEN g <= 35 THEN 0 ELSE 1 END)
          OVER (PARTITION BY day, extra_id, type, viewer ORDER BY s) AS run FROM gaps),
        st AS (SELECT day, extra_id, type, viewer, run, min(s) AS a, max(s) + 35 AS b,
          CAST(sum(CASE WHEN g <= 31 THEN g WHEN g <= 35 THEN 15 ELSE 0 END) AS BIGINT) + 15 AS seconds
          FROM runs GROUP BY 1, 2, 3, 4, 5)
        SELECT {day_text('day')} AS day, extra_id, type, viewer,
          {sec_text('make_timestamp(a * 1000000)')} AS started,
          {sec_text('make_timestamp(b * 1000000)')} AS ended, seconds
        FROM st WHERE b <= (SELECT max(s) - 5 FROM secs)""",
    "heartbeat_feed_stream": f"{presence()} {HEARTBEAT_FEED}",
    "comment_feed_stream": COMMENT_FEED,
}
for _name, _all in (("session_comment_metrics", True), ("session_comment_metrics_all", False)):
    _counts = [c for c in PREVIOUS_COUNTS if c not in ("view_count", "first_view_count", "max_living_count")]
    ORACLES[_name] = f"""WITH {SES}, {COM}, {comments(viewer_only=_all)} SELECT s.id AS live_id,
        {', '.join(f'coalesce({c}, 0) AS {c}' for c in _counts)}
        FROM el s LEFT JOIN cm ON s.id = cm.live_id"""
