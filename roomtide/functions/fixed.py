"""Fixed values of the data contract.

These must equal what the logging side writes, so they are stated once, as
text, and passed around as parameters everywhere else.
"""

# Labels of a live room in the heartbeat `type` field, and their numeric codes.
ROOM_VIDEO = "圈子视频直播"
ROOM_TEXT = "圈子文字直播"
BIG_LIVE = "大直播"
LIVE_TYPE_CODES = {ROOM_VIDEO: 0, ROOM_TEXT: 1, BIG_LIVE: 2}
OTHER_LIVE_TYPE_CODE = 3

# session.live_status
ENDED, RUNNING = 0, 1

# comment.u_type
VIEWER, PLANNER = 1, 2

# comment.discussion_type
COMMENT, GIFT, FOLLOW = 0, 8, 14
SHARES = (2, 12, 13)

# A schedule row is an eligible session when it has these values.
ELIGIBLE_SESSION = {"u_type": 2, "type": 4, "audit": 1, "status": 0}

# A heartbeat without a usable `second` stands for this many seconds.
DEFAULT_BEAT_SECONDS = 30

# Batch estimate of peak concurrency as a share of the viewer rows.
PEAK_SHARE = 0.13

# Constant host name in the session record.
HOST_NAME = "#"

# Dwell state machine, seconds: longest gap counted in full, what a longer gap
# or a silence is worth, and how long a silence has to last.
FULL_GAP, BROKEN_GAP, SILENCE = 31, 15, 35

# Online-now window, seconds.
ONLINE_WINDOW, ONLINE_SLIDE = 60, 10

# How long the identity set of a session is kept.
VIEWER_SET_DAYS = 2

# Hosts whose live-room ball is extracted.
LIVE_BALL_PLANNERS = ("1625572687", "71585119812862")

# API actions read outside slot extraction.
HEARTBEAT_ACTION = "app/realTimeCount"
PLANNER_PAGE_ACTION = "app/newInfoCircle"
DYNAMIC_DETAIL_ACTION = "api/fortuneCircleDynamicDetail"
VIEW_DETAIL_ACTION = "api/getViewDetail"

# All API actions that are read.
API_ACTIONS = (
    "app/index", "app/clientGuide", "app/startUpAds", "app/newInfoCircle",
    "app/tuyereHotList", "app/homePage", "api/indexPlateInfo",
    "app/compositeVideo", "app/realTimeCount", "api/fortuneCircleDynamicDetail",
    "api/getViewDetail",
)

HEARTBEAT_COLUMNS = (
    "c_time", "device_id", "ext", "extra_id", "fr", "ip", "is_online", "logtime",
    "p_uid", "record_type", "refer", "source", "type", "u_type", "uid", "second",
)

SESSION_RECORD = (
    "live_id", "circle_id", "lcs_id", "lcs_name", "start_time", "end_time",
    "live_title", "live_status", "view_count", "view_count_robot",
    "first_view_count", "max_living_count", "new_follow_count",
    "new_follow_count_robot", "comment_count", "comment_count_robot",
    "comment_peoples", "comment_peoples_robot", "gift_count", "gift_count_robot",
    "share_count", "share_count_robot", "old_user_staying_average",
    "old_user_staying_max", "old_user_staying_min", "new_user_staying_average",
    "new_user_staying_max", "new_user_staying_min",
)
SESSION_SNAPSHOT = SESSION_RECORD + ("gift_income",)
SESSION_METRICS = SESSION_SNAPSHOT + ("planner_comment_count", "planner_reply_count")

PLANNER_METRICS = (
    "notice_num", "live_times", "view_count", "view_count_robot",
    "max_living_count", "comment_count", "comment_count_robot",
    "comment_peoples", "comment_peoples_robot", "gift_income",
)

# Columns of the keyed metric table, in its own names.
LIVE_INFO = (
    "circle_id", "notice_id", "p_uid", "live_title", "view_count",
    "first_view_count", "max_living_count", "new_follow_count", "comment_count",
    "comment_peoples", "gift_count", "share_count", "old_user_staying_average",
    "old_user_staying_max", "old_user_staying_min", "new_user_staying_average",
    "new_user_staying_max", "new_user_staying_min", "planner_comment_count",
    "planner_reply_count", "view_count_robot", "new_follow_count_robot",
    "comment_count_robot", "comment_peoples_robot", "gift_count_robot",
    "share_count_robot",
)
LIVE_INFO_INSERT_ONLY = ("c_time", "u_time")

SLOT_EVENT = (
    "deviceId", "log_time", "action", "data", "type", "id", "title", "code",
    "index_type", "is_lock",
)
