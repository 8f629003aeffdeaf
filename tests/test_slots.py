from conftest import rows

from roomtide.functions import fixed
from roomtide.operators import slots

LOG = "deviceId string, log_time string, action string, data string"


def run(spark, name, data, action=None):
    slot = slots.SLOTS[name]
    df = spark.createDataFrame([("d", "t", action or slot.action, data)], LOG)
    return rows(slots.slot_event(df, name).select(
        "data", "id", "title", "code", "index_type", "is_lock"))


def page(inner):
    return '{"code":0,"data":' + inner + "}"


def test_titled_array(spark):
    got = run(spark, "slot_banner", page(
        '{"banner":[{"id":"1","title":"a"},{"id":"2","title":""},{"id":"3","title":null},'
        '{"id":"4"},null,"text"],"index_type":"index"}'))
    assert [(r[1], r[2], r[3], r[4]) for r in got] == [
        ("1", "a", "0", "index"), ("3", "null", "0", "index")]
    assert got[0][0] == '{"id":"1","title":"a"}'


def test_unparseable_array(spark):
    bad = '"oops adid entrance"'
    for name, key in (("slot_banner", "banner"), ("slot_entrance", "entrance"),
                      ("slot_startup_ads", "ad")):
        assert run(spark, name, page(f'{{"{key}":{bad},"x":"adid"}}')) == []
    stock = '{"daily_gold_stock":{"title":"T","data":"oops"},"index_type":"i"}'
    assert run(spark, "slot_daily_stock", page(stock)) == [("{}", "", "T", "0", "i", "")]
    for name, key in (("slot_live_tab_banner", "banner"), ("slot_planner_banner", "banner"),
                      ("slot_recommend_live", "index_recommend_live"),
                      ("slot_live_tab_live", "live")):
        assert run(spark, name, page(f'{{"{key}":{bad}}}')) == [("{}", "", "", "0", "", "")]


def test_null_array(spark):
    assert run(spark, "slot_live_tab_banner", page('{"banner":null}')) == []
    assert run(spark, "slot_banner", page('{"banner":null}')) == []
    stock = '{"daily_gold_stock":{"title":"T","data":null}}'
    assert run(spark, "slot_daily_stock", page(stock)) == [("{}", "", "T", "0", "", "")]


def test_broad_gate(spark):
    data = page('{"index_banner":{"title":"top"}}')
    assert run(spark, "slot_banner", data) == []
    assert run(spark, "slot_top_banner", data) == [('{"title":"top"}', "", "top", "0", "", "")]


def test_floating_ball_drops_index_type(spark):
    data = page('{"suspension":{"title":"b"},"index_type":"index"}')
    assert run(spark, "slot_floating_ball", data) == [('{"title":"b"}', "", "b", "0", "", "")]
    assert run(spark, "slot_floating_ball", '{"x":"a suspension"') == []
    assert run(spark, "slot_floating_ball", '{"suspension":') == [("", "", "", "", "", "")]


def test_lock_fields(spark):
    special = page('{"index_special_stocks":{"is_unlock":"1","is_lock":"0"},"index_type":"i"}')
    assert run(spark, "slot_special_stocks", special)[0][2:] == (None, "0", "i", "1")
    channel = page('{"channel_daily_gold_stock":{"title":"T","is_lock":"9","data":[{"id":"5"}]}}')
    assert run(spark, "slot_channel_stock", channel) == [('{"id":"5"}', "5", "T", "0", "", "9")]


def test_recommend_live_keeps_tag(spark):
    data = page('{"index_recommend_live":[{"id":"1","title":"t","tag_text":"hot"}],"index_type":"i"}')
    assert run(spark, "slot_recommend_live", data)[0][1:] == ("1", "t", "0", "hot", "")


def test_whole_data_slots(spark):
    assert run(spark, "slot_hot_list", page('{"list":[]}')) == [
        ('{"list":[]}', "", None, "0", "", "")]
    assert run(spark, "slot_hot_list", None) == [("", "", None, "", "", "")]
    assert run(spark, "slot_market", page('{"other":1}')) == []


def test_client_guide_keeps_payload(spark):
    data = page('{"g_id":"7","title":"g","index_type":"i"}')
    assert run(spark, "slot_client_guide", data) == [(data, "7", "g", "0", "i", "")]


def test_live_ball_hosts(spark):
    def ball(uid):
        return page('{"planner":{"planner_info":{"p_uid":"' + uid + '"}},'
                    '"circle":{"red_packet":{"title":"r"}}}')
    host = fixed.LIVE_BALL_PLANNERS[0]
    assert run(spark, "slot_live_ball", ball(host)) == [('{"title":"r"}', host, "r", "0", "", "")]
    assert run(spark, "slot_live_ball", ball("5")) == []
    df = spark.createDataFrame([("d", "t", "app/newInfoCircle", ball("5"))], LOG)
    assert slots.slot_events(df, live_ball_planners=("5",)).count() == 1


def test_single_slots_add_up(spark, sf_dir):
    from roomtide.sources import fixtures
    log = fixtures.api_log(spark, sf_dir)
    counts = dict(rows(slots.slot_counts(slots.slot_events(log))))
    assert len(counts) == 19
    for name in ("slot_banner", "slot_hot_list", "slot_live_ball"):
        assert slots.slot_event(log, name).count() == counts[slots.SLOTS[name].label]
