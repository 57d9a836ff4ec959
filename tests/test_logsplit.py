import json

from coursemill.operators import logsplit
from coursemill.plans import jobs
from tests.conftest import rows

COMMON = {"mid": "m", "is_new": "1", "sc": "1", "sid": "s", "os": "x"}


def split(spark, *texts):
    texts = [t if t is None or isinstance(t, str) else json.dumps(t) for t in texts]
    log = spark.createDataFrame(list(enumerate(texts)), "arrival bigint, value string")
    out = jobs.split_log(log)
    return [(t, i, json.loads(v) if v and t != logsplit.DIRTY else v)
            for t, i, v in rows(out, "topic", "arrival", "value")]


def test_dirty_rows(spark):
    texts = ['{bad', '', '[1]', '7', 'null', '"s"', '{"a":1} tail', '{"a":1},{"b":2}', '{"ts":1}',
             '{"common":{"is_new":"1"},"ts":1}', '{"common":"text","ts":1}', None]
    out = split(spark, *texts)
    assert len(out) == len(texts)
    assert all(t == logsplit.DIRTY and v == texts[i] for t, i, v in out)


def test_error_goes_on_without_the_error(spark):
    record = {"common": COMMON, "page": {"page_id": "p"}, "err": {"code": 1.5}, "ts": 5}
    rest = {k: v for k, v in record.items() if k != "err"}
    assert split(spark, record) == [(logsplit.ERR, 0, record), (logsplit.PAGE, 0, rest)]


def test_video_stops_start(spark):
    record = {"common": COMMON, "appVideo": {"sec": 3}, "start": {"a": 1}, "ts": 5}
    assert split(spark, record) == [(logsplit.APP_VIDEO, 0, record)]


def test_error_and_start(spark):
    record = {"common": COMMON, "err": {}, "start": {"a": 1}, "ts": 5}
    rest = {k: v for k, v in record.items() if k != "err"}
    assert split(spark, record) == [(logsplit.ERR, 0, record), (logsplit.START, 0, rest)]


def test_displays_actions_and_unknown_fields(spark):
    page = {"page_id": "p", "note": "a \"quoted\" \\ {text}"}
    record = {"common": COMMON, "page": page, "displays": [{"a": 1}, {"a": 2}],
              "actions": [{"b": x} for x in "xyz"], "ts": 5, "extra \"field\"": [1, "2", None],
              "gone": None}
    out = split(spark, record)
    shared = {"common": COMMON, "page": page}
    assert [v for t, _, v in out if t == logsplit.DISPLAY] == [
        {**shared, "display": {"a": x}, "ts": 5} for x in (1, 2)]
    assert [v for t, _, v in out if t == logsplit.ACTION] == [
        {**shared, "action": {"b": x}} for x in "xyz"]
    assert [v for t, _, v in out if t == logsplit.PAGE] == [
        {**shared, "ts": 5, "extra \"field\"": [1, "2", None]}]


def test_empty_array_stays(spark):
    record = {"common": COMMON, "page": {}, "displays": [], "ts": 5}
    assert split(spark, record) == [(logsplit.PAGE, 0, record)]


def test_flag_is_repaired_in_place(spark):
    day = 24 * 3600 * 1000
    out = split(spark, {"common": COMMON, "page": {}, "ts": 0},
                {"common": COMMON, "page": {}, "ts": day})
    assert [v["common"] for _, _, v in out] == [COMMON, {**COMMON, "is_new": "0"}]
