"""Behaviour log: parse, set bad text aside, split one record into its output topics.

Records have an open shape, so they are read as a map of VARIANT values: every field passes
through, known or not. The split gives one table (topic, value). It is written in one pass,
either to Kafka, whose sink reads the topic from the row, or partitioned by topic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemill.functions.jsontext import as_array
from coursemill.functions.scalars import millis_to_time

# Output topics.
DIRTY = "dirty_topic"
ERR = "dwd_traffic_err_log"
APP_VIDEO = "dwd_traffic_app_video_log"
START = "dwd_traffic_start_log"
DISPLAY = "dwd_traffic_display_log"
ACTION = "dwd_traffic_action_log"
PAGE = "dwd_traffic_page_log"

_RECORD = "map<string,variant>"


def parse_log(log: DataFrame) -> DataFrame:
    """Add device, flag, time and day, which are all that the flag repair needs.

    ``mid`` is NULL for dirty rows: text that is no single JSON object as a whole (an object
    that names a field twice is none), or that names no device or time. A time may be a
    number or one in quotes. Exploding makes the parsed record a column of its own, so that
    filters on it do not parse the text again.
    """
    parsed = log.withColumn("records", as_array(F.col("value"), _RECORD)).withColumn(
        "record", F.explode_outer(F.when(F.size("records") == 1, F.col("records"))))
    common = F.col("record")["common"]
    mid = F.try_variant_get(common, "$.mid", "string")
    ts = F.try_variant_get(F.col("record")["ts"], "$", "string").try_cast("bigint")
    return parsed.select(
        "value", *_arrival(log),
        F.when(mid.isNotNull() & ts.isNotNull(), mid).alias("mid"),
        F.try_variant_get(common, "$.is_new", "string").alias("is_new"),
        F.to_date(millis_to_time(ts)).alias("visit_date"))


def dirty(parsed: DataFrame) -> DataFrame:
    """Rows to set aside, as they came."""
    return parsed.where("mid IS NULL").select(F.lit(DIRTY).alias("topic"), "value",
                                                 *_arrival(parsed))


def usable(parsed: DataFrame) -> DataFrame:
    """Rows to split, with the flag as sent beside the one to repair."""
    return parsed.where("mid IS NOT NULL").withColumn("sent_is_new", F.col("is_new"))


def _arrival(df: DataFrame) -> list[str]:
    return [c for c in ("arrival",) if c in df.columns]


def _members(record: Column) -> Column:
    """The fields of a record without null ones, each as its name and its JSON text with name."""
    kept = F.filter(F.map_entries(record),
                    lambda e: e["value"].isNotNull() & ~F.is_variant_null(e["value"]))
    objects = F.transform(kept, lambda e: F.struct(
        e["key"].alias("name"), F.to_json(F.create_map(e["key"], e["value"])).alias("text")))
    return F.transform(objects, lambda m: F.struct(
        m["name"].alias("name"),
        F.substr(m["text"], F.lit(2), F.length(m["text"]) - 2).alias("text")))


def _with_flag(record: Column, is_new: Column) -> Column:
    """The member text of ``common`` with another new-visitor flag."""
    flag = F.try_parse_json(F.concat(F.lit('"'), is_new, F.lit('"')))
    common = F.transform_values(
        F.try_variant_get(record["common"], "$", _RECORD),
        lambda name, value: F.when(name == "is_new", flag).otherwise(value))
    return F.concat(F.lit('"common":'), F.to_json(common))


def _object(*members: Column) -> Column:
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def _row(topic: str, text: Column) -> Column:
    return F.struct(F.lit(topic).alias("topic"), text.alias("value"))


def split(repaired: DataFrame) -> DataFrame:
    """Usable rows, with ``is_new`` repaired, to (topic, value) rows.

    A record with an error goes to the error topic whole, and on without the error. A video or
    start record goes to its topic and nowhere else. A page record gives one row per display
    and per action, and one page row without the arrays that gave rows. Action rows carry
    no time.
    """
    carried = _arrival(repaired)
    # Parsed once, as a column of its own; each field becomes text once, and the rows are
    # put together from these texts.
    parsed = repaired.select(
        F.explode(as_array(F.col("value"), _RECORD)).alias("record"),
        "is_new", "sent_is_new", *carried)
    record = F.col("record")

    def elements(name: str) -> Column:
        return F.transform(F.try_variant_get(record[name], "$", "array<variant>"),
                           lambda e: F.to_json(e))

    def member(name: str) -> Column:
        return F.element_at(F.filter("members", lambda m: m["name"] == name)["text"], 1)

    changed = ~F.col("is_new").eqNullSafe(F.col("sent_is_new"))
    with_texts = parsed.select(
        F.explode(F.array(F.struct(
            _members(record).alias("members"),
            F.when(changed, _with_flag(record, F.col("is_new"))).alias("common"),
            elements("displays").alias("displays"),
            elements("actions").alias("actions")))).alias("r"), *carried).select("r.*", *carried)
    common = F.coalesce("common", member("common"))
    rows = with_texts.withColumn("members", F.when(F.col("common").isNull(), F.col("members"))
                                 .otherwise(F.transform("members", lambda m: F.struct(
                                     m["name"].alias("name"),
                                     F.when(m["name"] == "common", F.col("common"))
                                     .otherwise(m["text"]).alias("text")))))

    def has(name: str) -> Column:
        return F.exists("members", lambda m: m["name"] == name)

    def without(*names: Column) -> Column:
        gone = F.array_compact(F.array(*names))
        return _object(F.filter("members", lambda m: ~F.array_contains(gone, m["name"]))["text"])

    def per_element(topic: str, column: str, name: str, *more: Column) -> Column:
        return F.transform(F.coalesce(column, F.array().cast("array<string>")), lambda e: _row(
            topic, _object(common, member("page"), F.concat(F.lit(f'"{name}":'), e), *more)))

    err = F.lit("err")
    none = F.array().cast("array<struct<topic:string,value:string>>")
    outputs = F.concat(
        F.when(has("err"), F.array(_row(ERR, _object(F.col("members")["text"])))).otherwise(none),
        F.when(has("appVideo"), F.array(_row(APP_VIDEO, without(err))))
        .when(has("start"), F.array(_row(START, without(err))))
        .otherwise(F.concat(
            per_element(DISPLAY, "displays", "display", member("ts")),
            per_element(ACTION, "actions", "action"),
            F.array(_row(PAGE, without(
                err, F.when(F.size("displays") > 0, F.lit("displays")),
                F.when(F.size("actions") > 0, F.lit("actions"))))))))
    return rows.select(F.explode(outputs).alias("out"), *carried).select("out.*", *carried)


def page_views(page_topic: DataFrame) -> DataFrame:
    """Page-topic text to the columns that the traffic jobs read."""
    shape = ("common struct<mid:string,is_new:string,sc:string,sid:string>, "
             "page struct<page_id:string,last_page_id:string,item:string,item_type:string,"
             "during_time:bigint>, ts bigint")
    parsed = page_topic.withColumn("r", F.from_json("value", shape))
    return parsed.select("r.common.*", "r.page.*", "r.ts", *_arrival(page_topic)).withColumn(
        "row_time", millis_to_time(F.col("ts"))).withColumn(
        "visit_date", F.to_date("row_time"))
