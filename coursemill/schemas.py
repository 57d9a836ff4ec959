"""Declared schemas. Nothing is inferred from data."""

from pyspark.sql import types as T

_S = T.StringType()


def _strings(names: str) -> T.StructType:
    return T.StructType([T.StructField(name, _S) for name in names.split()])


# Record shapes and table columns.

CHANGE_LOG = T.StructType([
    T.StructField("database", _S),
    T.StructField("table", _S),
    T.StructField("type", _S),
    T.StructField("ts", _S),  # seconds
    T.StructField("data", T.MapType(_S, _S)),
    T.StructField("old", T.MapType(_S, _S)),
])

PAGE_LOG = T.StructType([
    T.StructField("common", T.MapType(_S, _S)),
    T.StructField("page", T.MapType(_S, _S)),
    T.StructField("ts", _S),  # milliseconds, as a number or in quotes
])

DIM_CONFIG = _strings("source_table sink_table sink_family sink_columns sink_row_key")
DIM_CONFIG_CHANGE = T.StructType([
    T.StructField("op", _S),
    T.StructField("before", DIM_CONFIG),
    T.StructField("after", DIM_CONFIG),
])

EXAM_PAPER = _strings("id paper_id user_id score course_id duration_sec create_time")
EXAM_QUESTION = _strings("id exam_id paper_id question_id user_id is_correct")
REVIEW = _strings("id user_id course_id course_name review_stars ts")
CART_ADD = _strings("id user_id course_id course_name cart_price session_id ts")
ORDER_DETAIL = _strings(
    "id order_id user_id course_id course_name origin_amount coupon_reduce final_amount "
    "date_id create_time session_id province_id source ts")
PAYMENT_SUCCESS = _strings(
    "id order_id total_amount ts detail_id user_id course_id course_name origin_amount "
    "coupon_reduce final_amount session_id province_id")
USER_REGISTER = _strings("id login_name user_level create_time ts")

MONEY = T.DecimalType(16, 2)
