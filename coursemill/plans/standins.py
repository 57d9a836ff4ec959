"""The warehouse's inputs, derived from the benchmark tables.

No education data comes with the tables, so each input is a projection of a whole table.
Record types come from status columns, which gives inserts, updates, loads and deletions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemill.functions.scalars import second_text
from coursemill.operators.facts import order_parts
from coursemill.operators.state import chunk_of
from coursemill.sources.topics import read_folder

MONEY = "decimal(16,2)"


# Fixed value: the tables that hold facts; the others are dimensions.
FACTS = ("orders", "lineitem", "events", "documents")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A benchmark table. A fact table that comes as one row group would be parsed by one task,
    so the stand-ins deal its rows out; inputs of more splits than cores stay as they are."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    few = name in FACTS and df.rdd.getNumPartitions() < cores
    return df.repartition(cores) if few else df


def _text(column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _money(column: str) -> Column:
    return F.col(column).cast(MONEY).cast("string")


def _time(column: str) -> Column:
    return F.col(column).cast("timestamp")


def _seconds(column: str) -> Column:
    return F.unix_seconds(_time(column)).cast("string")


# The numbers of an arrival order, first to last.
ARRIVAL = ("a", "b", "c", "d", "e", "f")


def _arrival(*columns: str | Column) -> Column:
    """A total arrival order of up to six numbers."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("bigint") for c in columns]
    parts += [F.lit(0).cast("bigint")] * (len(ARRIVAL) - len(parts))
    return F.struct(*[p.alias(n) for p, n in zip(parts, ARRIVAL)])


def _line_arrival() -> Column:
    """Order and line numbers repeat, and so may part and supplier: time and price decide last."""
    return _arrival("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.unix_seconds(_time("l_shipdate")),
                    F.col("l_extendedprice").cast(MONEY) * 100)


def arrival_chunk(arrival: str = "arrival") -> Column:
    return chunk_of(F.col(f"{arrival}.a"))


def events_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The whole events table as a stream."""
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    return read_folder(spark, folder, schema, pathGlobFilter="events.parquet")


# Rows of a file of a stand-in stream, about, at most.
FILE_ROWS = 250_000

# Files of a stream that is to be one micro-batch: more than there are.
ONE_BATCH = 1_000_000


def in_files(df: DataFrame, by: str, path: str, files: int = 4,
             cuts: Sequence[int] | None = None) -> DataFrame:
    """The rows as a stream of ``files`` micro-batches, in the order ``by``.

    Quantiles are approximate: where it counts which rows are in which micro-batch, ``cuts`` names
    the last value of each but the last one.

    A share of many rows is several files, which one micro-batch reads together; all shares have
    as many files, so the limit of files per trigger keeps them apart.
    """
    if cuts is None:
        shares = [k / files for k in range(1, files)]
        cuts = df.approxQuantile(by, shares, 0.001) if shares else []
    bounds = [None, *sorted(set(cuts)), None]
    each = max(1, -(-df.count() // (FILE_ROWS * (len(bounds) - 1))))
    for low, high in zip(bounds, bounds[1:]):
        part = df if low is None else df.where(F.col(by) > low)
        part = part if high is None else part.where(F.col(by) <= high)
        part.repartition(each).write.mode("append").parquet(path)
    return read_folder(df.sparkSession, path, df.schema, files_per_trigger=each)


def in_turn(df: DataFrame, by: str, path: str, values: Sequence[int]) -> Iterator[DataFrame]:
    """The rows as a stream, of which the files of the next value of ``by`` are there each time that it
    is given. Run over what is there now each time, it has a micro-batch per value, of as many
    files as the tasks make that read the input; so nothing is shuffled."""
    # Exploding makes ``by`` a column of its own, so the filter does not work it out once more.
    dealt = df.withColumn(by, F.explode(F.array(by)))
    for value in values:
        dealt.where(F.col(by) == value).write.mode("append").option(
            "maxRecordsPerFile", FILE_ROWS).parquet(path)
        yield read_folder(df.sparkSession, path, df.schema, files_per_trigger=ONE_BATCH)


def _with_k(events: DataFrame) -> DataFrame:
    return events.withColumn("k", F.from_json("props", "k bigint")["k"])


def _events_with_k(spark: SparkSession, folder: str) -> DataFrame:
    return _with_k(table(spark, folder, "events"))


def page_views(spark: SparkSession, folder: str, events: DataFrame | None = None) -> DataFrame:
    """Page log rows from ``events``: device = user, source and flags from props.k."""
    events = _with_k(table(spark, folder, "events") if events is None else events)
    return events.select(
        F.col("event_id").alias("arrival"),
        _text("user_id").alias("mid"),
        _text("user_id").alias("sid"),
        _text(F.col("k") % 5).alias("sc"),
        F.when(F.col("k") % 2 == 0, "1").otherwise("0").alias("is_new"),
        F.when(F.col("event_type") == "view", "order").otherwise(F.col("event_type"))
        .alias("page_id"),
        F.when(F.col("event_type") != "signup", F.col("event_type")).alias("last_page_id"),
        _text("k").alias("item"),
        F.when(F.col("event_type") == "click", "keyword").otherwise("course").alias("item_type"),
        F.col("value").cast("bigint").alias("during_time"),
        F.unix_millis(_time("ts")).alias("ts"),
        _time("ts").alias("row_time"),
        F.to_date(_time("ts")).alias("visit_date"),
    )


def page_log(spark: SparkSession, folder: str, events: DataFrame | None = None) -> DataFrame:
    """The same rows as ``common`` and ``page`` maps."""
    views = page_views(spark, folder, events)

    def as_map(*names: str) -> Column:
        return F.create_map(*[x for n in names for x in (F.lit(n), _text(n))])

    return views.select(
        as_map("mid", "is_new", "sc", "sid").alias("common"),
        as_map("page_id", "last_page_id", "item", "item_type", "during_time").alias("page"),
        "ts", "row_time", "arrival")


def order_facts_in_files(spark: SparkSession, folder: str, path: str) -> Iterator[DataFrame]:
    """Order lines, headers and order-page views as one stream of four micro-batches, which come in
    turn. What belongs together is dealt to them by hashes of its own ids, so it comes in any order."""
    changes = change_log(spark, folder, "order_detail", "order_info")
    lines, headers, views = order_parts(changes, order_views(spark, folder))

    def tagged(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.pmod(F.xxhash64(*df.columns), F.lit(4)).cast("int").alias("share"),
                         F.struct("*").alias(name))

    rows = tagged(lines, "line").unionByName(
        tagged(headers, "header"), allowMissingColumns=True).unionByName(
        tagged(views, "view"), allowMissingColumns=True)
    return in_turn(rows, "share", path, range(4))


# Records of the behaviour log that one task parses or splits, about: each takes much more time than
# the bytes that it is read from say.
LOG_ROWS = 100_000


def log_tasks(spark: SparkSession, folder: str) -> int:
    """Tasks for the records of the behaviour log; the count is in the files' footers."""
    return spark.read.parquet(f"{folder}/events.parquet").count() // LOG_ROWS + 1


def behaviour_log(spark: SparkSession, folder: str) -> DataFrame:
    """Raw log text from ``events``, and the texts of ``documents`` as what is no record.

    Errors carry ``err``, purchases ``appVideo``, views ``start``; every row has displays and
    actions by its k.
    """
    events = table(spark, folder, "events")
    tasks = log_tasks(spark, folder)
    if tasks > events.rdd.getNumPartitions():
        events = spark.read.parquet(f"{folder}/events.parquet").repartition(tasks, "event_id")
    v = page_views(spark, folder, events)
    kind = F.col("last_page_id")
    k = F.col("item").cast("int")

    def elements(count: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.when(
            i <= count, F.struct(i.alias("pos"), F.col("item").alias("item"))))

    def present(array: Column) -> Column:
        return F.filter(array, lambda e: e.isNotNull())

    records = v.select(
        F.to_json(F.struct(
            F.struct("mid", "is_new", "sc", "sid").alias("common"),
            F.struct("page_id", "last_page_id", "item", "item_type", "during_time").alias("page"),
            present(elements(k % 3)).alias("displays"),
            present(elements(k % 4)).alias("actions"),
            F.when(kind == "error", F.struct(k.alias("code"))).alias("err"),
            F.when(kind == "purchase", F.struct(k.alias("sec"))).alias("appVideo"),
            F.when(F.col("page_id") == "order", F.struct(k.alias("entry"))).alias("start"),
            "ts")).alias("value"),
        "arrival")
    texts = table(spark, folder, "documents").select(
        F.col("text").alias("value"), F.col("doc_id").alias("arrival"))
    return records.unionByName(texts)


def order_views(spark: SparkSession, folder: str) -> DataFrame:
    """Page log for the order job: one view per customer, then the views in ``events``."""
    customers = table(spark, folder, "customer").select(
        F.create_map(F.lit("sid"), _text("c_custkey"),
                     F.lit("sc"), _text(F.col("c_nationkey") % 5)).alias("common"),
        F.create_map(F.lit("page_id"), F.when(F.col("c_mktsegment") == "HOUSEHOLD", "home")
                     .otherwise("order")).alias("page"),
        F.lit(-1).cast("bigint").alias("arrival"))
    log = page_log(spark, folder)
    return customers.unionByName(log.select(
        F.map_filter("common", lambda n, _: n.isin("sid", "sc")).alias("common"),
        F.map_filter("page", lambda n, _: n == "page_id").alias("page"), "arrival"))


def _changes(df: DataFrame, name: str, kind: Column, ts: Column, arrival: Column,
             **data: Column) -> DataFrame:
    pairs = [x for key, value in data.items() for x in (F.lit(key), value)]
    return df.select(
        F.lit("edu").alias("database"), F.lit(name).alias("table"), kind.alias("type"),
        ts.alias("ts"), F.create_map(*pairs).alias("data"),
        F.lit(None).cast("map<string,string>").alias("old"), arrival.alias("arrival"))


def _line_changes(spark: SparkSession, folder: str, name: str) -> DataFrame:
    line_id = F.concat_ws("-", "l_orderkey", "l_linenumber")
    data = {
        "order_detail": lambda: dict(
            id=line_id, course_id=_text("l_partkey"),
            course_name=F.concat(F.lit("course "), _text("l_partkey")),
            order_id=_text("l_orderkey"), user_id=_text("l_suppkey"),
            origin_amount=_money("l_extendedprice"), coupon_reduce=F.lit("0.00"),
            final_amount=_money("l_extendedprice"),
            create_time=second_text(_time("l_shipdate"))),
        "test_exam_question": lambda: dict(
            id=line_id, exam_id=_text("l_orderkey"), paper_id=_text("l_suppkey"),
            question_id=_text("l_partkey"), user_id=_text("l_suppkey"),
            is_correct=F.when(F.col("l_linestatus") == "O", "1").otherwise("0")),
        "review_info": lambda: dict(
            id=line_id, user_id=_text("l_suppkey"), course_id=_text("l_partkey"),
            review_stars=_text("l_linenumber")),
    }[name]()
    return _changes(
        table(spark, folder, "lineitem"), name,
        F.when(F.col("l_returnflag") == "A", "update").otherwise("insert"),
        _seconds("l_shipdate"),
        _line_arrival(), **data)


def _order_changes(spark: SparkSession, folder: str, name: str) -> DataFrame:
    kind = F.when(F.col("o_orderstatus") == "P", "update").otherwise("insert")
    data = {
        "order_info": lambda: dict(
            id=_text("o_orderkey"), user_id=_text("o_custkey"),
            origin_amount=_money("o_totalprice"), coupon_reduce=F.lit("0.00"),
            final_amount=_money("o_totalprice"), order_status=F.col("o_orderstatus"),
            session_id=_text("o_custkey"), province_id=_text(F.col("o_custkey") % 25)),
        "payment_info": lambda: dict(
            id=_text("o_orderkey"), order_id=_text("o_orderkey"),
            total_amount=_money("o_totalprice"),
            payment_status=F.when(F.col("o_orderstatus") == "F", "1602").otherwise("1601")),
        "test_exam": lambda: dict(
            id=_text("o_orderkey"), paper_id=_text("o_custkey"), user_id=_text("o_custkey"),
            score=_money("o_totalprice"), duration_sec=F.substring("o_orderpriority", 1, 1),
            create_time=second_text(_time("o_orderdate"))),
    }[name]()
    return _changes(
        table(spark, folder, "orders"), name, F.lit("insert") if name == "payment_info" else kind,
        _seconds("o_orderdate"), _arrival("o_orderkey"), **data)


def _cart_changes(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return _changes(
        _events_with_k(spark, folder), name,
        F.when(F.col("event_type") == "signup", "bootstrap-insert")
        .when(F.col("event_type") != "error", "insert"),
        _seconds("ts"), _arrival("event_id"),
        id=_text("event_id"), user_id=_text("user_id"), course_id=_text("k"),
        course_name=F.concat(F.lit("course "), _text("k")), cart_price=_money("value"),
        session_id=_text("user_id"))


def _user_changes(spark: SparkSession, folder: str, name: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    return _changes(
        table(spark, folder, "customer"), name,
        F.when(segment == "AUTOMOBILE", "bootstrap-start")
        .when(segment == "MACHINERY", "bootstrap-complete")
        .when(segment == "FURNITURE", "bootstrap-insert")
        .when(segment == "HOUSEHOLD", "update").otherwise("insert"),
        _text("c_custkey"), _arrival("c_custkey"),
        id=_text("c_custkey"), login_name=F.col("c_name"), user_level=segment,
        create_time=F.lit(None).cast("string"))


CHANGE_TABLES = {
    "order_detail": _line_changes, "test_exam_question": _line_changes,
    "review_info": _line_changes, "order_info": _order_changes, "payment_info": _order_changes,
    "test_exam": _order_changes, "cart_info": _cart_changes, "user_info": _user_changes,
}


def change_log(spark: SparkSession, folder: str, *tables: str) -> DataFrame:
    """The business change log: the records of the named source tables, or of all eight.

    Naming the tables saves planning time only: Spark drops the branches that a job's table
    filter cannot match.
    """
    return reduce(DataFrame.unionByName, [
        CHANGE_TABLES[name](spark, folder, name) for name in tables or CHANGE_TABLES])


def change_log_text(spark: SparkSession, folder: str) -> DataFrame:
    """The change log as JSON text, one record per row."""
    return change_log(spark, folder).select(
        F.to_json(F.struct("database", "table", "type", "ts", "data", "old")).alias("value"),
        "arrival")


def base_source(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "region").select(
        _text("r_regionkey").alias("id"), F.col("r_name").alias("source_site"))


def base_province(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        _text("n_nationkey").alias("id"), F.col("n_name").alias("name"))


def course_info(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        _text("p_partkey").alias("id"), F.col("p_name").alias("course_name"),
        F.col("p_brand").alias("subject_id"))


def subject_info(spark: SparkSession, folder: str) -> DataFrame:
    return (table(spark, folder, "part").groupBy(F.col("p_brand").alias("id"))
            .agg(F.min("p_type").alias("category_id"))
            .withColumn("subject_name", F.lower("id")))


def category_info(spark: SparkSession, folder: str) -> DataFrame:
    return (table(spark, folder, "part").select(F.col("p_type").alias("id")).distinct()
            .withColumn("category_name", F.lower("id")))


def test_paper(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        _text("c_custkey").alias("id"), _text("c_nationkey").alias("course_id"))


def config_records(spark: SparkSession, folder: str) -> DataFrame:
    """Configuration change records from ``orders``: one source table per customer."""
    orders = table(spark, folder, "orders")
    op = (F.when(F.col("o_orderstatus") == "P", "d").when(F.col("o_orderstatus") == "F", "u")
          .otherwise("c"))
    row = F.struct(
        F.concat(F.lit("src_"), _text("o_custkey")).alias("source_table"),
        F.concat(F.lit("dim_"), _text("o_custkey")).alias("sink_table"),
        F.lit("info").alias("sink_family"),
        F.concat(F.lit("id,"), F.col("o_orderpriority")).alias("sink_columns"),
        F.lit("id").alias("sink_row_key"))
    return orders.select(
        op.alias("op"), F.when(op != "c", row).alias("before"),
        F.when(op != "d", row).alias("after"), F.col("o_orderkey").alias("arrival"))


def shifting_config(spark: SparkSession, folder: str) -> DataFrame:
    """Configuration change records of the two dimension tables, one per order, in the order of
    all arrivals: which columns are kept changes with the priority, and some changes are deletions."""
    orders = table(spark, folder, "orders")
    op = (F.when(F.col("o_orderstatus") == "P", "d").when(F.col("o_orderstatus") == "F", "u")
          .otherwise("c"))
    name = F.when(F.col("o_custkey") % 2 == 0, "buyer").otherwise("user")
    number = F.substring("o_orderpriority", 1, 1)
    row = F.struct(
        name.alias("source_table"), F.concat(F.lit("dim_"), name).alias("sink_table"),
        F.lit("info").alias("sink_family"),
        F.when(number == "1", "id,priority,amount,level,score").when(number == "2", "id,priority,level")
        .when(number == "3", "id,amount,score").otherwise("id").alias("sink_columns"),
        F.lit("id").alias("sink_row_key"))
    return orders.select(
        op.alias("op"), F.when(op != "c", row).alias("before"),
        F.when(op != "d", row).alias("after"), F.col("o_orderkey").cast("bigint").alias("arrival"))


def dimension_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Change rows of two dimension tables and one that is no dimension.

    Orders change their buyer, events their user; NULLs and deletions come from status columns.
    """
    orders = table(spark, folder, "orders")
    events = _events_with_k(spark, folder)
    customer = table(spark, folder, "customer")
    kind = F.col("event_type")
    buyer = _changes(
        orders, "buyer", F.when(F.col("o_orderstatus") == "P", "update").otherwise("insert"),
        _seconds("o_orderdate"), F.col("o_orderkey"),
        id=_text("o_custkey"),
        priority=F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")),
        amount=F.when(F.col("o_orderstatus") != "O", _money("o_totalprice")),
        note=F.lit("dropped"))
    user = _changes(
        events, "user", F.when(kind == "error", "delete").when(kind == "signup", "bootstrap-insert")
        .otherwise("update"), _seconds("ts"), F.col("event_id"),
        id=_text("user_id"), level=F.when(kind != "purchase", kind),
        score=F.when(kind != "click", _text("k")))
    other = _changes(customer, "customer", F.lit("insert"), _text("c_custkey"), F.col("c_custkey"),
                     id=_text("c_custkey"))
    return buyer.unionByName(user).unionByName(other)


def dimension_config(spark: SparkSession) -> DataFrame:
    """Configuration of the two dimension tables. The buyer row is updated at arrival 100."""
    rows = [
        ("r", "buyer", "dim_buyer", "info", "id,priority", "id", -2),
        ("r", "user", "dim_user", "info", "id,level,score", "id", -1),
        ("u", "buyer", "dim_buyer", "info", "id,priority,amount", "id", 100),
    ]
    return spark.createDataFrame(
        rows, "op string, source_table string, sink_table string, sink_family string, "
              "sink_columns string, sink_row_key string, arrival bigint")
