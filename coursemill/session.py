"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that may be changed on a running session and that results rely on.
RESULT_CONF = {
    # Day and window texts are rendered in one explicit zone.
    "spark.sql.session.timeZone": "UTC",
}

# Settings that a new session starts with. AQE picks join sides by their measured
# size, merges small shuffle partitions and splits skewed ones.
START_CONF = {
    **RESULT_CONF,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Keyed state of millions of devices does not belong on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def start(app: str = "coursemill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**START_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_result_conf(spark: SparkSession) -> SparkSession:
    for key, value in RESULT_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one the cluster shares between its machines.

    The shared folder is the session's ``spark.checkpoint.dir``. Without that setting a
    local session (tests) takes a temporary folder; a cluster session is refused, since
    a folder of one machine is lost with it and unseen by the others.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="coursemill-")
    return f"{shared.rstrip('/')}/coursemill/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows below the shared folder and read them back.

    This is the hop between two jobs: the second one may scan the rows more than once, and a
    lost executor costs a scan, not the first job.
    """
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
