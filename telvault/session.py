"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package assumes. Timestamps are wall-clock UTC
# values without zone (the landing files carry no offset), so the session
# zone is pinned and literals parse as TIMESTAMP_NTZ.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_spark(master: str | None = None, app_name: str = "telvault",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; locally
    ``local[N]``. The UI is off: no job here needs a web server.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(REQUIRED_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the runtime SQL confs the jobs depend on (safe on a shared session)."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, for written intermediates.

    A cluster names a shared (distributed) folder there; it is only read. Where
    it is unset in a local session, a folder inside the warehouse is used; on a
    cluster that is an error, for the warehouse may be each machine's own folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (d or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared").rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back (the "table" materialization).

    Used where one built table feeds several downstream products: a lost
    executor re-reads files instead of replaying the whole upstream plan, and
    readers keep column pruning and size statistics, which a row-form
    checkpoint would lose.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/tables/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
