"""Session settings and shared working folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def session_config(
    app_name: str = "changeflow",
    master: str | None = None,
    delta: bool = False,
    object_store: Mapping[str, str] | None = None,
    checkpoint_location: str | None = None,
    shuffle_partitions: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Settings for a session, as a dictionary.

    Credentials are not among them: give the object store's provider its own
    (instance profile, environment, credential file).
    """
    conf = {
        "spark.app.name": app_name,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    }
    if master:
        conf["spark.master"] = master
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if checkpoint_location:
        conf["spark.sql.streaming.checkpointLocation"] = checkpoint_location
    if delta:
        conf["spark.sql.extensions"] = "io.delta.sql.DeltaSparkSessionExtension"
        conf["spark.sql.catalog.spark_catalog"] = (
            "org.apache.spark.sql.delta.catalog.DeltaCatalog"
        )
    if object_store:
        conf["spark.hadoop.fs.s3a.impl"] = "org.apache.hadoop.fs.s3a.S3AFileSystem"
        conf["spark.hadoop.fs.s3a.path.style.access"] = "true"
        for name, value in object_store.items():
            if "secret" in name or "key" in name:
                raise ValueError(f"{name}: credentials do not belong into the session settings")
            conf[f"spark.hadoop.fs.s3a.{name}"] = value
    conf.update(extra or {})
    return conf


def build_session(conf: Mapping[str, str]) -> SparkSession:
    builder = SparkSession.builder
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can reach, as the session names it.

    Only a local session may fall back to a folder of this machine.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_SETTING
    )
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    return tempfile.mkdtemp(prefix="changeflow-")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared one."""
    return f"{shared_folder(spark)}/changeflow/{purpose}-{uuid.uuid4().hex}"
