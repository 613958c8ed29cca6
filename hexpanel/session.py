"""Session construction and small table helpers shared by every stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "hexpanel", master: str | None = None, shuffle_partitions: int | None = None, settings: dict[str, str] | None = None) -> SparkSession:
    """A session with UTC time, AQE and Arrow on. Master, memory and shuffle partitions are what spark-submit or the cluster
    says, unless named here."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true", "spark.ui.enabled": "false", **(settings or {})}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; only Spark's reader touches the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
