"""Settings that the engine's results and pushdown rely on, and the registration of its SQL names."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .functions import sql as sql_functions
from .sources import arrow_table, remote_arrow


def configured(spark: SparkSession) -> SparkSession:
    """``spark`` with a UTC clock and filters pushed into Python sources."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def register_all(spark: SparkSession) -> SparkSession:
    """The functions, table functions and the data source under their SQL names."""
    configured(spark)
    sql_functions.register(spark)
    spark.dataSource.register(remote_arrow.RemoteArrow)
    arrow_table.register(spark)
    return spark
