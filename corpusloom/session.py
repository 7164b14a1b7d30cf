"""Spark session for the command line, the bench and the tests."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(app_name: str = "corpusloom", **settings: object) -> SparkSession:
    """Session with adaptive execution on; master and sizes come from outside.

    ``settings`` are Spark keys with '__' for '.', as in ``spark__ui__enabled``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in settings.items():
        name = key.replace("__", ".")
        builder = builder.master(str(value)) if name == "master" else builder.config(name, str(value))
    return builder.getOrCreate()
