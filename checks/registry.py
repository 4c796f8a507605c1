"""Registered queries: a Spark plan over the driver's tables and the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Plan = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def present(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, so both engines print them alike."""
    shown = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.select(
        [
            F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, shown) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def check(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan; without ``sql`` only its rows are looked at and pytest covers its values."""

    def register(plan: Plan) -> Plan:
        if name in PLANS:
            raise ValueError(f"{name} registered twice")
        PLANS[name] = lambda spark, sf_dir: present(plan(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return register
