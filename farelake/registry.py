"""Every registered query: name -> (spark, sf_dir) -> DataFrame over the given tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def tidy(df: DataFrame) -> DataFrame:
    """Common result types: whole numbers as bigint, fractions as doubles rounded to 4 digits; NUMERIC(10,2) stays."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif f.dataType == T.DecimalType(10, 2):
            pass
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.rint((c.cast("double") + 1e-9) * 1e4) / 1e4
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        @functools.wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(build(prepare(spark), sf_dir))

        QUERIES[name] = run
        return run

    return register
