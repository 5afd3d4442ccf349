"""Helpers shared by the query catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DP = 6  # result doubles are rounded to 6 dp so engines agree despite summation order


def round_doubles(df: DataFrame, dp: int = DP) -> DataFrame:
    """Round every double/float column; other columns pass through."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name).cast("double"), dp).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def rnd(expr: str, dp: int = DP) -> str:
    """SQL: ROUND(CAST(expr AS DOUBLE), dp) for the oracle side."""
    return f"ROUND(CAST({expr} AS DOUBLE), {dp})"
