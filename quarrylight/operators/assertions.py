"""Fail-closed checks: an assertion raises when a DataFrame of offenders has rows; it reads five of them at most."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class EvidenceError(ValueError):
    """Input that must not be used."""


def none_of_any(*checks: tuple[DataFrame, str]) -> None:
    """Raises with the first of the messages whose offenders exist; all are looked for in one job."""
    found = [df.select(F.lit(i).alias("check"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row")).limit(5) for i, (df, _) in enumerate(checks)]
    some = sorted(tuple(r) for r in reduce(DataFrame.unionByName, found).collect())
    if some:
        raise EvidenceError(f"{checks[some[0][0]][1]}: {[row for i, row in some if i == some[0][0]]}")


def none_of(offenders: DataFrame, message: str) -> None:
    none_of_any((offenders, message))


def repeated_ids(df: DataFrame, key: str) -> tuple[DataFrame, str]:
    """Check for ids that are missing, empty or repeated."""
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return n.filter(F.col(key).isNull() | (F.col(key).cast("string") == "") | (F.col("n") > 1)), f"missing or repeated {key}"


def unique_ids(df: DataFrame, key: str) -> None:
    none_of_any(repeated_ids(df, key))
