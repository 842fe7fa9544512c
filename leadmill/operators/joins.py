"""Join helpers: anti/semi joins, null-aware NOT IN, the domain join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import domain_key

def anti(left: DataFrame, right: DataFrame, on: Column | list | str) -> DataFrame:
    """Rows of ``left`` with no match in ``right`` (LEFT JOIN … WHERE right.key IS NULL).

    Written as a real left-anti join: Catalyst does not rewrite the outer-join-plus-IS-NULL form,
    and the anti join never multiplies rows.
    """
    return left.join(right, on=on, how="left_anti")


def semi(left: DataFrame, right: DataFrame, on: Column | list | str) -> DataFrame:
    return left.join(right, on=on, how="left_semi")


def not_in(left: DataFrame, key: str, values: DataFrame, value_col: str, null_safe: bool = False) -> DataFrame:
    """SQL ``left.key NOT IN (SELECT value_col FROM values)`` with exact three-valued logic.

    SQL semantics: if the set is empty every row passes (even a NULL key); otherwise a NULL key
    never passes, and any NULL in the set makes no row pass. Spark plans the SQL form as a
    broadcast null-aware anti join, whose build side grows with the history. Here the set's
    size and non-null count are two scalar subqueries (one aggregate job each, a number each),
    and the membership test is an ordinary anti join that may shuffle.
    ``null_safe=True`` ignores NULLs in the set (NULL keys still fail against a non-empty set).
    """
    n = values.select(F.count(F.lit(1))).scalar()
    k = values.select(F.count(F.col(value_col))).scalar()
    vals = values.where(F.col(value_col).isNotNull()).select(F.col(value_col).alias("_v"))
    unmatched = anti(left, vals, F.col(key) == F.col("_v"))   # NULL keys have no match: kept here
    if null_safe:
        return unmatched.where((k == 0) | F.col(key).isNotNull())
    return unmatched.where((n == 0) | ((n == k) & F.col(key).isNotNull()))


def domain_join(left: DataFrame, url_col: str, right: DataFrame, domain_col: str, how: str = "left") -> DataFrame:
    """J-11: equi join on the normalised domain of both sides; the key is computed once per side.

    Many right rows on one domain multiply the left row (as in SQL); NULL never matches, '' does.
    """
    l = left.withColumn("_dk", domain_key(F.col(url_col)))
    r = right.withColumn("_rk", domain_key(F.col(domain_col)))
    return l.join(r, F.col("_dk") == F.col("_rk"), how).drop("_dk", "_rk")
