"""Verdicts: the severity of flags, the order of trust between transcriptions of one day, the trust rule of maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FLAGS = ("pass", "review", "fail")


def worst(flag: Column) -> Column:
    """Aggregate: any fail is a fail, else any review a review, else pass."""
    return F.when(F.max((flag == "fail").cast("int")) == 1, "fail").when(F.max((flag == "review").cast("int")) == 1, "review").otherwise("pass")


def trust_rank(qc1: Column, qc2: Column) -> Column:
    """1: the first check passed; 2: it failed, the second passed; 3: it is under review; 4: it failed, the second could not tell;
    5: anything else."""
    first, second = (F.lower(F.trim(F.coalesce(c, F.lit("")))) for c in (qc1, qc2))
    return (
        F.when(first == "pass", 1).when((first == "fail") & (second == "pass"), 2).when(first == "review", 3)
        .when((first == "fail") & (second == "indeterminate"), 4).otherwise(5)
    )


def trusted(qc1: Column, qc2: Column) -> Column:
    return F.coalesce((qc1 == "pass") | qc2.isin("pass", "indeterminate"), F.lit(False))
