"""Risk scoring on top of the rolling features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.functions import flag

# Fixed values of the crash model.
VAR_FACTOR = 1.65                 # 95 % one-sided normal quantile, rounded
CRASH_WEIGHTS = (                 # term -> weight, summed in this order
    ("volatility_zscore", 0.35, False),
    ("volume_ratio", 0.25, False),
    ("drawdown", 0.25, True),     # True = absolute value
    ("log_return", 0.15, True),
)
CRASH_DRAWDOWN = -0.03            # label: drawdown strictly below this
SEVERITY_STEPS = (("LOW", 1.0), ("MEDIUM", 1.5), ("HIGH", 2.0))
SEVERITY_TOP = "CRITICAL"


def with_var_proxy(df: DataFrame, factor: float = VAR_FACTOR) -> DataFrame:
    return df.withColumn("var_95_proxy", F.col("volatility_30min") * factor)


def weighted_index(weights=CRASH_WEIGHTS) -> Column:
    total = None
    for name, w, use_abs in weights:
        term = w * (F.abs(F.col(name)) if use_abs else F.col(name))
        total = term if total is None else total + term
    return total


def with_crash_index(df: DataFrame, weights=CRASH_WEIGHTS) -> DataFrame:
    return df.withColumn("crash_index", weighted_index(weights))


def with_label(df: DataFrame, cutoff: float = CRASH_DRAWDOWN) -> DataFrame:
    """``true_crash`` = 1 when drawdown < cutoff (NULL -> 0)."""
    return df.withColumn("true_crash", flag(F.col("drawdown") < cutoff))


def alert(score: Column, threshold: Column) -> Column:
    return flag(score > threshold)


def severity(score: Column, threshold: Column, steps=SEVERITY_STEPS, top: str = SEVERITY_TOP) -> Column:
    """First step whose ``multiple * threshold`` is >= score; a NULL score
    satisfies no step and falls through to ``top``, as in the source model."""
    out = None
    for name, mult in steps:
        cond = score <= (threshold if mult == 1.0 else mult * threshold)
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out.otherwise(top)


def with_alerts(df: DataFrame, threshold: Column) -> DataFrame:
    """R19/R20.  ``threshold`` is a scalar column: a literal, or a scalar
    subquery (``best.select(...).scalar()``) evaluated once, no join."""
    score = F.col("crash_index")
    return df.withColumns({
        "crash_alert_flag": alert(score, threshold),
        "crash_severity": severity(score, threshold),
    })


def severity_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("crash_severity").agg(F.count(F.lit(1)).alias("n_rows"))
