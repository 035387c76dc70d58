"""Threshold back-test in one pass.

For a sorted grid ``t_0 < ... < t_{n-1}`` each row gets the bucket ``b`` =
number of thresholds strictly below its score (a NULL score is never
predicted, b = 0).  The row is predicted positive at ``t_i`` exactly when
``b > i``.  One ``groupBy(*by, b)`` (partial aggregation, at most n + 1 rows
per group after the shuffle) replaces one job per threshold; a second
aggregation over those few rows yields TP/FP/FN for every threshold.

The bucket rows are a state that can be kept per day and merged in any order
(``sweep_state``): the threshold and the run metrics of a whole table follow from
the kept rows of unchanged days and the new rows of changed ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The candidate thresholds 0.5, 1.0, ..., 5.0.
THRESHOLD_STEP = 0.5
THRESHOLD_COUNT = 10
DEFAULT_GRID = tuple(THRESHOLD_STEP * i for i in range(1, THRESHOLD_COUNT + 1))


def _dbl(t: float) -> str:
    return f"CAST('{float(t)!r}' AS DOUBLE)"


def bucket_sql(score: str, grid: Sequence[float]) -> str:
    """Count of grid values strictly below ``score`` (exact comparisons)."""
    return " + ".join(f"CASE WHEN `{score}` > {_dbl(t)} THEN 1 ELSE 0 END" for t in grid)


def confusion_sweep(df: DataFrame, score: str = "crash_index", label: str = "true_crash",
                    grid: Sequence[float] = DEFAULT_GRID, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, threshold, tp, fp, fn)`` for every threshold of the grid.

    Built from SQL expression text: one JVM call per expression instead of
    one per column node; the plan is the same.
    """
    grid = sorted(float(t) for t in grid)
    stats = (df.selectExpr(*[f"`{c}`" for c in by], f"{bucket_sql(score, grid)} AS bucket", f"`{label}` = 1 AS _pos")
               .groupBy(*by, "bucket")
               .agg(F.expr("count_if(_pos) AS positives"), F.expr("count(1) AS n")))
    return sweep_of_state(stats, grid, by)


def sweep_state(df: DataFrame, by: Sequence[str], score: str = "crash_index", label: str = "true_crash",
                grid: Sequence[float] = DEFAULT_GRID) -> DataFrame:
    """One row per ``(*by, bucket)``: rows, positives, and number, mean and sum of squared
    deviations of the score (NULL scores do not count there)."""
    grid = sorted(float(t) for t in grid)
    return (df.selectExpr(*[f"`{c}`" for c in by], f"{bucket_sql(score, grid)} AS bucket", f"`{label}` = 1 AS _pos", f"`{score}` AS _s")
              .groupBy(*by, "bucket")
              .agg(F.expr("count(1) AS n"), F.expr("count_if(_pos) AS positives"), F.expr("count(_s) AS scored"),
                   F.expr("coalesce(avg(_s), 0.0D) AS mean"), F.expr("coalesce(var_pop(_s) * count(_s), 0.0D) AS m2")))


def merge_states(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of several parts as the state of the whole (per ``by``).  Deviations are taken
    around the common mean, so nothing cancels."""
    common = Window.partitionBy(*by, "bucket")
    total = F.sum(F.col("scored") * F.col("mean")).over(common) / F.greatest(F.sum("scored").over(common), F.lit(1))
    return (state.withColumn("_mean", total).groupBy(*by, "bucket")
            .agg(F.sum("n").alias("n"), F.sum("positives").alias("positives"), F.sum("scored").alias("scored"), F.max("_mean").alias("mean"),
                 F.sum(F.col("m2") + F.col("scored") * F.pow(F.col("mean") - F.col("_mean"), 2)).alias("m2")))


def metrics_of_state(state: DataFrame, threshold: float, grid: Sequence[float] = DEFAULT_GRID) -> DataFrame:
    """One row ``rows, alert_rate, crash_index_mean, crash_index_std`` of the whole, for a threshold of the grid."""
    above = sorted(float(t) for t in grid).index(float(threshold))
    whole = merge_states(state.withColumn("bucket", F.lit(0)))
    alerts = state.agg(F.sum(F.expr(f"IF(bucket > {above}, n, 0L)")).alias("a")).select("a").scalar()
    return whole.select(F.col("n").alias("rows"), (alerts / F.col("n")).alias("alert_rate"),
                        F.expr("IF(scored > 0, mean, NULL)").alias("crash_index_mean"),
                        F.expr("IF(scored > 1, sqrt(m2 / (scored - 1)), NULL)").alias("crash_index_std"))


def sweep_of_state(stats: DataFrame, grid: Sequence[float] = DEFAULT_GRID, by: Sequence[str] = ()) -> DataFrame:
    """The sweep from bucket rows ``(*by, bucket, n, positives)`` of any number of parts."""
    grid = sorted(float(t) for t in grid)
    keys = [f"`{c}`" for c in by]
    per_t = []
    for i in range(len(grid)):
        per_t += [F.expr(f"coalesce(sum(CASE WHEN bucket > {i} THEN positives ELSE 0 END), 0) AS _tp{i}"),
                  F.expr(f"coalesce(sum(CASE WHEN bucket > {i} THEN n - positives ELSE 0 END), 0) AS _fp{i}")]
    totals = stats.groupBy(*by).agg(F.expr("coalesce(sum(positives), 0) AS _P"), *per_t)
    rows = ", ".join(
        f"named_struct('threshold', {_dbl(t)}, 'tp', CAST(_tp{i} AS BIGINT), "
        f"'fp', CAST(_fp{i} AS BIGINT), 'fn', CAST(_P - _tp{i} AS BIGINT))"
        for i, t in enumerate(grid))
    return totals.selectExpr(*keys, f"inline(array({rows}))")


def _ratio0(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def scores(sweep: DataFrame) -> DataFrame:
    """Precision, recall, F1; each 0 when its denominator is 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    out = sweep.withColumns({
        "precision": _ratio0(tp, tp + fp),
        "recall": _ratio0(tp, tp + fn),
    })
    p, r = F.col("precision"), F.col("recall")
    return out.withColumn("f1", _ratio0(2 * p * r, p + r))


def best(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The threshold with the highest F1, the lowest threshold on ties."""
    order = [F.col("f1").desc(), F.col("threshold").asc()]
    if not by:
        return scored.orderBy(*order).limit(1)
    rn = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return scored.withColumn("_rn", rn).filter("_rn = 1").drop("_rn")


def best_per_group(df: DataFrame, by: Sequence[str], score: str = "crash_index", label: str = "true_crash",
                   grid: Sequence[float] = DEFAULT_GRID, extra: Sequence[str] = ()) -> DataFrame:
    """R16-R18 per group in ONE aggregation: per group and threshold the
    conditional counts TP/FP, plus ``extra`` aggregate expressions (SQL text).
    The best threshold is picked inside the row (``array_max`` over
    ``(f1, -threshold)``), so there is no join and no second pass.

    Output: ``(*by, *extra, threshold, tp, fp, fn, precision, recall, f1)``.
    """
    grid = sorted(float(t) for t in grid)
    pos = f"`{label}` = 1"
    aggs = [F.expr(e) for e in extra] + [F.expr(f"count_if({pos}) AS _P")]
    for i, t in enumerate(grid):
        hit = f"`{score}` > {_dbl(t)}"
        aggs += [F.expr(f"count_if({hit} AND {pos}) AS _tp{i}"),
                 F.expr(f"count_if({hit} AND NOT ({pos})) AS _fp{i}")]
    per = df.groupBy(*by).agg(*aggs)

    def ratio(num: str, den: str) -> str:
        return f"CASE WHEN {den} > 0 THEN {num} / {den} ELSE 0.0D END"

    cands = []
    for i, t in enumerate(grid):
        tp, fp, fn = f"_tp{i}", f"_fp{i}", f"(_P - _tp{i})"
        p, r = ratio(tp, f"({tp} + {fp})"), ratio(tp, f"({tp} + {fn})")
        f1 = ratio(f"2 * ({p}) * ({r})", f"(({p}) + ({r}))")
        cands.append(f"named_struct('f1', {f1}, 'neg_t', -{_dbl(t)}, 'threshold', {_dbl(t)}, "
                     f"'tp', CAST({tp} AS BIGINT), 'fp', CAST({fp} AS BIGINT), 'fn', CAST({fn} AS BIGINT), "
                     f"'precision', {p}, 'recall', {r})")
    internal = {"_P", *[f"_tp{i}" for i in range(len(grid))], *[f"_fp{i}" for i in range(len(grid))]}
    names = [c for c in per.columns if c not in internal]
    best_s = per.selectExpr(*[f"`{c}`" for c in names], f"array_max(array({', '.join(cands)})) AS _best")
    return best_s.select(*names, *[F.col(f"_best.{c}").alias(c) for c in
                                   ("threshold", "tp", "fp", "fn", "precision", "recall", "f1")])


def best_threshold(df: DataFrame, score: str = "crash_index", label: str = "true_crash",
                   grid: Sequence[float] = DEFAULT_GRID) -> DataFrame:
    """One row ``(threshold, tp, fp, fn, precision, recall, f1)``, from a
    single global aggregation."""
    return best_per_group(df, (), score, label, grid)
