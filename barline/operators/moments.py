"""Rolling sums, means and deviations at a cost per row that does not grow with the frame.

A sliding frame aggregates its rows anew for every row.  Here a frame is the difference of two
running sums, today's and that of ``k`` rows before, so a row costs the same for any ``k``.
Differences of floating sums would lose small deviations beside large values; these are exact:
each group (key-day) gets its own shift (the middle of its range) and scale (a power of two), and
the sums are taken over integers ``q = round((x - shift) * scale)``.  For squares ``q`` is cut in
two halves, whose products fit signed longs, and ``n * sum(q^2) - sum(q)^2`` is put together from
their exact differences.  So equal values in a frame have deviation 0, whatever else the day
holds, and an offset common to a day's values costs nothing.

The error of a value is that of rounding it to ``2^-48`` of its group's range (``2^-57`` where only sums are
asked), less for groups of over 4,000 rows by a bit for each doubling (two for a fourfold one where squares are kept).
Values must be finite (``valid_bars`` sees to that); NULL does not count, as in an aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.schemas import DEFAULT_SPEC, SeriesSpec

#: Halves of squared values have at most so many bits; frames have at most ``MAX_FRAME`` rows.
HALF_BITS = 25
MAX_FRAME = 63


@dataclass(frozen=True)
class Measure:
    """Trailing frames over one source: ``outputs`` maps a column to ``(aggregate, rows)`` with the
    aggregate one of ``sum``, ``avg`` and ``stddev``."""

    source: str                               # SQL expression over the frame's columns
    outputs: dict[str, tuple[str, int]]

    @property
    def squares(self) -> bool:
        return any(agg == "stddev" for agg, _ in self.outputs.values())


def _running(j: int, m: Measure) -> dict[str, str]:
    """Running sums of a measure: what each is called, and of what it is the sum."""
    sums = {f"n{j}": f"IF(_x{j} IS NULL, 0L, 1L)", f"s{j}": f"_q{j}"}
    if m.squares:
        sums |= {f"h{j}": f"_h{j}", f"hh{j}": f"_h{j} * _h{j}", f"hl{j}": f"_h{j} * _l{j}", f"ll{j}": f"_l{j} * _l{j}"}
    return sums


def _value(j: int, agg: str, k: int) -> str:
    """An output from the sums ``_n``, ``_s`` and the square ``_sq`` (``n^2`` times the variance) of its frame."""
    n, s = f"_n{j}_{k}", f"_s{j}_{k}"
    if agg == "stddev":
        return f"IF({n} > 1L, sqrt(greatest(_sq{j}_{k}, 0.0D) / (CAST({n} AS DOUBLE) * ({n} - 1L))) / _scale{j}, NULL)"
    if agg == "avg":
        return f"IF({n} > 0L, _mid{j} + {s} / (_scale{j} * {n}), NULL)"
    return f"IF({n} > 0L, _mid{j} * {n} + {s} / _scale{j}, NULL)"


def _squares(df: DataFrame, framed: Sequence[tuple[int, int]]) -> DataFrame:
    """``_sq`` of each measure and frame, from the exact sums over the halves.  Small steps: each is one short
    compiled method (all in one expression would be too long for the compiler)."""
    out = df.selectExpr("*", *[f"_s{x} - shiftleft(_h{x}, _b{j}) AS _low{x}" for j, x in framed])
    out = out.selectExpr("*", *[e for _, x in framed for e in (f"_n{x} * _hh{x} - _h{x} * _h{x} AS _v{x}", f"_n{x} * _hl{x} - _h{x} * _low{x} AS _u{x}",
                                                             f"_n{x} * _ll{x} - _low{x} * _low{x} AS _w{x}")])
    # small spreads stay in longs; where they would not fit, no term cancels another
    out = out.selectExpr("*", *[f"IF(_v{x} < {1 << 36}L, shiftleft(_v{x}, _b{j}) + 2L * _u{x}, NULL) AS _t{x}" for j, x in framed])
    half = "_half{}"
    return out.selectExpr("*", *[
        f"CASE WHEN _t{x} IS NULL THEN (_v{x} * {half.format(j)} + 2.0D * _u{x}) * {half.format(j)} + _w{x} "
        f"WHEN _t{x} < {1 << 37}L THEN CAST(shiftleft(_t{x}, _b{j}) + _w{x} AS DOUBLE) ELSE _t{x} * {half.format(j)} + _w{x} END AS _sq{x}" for j, x in framed])


def with_moments(df: DataFrame, measures: Sequence[Measure], spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    """Adds the outputs of ``measures``: one shuffle and one sort, then three window passes (range
    of the group, running sums, the sums of ``k`` rows before), whatever the frames."""
    frames = sorted({k for m in measures for _, k in m.outputs.values()})
    if frames[-1] > MAX_FRAME:
        raise ValueError(f"frames of at most {MAX_FRAME} rows")
    keep, number = df.columns, list(enumerate(measures))
    group = ", ".join(f"`{c}`" for c in spec.group)
    whole, order = f"(PARTITION BY {group})", f"(PARTITION BY {group} ORDER BY `{spec.time}`)"

    base = [f"`{c}`" for c in keep]

    def step(out: DataFrame, new: list[str], *needed: str) -> DataFrame:
        """Adds columns and keeps of the ``_`` ones only those that later steps need (rows of many
        columns would leave compiled code)."""
        return out.selectExpr(*base, *[f"{n}{j}" for j, m in number for n in needed if m.squares or n not in ("_half", "_h", "_l")], *new)

    out = df.selectExpr(*base, *[f"CAST({m.source} AS DOUBLE) AS _x{j}" for j, m in number])
    out = out.selectExpr("*", f"count(1) OVER {whole} AS _rows", *[f"{f}(_x{j}) OVER {whole} AS _{f}{j}" for j, _ in number for f in ("min", "max")])
    size = "CAST(ceil(log2(_rows)) AS INT)"
    # bits of a value, of its lower half, and the power of two that gives it these bits
    out = step(out, [f"(_min{j} + (_max{j} - _min{j}) / 2) AS _mid{j}" for j, _ in number] + [
        f"least({HALF_BITS}, (62 - {size}) DIV 2) AS _b{j}" if m.squares else f"least(60, 62 - {size}) AS _b{j}" for j, m in number], "_x", "_min", "_max")
    out = step(out, [f"coalesce(IF(_max{j} > _min{j}, pow(2.0D, least(1000.0D, floor(_b{j} * {2 if m.squares else 1} - 1 - log2(_max{j} - _min{j})))), 1.0D), 1.0D) "
                     f"AS _scale{j}" for j, m in number] + [f"pow(2.0D, _b{j}) AS _half{j}" for j, m in number if m.squares], "_x", "_mid", "_b")
    out = step(out, [f"coalesce(CAST(round((_x{j} - _mid{j}) * _scale{j}) AS BIGINT), 0L) AS _q{j}" for j, _ in number], "_x", "_mid", "_b", "_scale", "_half")
    out = step(out, [f"shiftright(_q{j}, _b{j}) AS _h{j}" for j, m in number if m.squares], "_x", "_mid", "_b", "_scale", "_half", "_q")
    out = step(out, [f"_q{j} - shiftleft(_h{j}, _b{j}) AS _l{j}" for j, m in number if m.squares], "_x", "_mid", "_b", "_scale", "_half", "_q", "_h")
    sums = {name: of for j, m in number for name, of in _running(j, m).items()}
    running = f"(PARTITION BY {group} ORDER BY `{spec.time}` ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    out = step(out, [f"sum({of}) OVER {running} AS _r_{name}" for name, of in sums.items()], "_mid", "_b", "_scale", "_half")
    uses = sorted({(j, agg == "stddev", k) for j, m in number for agg, k in m.outputs.values()})
    deep = {(j, k) for j, d, k in uses if d}
    framed = {f"_{n}_{k}": f"_r_{n} - lag(_r_{n}, {k}, 0L) OVER {order}" for j, _, k in uses for n in _running(j, measures[j])
              if (j, k) in deep or n in (f"n{j}", f"s{j}")}
    out = step(out, [f"{e} AS {n}" for n, e in framed.items()], "_mid", "_b", "_scale", "_half")
    out = _squares(out, [(j, f"{j}_{k}") for j, k in sorted(deep)])
    return out.selectExpr(*base, *[f"{_value(j, agg, k)} AS `{name}`" for j, m in number for name, (agg, k) in m.outputs.items()])


def feature_measures(spec: SeriesSpec = DEFAULT_SPEC) -> list[list[Measure]]:
    """The rolling columns of the feature set but for the running peak, in the order they need one
    another.  The deviations stand alone: together with the sums their rows would be too wide to stay compiled."""
    c, v = spec.close, spec.volume
    returns = [
        Measure("log_return", {"momentum_5min": ("avg", 5), "momentum_15min": ("avg", 15), "volatility_15min": ("stddev", 15),
                               "volatility_30min": ("stddev", 30), "volatility_60min": ("stddev", 60)})]
    sums = [
        Measure(v, {"avg_volume_30min": ("avg", 30), "_v_15": ("sum", 15), "_v_30": ("sum", 30)}),
        Measure(f"{c} * {v}", {"_pv_15": ("sum", 15), "_pv_30": ("sum", 30)}),
        Measure(f"{spec.high} - {spec.low}", {"avg_range_15min": ("avg", 15)}),
    ]
    return [returns, sums, [Measure("volatility_30min", {"volatility_mean_60": ("avg", 60), "volatility_std_60": ("stddev", 60)})]]


def with_running_features(bars: DataFrame, spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    """The features of ``features.with_features``, from running sums."""
    from barline.operators.features import derived, level1, with_log_returns, with_rolling

    df = with_rolling(with_log_returns(bars, spec), [r for r in level1(spec) if r.rows is None], spec)
    for measures in feature_measures(spec):
        df = with_moments(df, measures, spec)
    return derived(df, spec)
