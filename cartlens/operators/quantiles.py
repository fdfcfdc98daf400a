"""Exact quantiles with linear interpolation, and what is built on them.

Plain rows: a mergeable KLL sketch per column gives a bracket of values around every wanted rank, and one
more scan counts what lies between the brackets and returns the few values inside. Where a bracket
still holds too many values, it is sketched again. The sketch only proposes; ranks come from the exact counts, so
a proposal that misses costs another round and never a wrong result. Nothing but sketches, counts and
values inside brackets is shuffled.

Weighted rows are first counted per distinct value, which collapses hot values before the shuffle.
Ranks are then found by counting, in the same way whatever the size: every round splits the
interval around each wanted rank into equal parts, counts them, and keeps the part that holds the
rank, until few distinct values are left.

No task ever sorts or holds a whole column. Infinite values have ranks like others.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.session import materialize

PARTS = 1024
FINAL_LIMIT = 4096
# Size of a sketch, and the share of the values on each side of a rank that its bracket takes: three
# times the error that a sketch of this size has in one of a hundred cases.
SKETCH_SIZE = 4096
SPREAD = 0.002
# A bracket of at most so many values is returned, a larger one sketched again.
BRACKET_LIMIT = 50_000


def value_counts(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> DataFrame:
    """column, value (double), n for all columns in one pass; nulls and NaN are left out."""
    picked = [F.col(c).cast("double").alias(c) for c in columns]
    if weight:
        picked.append(F.col(weight).cast("bigint").alias("__w"))
        long = df.select(*picked).unpivot(["__w"], list(columns), "column", "value")
        n = F.sum("__w")
    else:
        long = df.select(*picked).unpivot([], list(columns), "column", "value")
        n = F.count(F.lit(1))
    known = long.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    return known.groupBy("column", "value").agg(n.alias("n"))


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    weight: str | None = None,
    final_limit: int | None = None,
) -> dict[str, list[float | None]]:
    """Quantiles per column; nulls and NaN do not count. weight counts a row several times. Plain rows are scanned
    twice or more, so a frame that is costly to compute should be written before."""
    if weight is None:
        return sketched_quantiles(df, columns, probabilities, final_limit or BRACKET_LIMIT)[0]
    return _weighted_quantiles(df, columns, probabilities, weight, final_limit or FINAL_LIMIT)


def _strictly(x: Column, low: float | None, high: float | None) -> Column:
    inside = x.isNotNull()
    inside = inside if low is None else inside & (x > F.lit(low))
    return inside if high is None else inside & (x < F.lit(high))


def sketched_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], limit: int = BRACKET_LIMIT,
    also: Mapping[str, Column] | None = None,
) -> tuple[dict[str, list[float | None]], dict]:
    """Quantiles per column, and the values of further aggregates of df taken in the first scan."""
    columns, also = list(dict.fromkeys(columns)), dict(also or {})
    every = {(c, None, None): list(probabilities) for c in columns}
    first, brackets = _sketch(df, every, [expr.alias(f"also__{name}") for name, expr in also.items()], ends=True)
    places = {c: [float(p) * (first[f"n__{c}"] - 1) for p in probabilities] for c in columns if first[f"n__{c}"]}
    found: dict[tuple[str, int], float] = {}
    # (column, rank) -> open interval that holds it, values up to its low end, values inside
    open_: dict[tuple[str, int], tuple[float | None, float | None, int, int]] = {}
    proposed: dict[tuple[str, int], tuple[float, float]] = {}
    for c, ps in places.items():
        n = first[f"n__{c}"]
        for p, (low, high) in zip(ps, brackets[c, None, None]):
            for k in (math.floor(p), math.ceil(p)):
                if k == 0:
                    found[c, k] = first[f"low__{c}"]
                elif k == n - 1:
                    found[c, k] = first[f"high__{c}"]
                else:
                    open_[c, k] = (None, None, 0, n)
                    proposed[c, k] = (low, high)
    while open_:
        _count_cells(df, open_, proposed, found, limit)
        proposed = _propose(df, open_, limit) if open_ else {}
    out: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    for c, ps in places.items():
        pairs = [(found[c, math.floor(p)], found[c, math.ceil(p)], p) for p in ps]
        out[c] = [a if a == b else a + (b - a) * (p - math.floor(p)) for a, b, p in pairs]
    return out, {name: first[f"also__{name}"] for name in also}


def _sketch(df: DataFrame, wanted: Mapping, extra: Sequence[Column] = (), ends: bool = False) -> tuple[dict, dict]:
    """One scan: further aggregates, each column's number of values and ends, and a bracket for every wanted
    share of the values in each (column, low, high)."""
    columns = list(dict.fromkeys(c for c, _, _ in wanted))
    names = {c: f"value__{k}" for k, c in enumerate(columns)}
    doubles = {c: F.col(c).cast("double") for c in columns}
    rows = df.withColumns({names[c]: F.when(~F.isnan(x), x) for c, x in doubles.items()})
    aggs = list(extra)
    for c in columns if ends else ():
        x = F.col(names[c])
        aggs += [F.count(x).alias(f"n__{c}"), F.min(x).alias(f"low__{c}"), F.max(x).alias(f"high__{c}")]
    for k, ((c, low, high), shares) in enumerate(wanted.items()):
        x = F.when(_strictly(F.col(names[c]), low, high), F.col(names[c]))
        cuts = F.array(*[F.lit(float(min(max(p + d, 0.0), 1.0))) for p in shares for d in (-SPREAD, SPREAD)])
        sketch = F.kll_sketch_agg_double(x, F.lit(SKETCH_SIZE))
        aggs.append(F.when(F.count(x) > 0, F.kll_sketch_get_quantile_double(sketch, cuts)).alias(f"cuts__{k}"))
    row = rows.agg(*aggs).first().asDict()
    brackets = {}
    for k, (key, shares) in enumerate(wanted.items()):
        cuts = row[f"cuts__{k}"] or []
        brackets[key] = list(zip(cuts[::2], cuts[1::2]))
    return row, brackets


def _propose(df: DataFrame, open_: Mapping, limit: int) -> dict[tuple[str, int], tuple[float | None, float | None]]:
    """A bracket for every open rank: its whole interval if that is small, else from a sketch of it."""
    out, wanted = {}, {}
    for (c, k), (low, high, below, size) in open_.items():
        if size <= limit:
            out[c, k] = (low, high)
        else:
            wanted.setdefault((c, low, high), {})[k] = (k - below + 0.5) / size
    if wanted:
        _, brackets = _sketch(df, {key: list(shares.values()) for key, shares in wanted.items()})
        for (c, low, high), shares in wanted.items():
            out |= {(c, k): b for k, b in zip(shares, brackets[c, low, high])}
    return out


def _count_cells(df: DataFrame, open_: dict, proposed: Mapping, found: dict, limit: int) -> None:
    """One scan: count what lies between the brackets and at their ends, and list or count what is inside.
    Every open rank is found or gets a smaller interval."""
    cuts: dict[str, list[list]] = {}
    for (c, k), (low, high) in proposed.items():
        size = open_[c, k][3]
        listed = size if open_[c, k][:2] == (low, high) else 2 * SPREAD * size
        cuts.setdefault(c, []).append([low, high, listed])
    for c, brackets in cuts.items():
        brackets.sort(key=lambda b: (b[0] is not None, b[0] or 0.0))
        merged: list[list] = []
        for low, high, listed in brackets:
            if merged and (merged[-1][1] is None or low is None or low <= merged[-1][1]):
                last = merged[-1]
                if (low, high) != tuple(last[:2]):
                    last[1] = None if last[1] is None or high is None else max(last[1], high)
                    last[2] += listed
            else:
                merged.append([low, high, listed])
        cuts[c] = merged
    cells = []
    for c, brackets in cuts.items():
        x = F.col(c).cast("double")
        cell, kept = F.lit(4 * len(brackets)), F.lit(False)
        for i, (low, high, listed) in reversed(list(enumerate(brackets))):
            at = F.lit(4 * i + 2)
            if low is not None:
                at = F.when(x < F.lit(low), 4 * i).when(x == F.lit(low), 4 * i + 1).otherwise(at)
            if high is not None:
                at = F.when(x < F.lit(high), at).when(x == F.lit(high), F.lit(4 * i + 1 if low == high else 4 * i + 3)).otherwise(cell)
            cell = at
            if listed <= limit:
                kept = kept | _strictly(x, low, high)
        counted = F.when(x.isNotNull() & ~F.isnan(x), F.struct(F.lit(c).alias("column"), cell.alias("cell"), F.when(kept, x).alias("value")))
        cells.append(counted)
    grouped = df.select(F.explode(F.array(*cells)).alias("c")).filter("c is not null").groupBy("c.column", "c.cell", "c.value")
    rows: dict[str, list] = {}
    for r in grouped.agg(F.count(F.lit(1)).alias("n")).collect():
        rows.setdefault(r["column"], []).append((r["cell"], r["value"], r["n"]))
    for c, brackets in cuts.items():
        seen, ranks = 0, sorted(k for col, k in open_ if col == c)
        for cell, value, n in sorted(rows[c], key=lambda r: (r[0], r[1] is not None, r[1] or 0.0)):
            i, kind = divmod(cell, 4)
            for k in [k for k in ranks if seen <= k < seen + n]:
                if value is not None or kind in (1, 3):
                    found[c, k] = value if value is not None else brackets[i][0 if kind == 1 else 1]
                    del open_[c, k]
                elif kind == 2:
                    open_[c, k] = (brackets[i][0], brackets[i][1], seen, n)
                else:
                    low = brackets[i - 1][1] if i else None
                    open_[c, k] = (low, brackets[i][0] if i < len(brackets) else None, seen, n)
            seen += n


def _weighted_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], weight: str, final_limit: int
) -> dict[str, list[float | None]]:
    counted = materialize(value_counts(df, columns, weight), "value-counts")
    finite = F.abs("value") < math.inf
    sizes = {
        r["column"]: r
        for r in counted.groupBy("column")
        .agg(
            F.count(F.lit(1)).alias("distinct"),
            F.sum("n").alias("n"),
            F.min(F.when(finite, F.col("value"))).alias("low"),
            F.max(F.when(finite, F.col("value"))).alias("high"),
            F.coalesce(F.sum(F.when(F.col("value") == -math.inf, F.col("n"))), F.lit(0)).alias("below"),
            F.coalesce(F.sum(F.when(F.col("value") == math.inf, F.col("n"))), F.lit(0)).alias("above"),
        )
        .collect()
    }
    result: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    if sizes:
        result.update(_by_counting(counted, sizes, probabilities, final_limit))
    return result


def _by_counting(counted: DataFrame, sizes: Mapping, probabilities: Sequence[float], final_limit: int) -> dict:
    places = {c: [float(p) * (r["n"] - 1) for p in probabilities] for c, r in sizes.items()}
    ranks = {(c, k) for c, ps in places.items() for p in ps for k in (math.floor(p), math.ceil(p))}
    # (column, rank) -> interval that holds it, rows below the interval, distinct values in it
    open_: dict[tuple[str, int], tuple] = {}
    found: dict[tuple[str, int], float] = {}
    for c, k in ranks:
        r = sizes[c]
        if k < r["below"]:
            found[c, k] = -math.inf
        elif k >= r["n"] - r["above"]:
            found[c, k] = math.inf
        else:
            open_[c, k] = (r["low"], r["high"], r["below"], r["distinct"])
    while open_:
        for target, (low, high, _, _) in list(open_.items()):
            if low == high:
                found[target] = low
                del open_[target]
        small = {t: s for t, s in open_.items() if s[3] <= final_limit}
        for target, values in _values_inside(counted, small).items():
            seen = small[target][2]
            for value, n in values:
                seen += n
                if seen > target[1]:
                    found[target] = value
                    break
            del open_[target]
        for target, parts in _part_counts(counted, open_).items():
            seen = open_[target][2]
            for low, high, n, distinct in parts:
                if seen + n > target[1]:
                    if open_[target][:2] == (low, high):
                        raise RuntimeError(f"the interval around rank {target[1]} of {target[0]} does not shrink")
                    open_[target] = (low, high, seen, distinct)
                    break
                seen += n
    out = {}
    for c, ps in places.items():
        out[c] = []
        for p in ps:
            below, above = found[c, math.floor(p)], found[c, math.ceil(p)]
            out[c].append(below if below == above else below + (above - below) * (p - math.floor(p)))
    return out


def _matched(counted: DataFrame, targets: Mapping) -> DataFrame:
    """Counted values inside each target's interval. There are at most two targets per wanted
    quantile, so the broadcast side has a fixed size."""
    rows = [(c, k, low, high) for (c, k), (low, high, _, _) in targets.items()]
    wanted = counted.sparkSession.createDataFrame(rows, "`column` string, rank bigint, low double, high double")
    inside = (
        (counted["column"] == wanted["column"])
        & (counted["value"] >= wanted["low"])
        & (counted["value"] <= wanted["high"])
    )
    return counted.join(F.broadcast(wanted), inside).select(counted["column"], "rank", "low", "high", "value", "n")


def _values_inside(counted: DataFrame, targets: Mapping) -> dict:
    if not targets:
        return {}
    out: dict = {}
    rows = _matched(counted, targets).select("column", "rank", "value", "n").orderBy("column", "rank", "value")
    for r in rows.collect():  # at most final_limit values per target
        out.setdefault((r["column"], r["rank"]), []).append((r["value"], r["n"]))
    return out


def _part_counts(counted: DataFrame, targets: Mapping) -> dict:
    if not targets:
        return {}
    width = (F.col("high") / PARTS) - (F.col("low") / PARTS)
    # divided first, so that the span of very large values does not overflow
    part = F.when(width > 0, F.floor(F.col("value") / width - F.col("low") / width)).otherwise(
        (F.col("value") > F.col("low")).cast("bigint")  # too narrow to divide: at least the lowest value comes off
    )
    grouped = (
        _matched(counted, targets)
        .groupBy("column", "rank", part.alias("part"))
        .agg(
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            F.sum("n").alias("n"),
            F.count(F.lit(1)).alias("distinct"),
        )
        .orderBy("column", "rank", "low")
    )
    out: dict = {}
    for r in grouped.collect():  # about PARTS rows per target
        out.setdefault((r["column"], r["rank"]), []).append((r["low"], r["high"], r["n"], r["distinct"]))
    return out


def quantile_frame(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], weight: str | None = None) -> DataFrame:
    """column, probability, value."""
    q = exact_quantiles(df, columns, probabilities, weight)
    rows = [(c, float(p), v) for c in columns for p, v in zip(probabilities, q[c])]
    return df.sparkSession.createDataFrame(rows, "`column` string, probability double, value double")


def iqr_limits(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> dict[str, tuple[float, float]]:
    """Fence per column; a column without values gets a fence that nothing is inside of."""
    quartiles = exact_quantiles(df, columns, (0.25, 0.75), weight)
    return {
        c: (math.nan, math.nan) if q1 is None else (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
        for c, (q1, q3) in quartiles.items()
    }


def inside(column: str, limits: tuple[float, float], strict: bool = False) -> Column:
    low, high = (F.lit(float(x)) for x in limits)
    c = F.col(column)
    return (c > low) & (c < high) if strict else (c >= low) & (c <= high)


def iqr_filter(df: DataFrame, column: str, strict: bool = False) -> DataFrame:
    return df.filter(inside(column, iqr_limits(df, [column])[column], strict))


def iqr_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, limits, and values strictly inside and not inside them."""
    limits = iqr_limits(df, columns)
    aggs = []
    for c in columns:
        within = inside(c, limits[c], strict=True)
        aggs += [F.count_if(within).alias(f"in__{c}"), F.count_if(~within).alias(f"out__{c}")]
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(limits[c][0]).alias("low_limit"),
            F.lit(limits[c][1]).alias("high_limit"),
            F.col(f"in__{c}").alias("inliers"),
            F.col(f"out__{c}").alias("outliers"),
        )
        for c in columns
    ]
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


def quantile_trim(df: DataFrame, column: str, below: float = 0.78, above: float = 0.05) -> DataFrame:
    """Keep values below one quantile, then values above another quantile of what is left."""
    high = exact_quantiles(df, [column], [below])[column][0]
    kept = df.filter(F.col(column) < F.lit(high))
    low = exact_quantiles(kept, [column], [above])[column][0]
    return kept.filter(F.col(column) > F.lit(low))


def quartile_edges(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> dict[str, list[float]]:
    return exact_quantiles(df, columns, (0.0, 0.25, 0.5, 0.75, 1.0), weight)
