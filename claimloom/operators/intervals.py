"""Date intervals per person: spans, timelines, overlaps and points.

Rows are first reduced to one per person and calendar day (a grouped
aggregate that combines before the shuffle).  A person therefore brings at
most as many rows into a window as there are days, however many rows they
had, and no step pairs the rows of a group with each other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.operators.joins import skew_join
from claimloom.operators.rows import valid_intervals
from claimloom.workspace import Workspace


def episode_gaps(df: DataFrame, by: Sequence[str], start: str, end: str) -> DataFrame:
    """Days between each distinct interval and the one before it, with the number of rows sharing it.

    The first interval of a group has a null gap; overlaps are negative.
    """
    distinct = valid_intervals(df, start, end).groupBy(*by, start, end).agg(F.count(F.lit(1)).alias("n_rows"))
    # A group brings one row per start date into the first window, and a start
    # date one row per end date into the second.
    days = distinct.groupBy(*by, start).agg(F.max(end).alias("_latest"))
    days = days.withColumn("_before", F.lag("_latest").over(Window.partitionBy(*by).orderBy(start))).drop("_latest")
    inside = F.lag(end).over(Window.partitionBy(*by, start).orderBy(end))
    both = distinct.withColumn("_inside", inside).join(
        days.withColumnsRenamed({c: f"_{n}" for n, c in enumerate([*by, start])}),
        reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{n}")) for n, c in enumerate([*by, start])]),
    )
    gap = F.datediff(start, F.coalesce("_inside", "_before")) - 1
    return both.select(*by, start, end, "n_rows", gap.alias("gap_days"))


def episode_spans(
    df: DataFrame,
    by: Sequence[str],
    start: str,
    end: str,
    grace: int = 45,
    grace_col: str | None = None,
    carry: Sequence[str] = (),
    running_max: bool = False,
) -> DataFrame:
    """Join intervals of a group into spans where the gap is at most ``grace`` days.

    The gap is measured to the end of the previous row in (start, end) order,
    or with ``running_max`` to the latest end so far.  ``grace_col`` gives a
    grace period per row; the first row of a start date decides.  ``carry``
    columns come from the row that ends the span.  Adds ``<start>_span``,
    ``<end>_span`` and ``SPAN_DAYS``.
    """
    if grace < 0:
        raise ValueError("grace must not be negative")
    # Rows of one start date never open a new span among themselves, so their
    # latest end is all that later rows need.
    last = F.max(F.struct(F.col(end).alias("end"), *carry)) if carry else F.max(end)
    aggs = [last.alias("_last")]
    if grace_col:
        first = F.min(F.struct(F.col(end).alias("end"), F.col(grace_col).alias("grace")))
        aggs.append(first.alias("_first"))
    days = valid_intervals(df, start, end).groupBy(*by, start).agg(*aggs)
    last_end = F.col("_last.end") if carry else F.col("_last")

    order = Window.partitionBy(*by).orderBy(start)
    if running_max:
        previous = F.max(last_end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    else:
        previous = F.lag(last_end).over(order)
    allowed = F.col("_first.grace") if grace_col else F.lit(grace)
    gap = F.datediff(start, "_previous") - 1
    islands = (
        days.withColumn("_previous", previous)
        .withColumn("_opens", (F.col("_previous").isNull() | (gap > allowed)).cast("int"))
        .withColumn("_island", F.sum("_opens").over(order))
    )
    spans = islands.groupBy(*by, "_island").agg(F.min(start).alias(f"{start}_span"), F.max("_last").alias("_last"))
    return spans.select(
        *by,
        f"{start}_span",
        last_end.alias(f"{end}_span"),
        (F.datediff(last_end, f"{start}_span") + 1).alias("SPAN_DAYS"),
        *[F.col(f"_last.{c}").alias(c) for c in carry],
    )


def look_ahead(df: DataFrame, by: Sequence[str], date: str, last: str, name: str = "PeriodEnd") -> DataFrame:
    """Distinct dates per group as periods: each ends the day before the next, the last one at ``last``."""
    order = Window.partitionBy(*by).orderBy(date)
    ends = F.coalesce(F.date_sub(F.lead(date).over(order), 1), F.lit(last).cast("date"))
    return df.select(*by, date).distinct().withColumn(name, ends)


def coverage_timeline(
    spans: DataFrame, by: Sequence[str], kind: str, kinds: dict[str, str], start: str, end: str, study_end: str
) -> DataFrame:
    """Cut the spans of several kinds into periods of constant coverage.

    ``kinds`` maps a value of the ``kind`` column to its output flag.  Periods
    begin where a span starts or the day after one ends; a period is ``Y``
    for a kind that covers it, else ``N``; periods no kind covers are left out.
    Coverage on a date is the number of spans begun minus those ended, so one
    ordered pass per person is enough.
    """
    last = F.lit(study_end).cast("date")
    event = F.inline(
        F.array(
            F.struct(F.col(start).alias("_day"), F.lit(1).alias("_step"), F.lit(True).alias("_change")),
            F.struct(F.date_add(F.col(end), 1).alias("_day"), F.lit(-1).alias("_step"), (F.col(end) != last).alias("_change")),
        )
    )
    steps = (
        spans.select(*by, kind, start, end)
        .select(*by, kind, event)
        .groupBy(*by, "_day")
        .agg(
            F.max("_change").alias("_change"),
            *[F.sum(F.when(F.col(kind) == k, F.col("_step")).otherwise(0)).alias(flag) for k, flag in kinds.items()],
        )
    )
    order = Window.partitionBy(*by).orderBy("_day")
    covered = steps.withColumns({flag: F.sum(flag).over(order) for flag in kinds.values()}).where("_change")
    ends = F.coalesce(F.date_sub(F.lead("_day").over(order), 1), last)
    any_kind = F.greatest(*kinds.values()) > 0
    return (
        covered.withColumn("PeriodEnd", ends)
        .where(any_kind)
        .select(
            *by,
            F.col("_day").alias("PeriodStart"),
            "PeriodEnd",
            *[F.when(F.col(flag) > 0, "Y").otherwise("N").alias(flag) for flag in kinds.values()],
        )
    )


def count_until(points: DataFrame, asked: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """For each distinct (group, date) in ``asked``: points of the group on or before it.

    Both inputs have the columns ``by`` and ``day``.
    """
    marked = points.select(*by, "day", F.lit(1).alias("_n"), F.lit(False).alias("_asked")).unionByName(
        asked.select(*by, "day", F.lit(0).alias("_n"), F.lit(True).alias("_asked"))
    )
    days = (
        marked.where(F.col("day").isNotNull()).groupBy(*by, "day").agg(F.sum("_n").alias("_n"), F.max("_asked").alias("_asked"))
    )
    so_far = F.sum("_n").over(Window.partitionBy(*by).orderBy("day"))
    return days.withColumn(name, so_far).where("_asked").select(*by, "day", name)


def _look_up_days(
    df: DataFrame, by: Sequence[str], until: tuple[DataFrame, Column], before: tuple[DataFrame, Column], options
) -> DataFrame:
    """Add ``_n``, the count until one day less the count until another."""
    out = df
    for counts, day in ((until[0].toDF(*by, "day", "_b"), until[1]), (before[0].toDF(*by, "day", "_a"), before[1])):
        keys = df.select(*by, day.alias("day"))
        out = skew_join(out.withColumn("day", day), counts, [*by, "day"], "left", keys_from=keys, **options).drop("day")
    return out.withColumn("_n", F.coalesce(F.col("_b") - F.col("_a"), F.lit(0)).cast("long")).drop("_a", "_b")


def _bin(day: Column, days: int) -> Column:
    return F.floor(F.unix_date(day) / days)


def _binned(df: DataFrame, lo: str, hi: str, days: int) -> DataFrame:
    """Intervals that hold a day, once for each bin of days that they touch."""
    whole = valid_intervals(df, lo, hi).where(F.col(lo) <= F.col(hi))
    return whole.withColumn("_bin", F.explode(F.sequence(_bin(F.col(lo), days), _bin(F.col(hi), days))))


def _no_clash(left: DataFrame, right: DataFrame, by: Sequence[str]) -> None:
    clash = {c.lower() for c in left.columns} & {c.lower() for c in right.columns} - {c.lower() for c in by}
    if clash:
        raise ValueError(f"columns on both sides: {', '.join(sorted(clash))}")


_WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _check_totals(right: DataFrame, start: str, totals: Mapping[str, tuple[str, str | None]]) -> None:
    for name, (kind, column) in totals.items():
        if kind == "sum" and isinstance(right.schema[column].dataType, _WHOLE_NUMBERS):
            continue
        if not (kind == "count" or (kind == "min" and column == start)):
            raise ValueError(f"cannot total without pairs: {name}")


def _pair_totals(
    left: DataFrame, right: DataFrame, by: Sequence[str], span: tuple[str, str], other: tuple[str, str], totals, options
) -> DataFrame:
    """Each left interval that has a pair, with totals over its pairs.

    The right intervals that share a day with it are those begun by its end,
    less those ended before its start; the earliest of them is the earliest of
    all that end on its start or later.  Both are running totals over one row
    per group and day, so pairs are never formed.
    """
    _check_totals(right, other[0], totals)
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in by])
    left, right = (valid_intervals(df, lo, hi).where(known) for df, (lo, hi) in ((left, span), (right, other)))
    summed = list(dict.fromkeys(c for kind, c in totals.values() if kind == "sum"))
    # The number of pairs, then sum and number of known values of each column.
    measures = [F.lit(1).cast("long"), *[m for c in summed for m in (F.coalesce(F.col(c).cast("long"), F.lit(0)), F.col(c).isNotNull().cast("long"))]]
    names = [f"_m{i}" for i in range(len(measures))]

    def by_day(point: Column, asked: str) -> DataFrame:
        points = right.select(*by, point.alias("_day"), F.col(other[0]).alias("_start"), F.lit(False).alias("_asked"), *[m.alias(n) for m, n in zip(measures, names)])
        zeros = [F.lit(0).cast("long").alias(n) for n in names]
        days = left.select(*by, F.col(asked).alias("_day"), F.lit(None).cast(points.schema["_start"].dataType).alias("_start"), F.lit(True).alias("_asked"), *zeros)
        return points.unionByName(days).groupBy(*by, "_day").agg(
            F.min("_start").alias("_start"), F.max("_asked").alias("_asked"), *[F.sum(n).alias(n) for n in names]
        )

    group = Window.partitionBy(*by)
    so_far, later = group.orderBy("_day"), group.orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, -1)
    begun = by_day(F.col(other[0]), span[1]).withColumns({n: F.sum(n).over(so_far) for n in names})
    ended = by_day(F.date_add(other[1], 1), span[0]).withColumns({f"_e{n}": F.sum(n).over(so_far) for n in names} | {"_first": F.min("_start").over(later)})
    out = left
    for day, counts in ((span[1], begun.select(*by, "_day", "_asked", *names)), (span[0], ended.select(*by, "_day", "_asked", "_first", *[f"_e{n}" for n in names]))):
        keys = left.select(*by, F.col(day).alias("_day"))
        out = skew_join(out.withColumn("_day", F.col(day)), counts.where("_asked").drop("_asked"), [*by, "_day"], keys_from=keys, **options).drop("_day")

    def shared(i: int) -> Column:
        return F.col(names[i]) - F.col(f"_e{names[i]}")

    def total(kind: str, column: str | None) -> Column:
        if kind == "sum":
            at = 1 + 2 * summed.index(column)
            return F.when(shared(at + 1) > 0, shared(at))
        return shared(0) if kind == "count" else F.col("_first")

    return out.where(shared(0) > 0).select(*left.columns, *[total(*t).alias(name) for name, t in totals.items()])


def interval_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    span: tuple[str, str],
    other: tuple[str, str],
    days: int = 64,
    totals: Mapping[str, tuple[str, str | None]] | None = None,
    **options,
) -> DataFrame:
    """Pairs of a group's intervals that share a day: the columns of both sides, ``by`` once.

    Intervals are cut into bins of ``days`` days and meet bin by bin; only the
    bin in which the later one starts reports a pair, so each pair comes once.
    A group of very many rows is spread over its bins.  Rows grow with the days
    covered and with the pairs found.  Intervals without both ends, or with the
    end before the start, hold no day and match nothing, like a missing group.

    ``totals`` asks for one row per left row that has pairs, with totals over
    them: it maps a new column to ``("count", None)``, to ``("sum", column)`` of
    whole numbers, or to ``("min", start)`` of the right side's start.  Work
    then grows with the rows, however many pairs a hot group has.
    """
    _no_clash(left, right, by)
    if totals is not None:
        return _pair_totals(left, right, by, span, other, totals, options)
    (ls, le), (rs, re_) = span, other
    pairs = skew_join(_binned(left, ls, le, days), _binned(right, rs, re_, days), [*by, "_bin"], **options)
    later = F.greatest(ls, rs)
    return pairs.where((F.col(ls) <= F.col(re_)) & (F.col(rs) <= F.col(le)) & (_bin(later, days) == F.col("_bin"))).drop("_bin")


def point_join(
    points: DataFrame, stays: DataFrame, by: Sequence[str], point: str, span: tuple[str, str], days: int = 64, **options
) -> DataFrame:
    """Pairs of a group's points and the intervals that hold them, both ends included: the columns of both sides, ``by`` once.

    A point lies in one bin of days, so it meets the intervals that touch this
    bin only; see ``interval_join``.
    """
    _no_clash(points, stays, by)
    lo, hi = span
    placed = points.where(F.col(point).isNotNull()).withColumn("_bin", _bin(F.col(point), days))
    pairs = skew_join(placed, _binned(stays, lo, hi, days), [*by, "_bin"], **options)
    return pairs.where(F.col(point).between(F.col(lo), F.col(hi))).drop("_bin")


def count_inside(
    stays: DataFrame, points: DataFrame, by: Sequence[str], lo: str, hi: str, point: str, name: str, ws: Workspace, **options
) -> DataFrame:
    """Add to each interval the number of the group's points in it, both ends included."""
    days = points.select(*by, F.col(point).alias("day"))
    asked = stays.select(*by, F.inline(F.array(F.struct(F.date_sub(lo, 1).alias("day")), F.struct(F.col(hi).alias("day")))))
    counts = ws.keep(count_until(days, asked, by, "_upto"), f"count-{name}")
    out = _look_up_days(stays, by, (counts, F.col(hi)), (counts, F.date_sub(lo, 1)), options)
    return out.withColumn(name, F.greatest("_n", F.lit(0))).drop("_n")


def count_overlaps(
    periods: DataFrame,
    spans: DataFrame,
    by: Sequence[str],
    period: tuple[str, str],
    span: tuple[str, str],
    name: str,
    ws: Workspace,
    **options,
) -> DataFrame:
    """Add to each period the number of the group's spans that share a day with it.

    That is the spans begun by its end, less those ended before its start.
    Spans and periods without both ends, or with the end before the start,
    hold no day: such spans are not counted, such periods get zero.
    """
    ps, pe = period
    spans = spans.where(F.col(span[0]) <= F.col(span[1]))
    begun = count_until(
        spans.select(*by, F.col(span[0]).alias("day")), periods.select(*by, F.col(pe).alias("day")), by, "_b"
    )
    ended = count_until(
        spans.select(*by, F.col(span[1]).alias("day")), periods.select(*by, F.date_sub(ps, 1).alias("day")), by, "_a"
    )
    begun, ended = ws.keep(begun, f"begun-{name}"), ws.keep(ended, f"ended-{name}")
    out = _look_up_days(periods, by, (begun, F.col(pe)), (ended, F.date_sub(ps, 1)), options)
    whole = F.coalesce(F.col(ps) <= F.col(pe), F.lit(False))
    return out.withColumn(name, F.when(whole, F.col("_n")).otherwise(F.lit(0).cast("long"))).drop("_n")
