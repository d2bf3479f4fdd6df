import datetime as dt
import random

import pytest
from conftest import rows_of

from claimloom.operators import intervals

D0 = dt.date(2008, 1, 1)


def day(n):
    return D0 + dt.timedelta(days=n)


def frame(spark, rows, extra=""):
    return spark.createDataFrame([(p, day(a), day(b), *x) for p, a, b, *x in rows], f"p string, s date, e date{extra}")


def spans(df):
    return sorted((r["p"], (r["s_span"] - D0).days, (r["e_span"] - D0).days, r["SPAN_DAYS"]) for r in df.collect())


def test_gap_within_and_beyond_grace(spark):
    df = frame(spark, [("a", 0, 9), ("a", 15, 20), ("a", 22, 30)])
    assert spans(intervals.episode_spans(df, ["p"], "s", "e", grace=5)) == [("a", 0, 30, 31)]
    assert spans(intervals.episode_spans(df, ["p"], "s", "e", grace=4)) == [("a", 0, 9, 10), ("a", 15, 30, 16)]


def test_gap_is_to_previous_row_unless_running_max(spark):
    # The short middle interval hides the long first one.
    df = frame(spark, [("a", 0, 100), ("a", 10, 12), ("a", 50, 60)])
    assert spans(intervals.episode_spans(df, ["p"], "s", "e", grace=0)) == [("a", 0, 100, 101), ("a", 50, 60, 11)]
    assert spans(intervals.episode_spans(df, ["p"], "s", "e", grace=0, running_max=True)) == [("a", 0, 100, 101)]


def test_backward_intervals_are_left_out_and_one_day_kept(spark):
    df = frame(spark, [("a", 5, 4), ("a", 8, 8)])
    assert spans(intervals.episode_spans(df, ["p"], "s", "e", grace=0)) == [("a", 8, 8, 1)]


def test_grace_per_row_and_carried_column(spark):
    df = frame(spark, [("a", 0, 1, 0, "x"), ("a", 5, 6, 3, "y"), ("a", 12, 13, 4, "z")], ", g int, v string")
    out = intervals.episode_spans(df, ["p"], "s", "e", grace_col="g", carry=["v"])
    assert sorted((r["s_span"], r["v"]) for r in out.collect()) == [(day(0), "y"), (day(12), "z")]
    with pytest.raises(ValueError):
        intervals.episode_spans(df, ["p"], "s", "e", grace=-1)


def by_rows(rows, grace):
    """Row-at-a-time rule: sort, compare with the previous row's end."""
    out = {}
    for p in {r[0] for r in rows}:
        start = prev = None
        for a, b in sorted((a, b) for q, a, b in rows if q == p and b >= a):
            if prev is None or a - prev - 1 > grace:
                start = a
            out[p, start] = max(out.get((p, start), b), b)
            prev = b
    return sorted((p, s, e, e - s + 1) for (p, s), e in out.items())


@pytest.mark.parametrize("seed", range(3))
def test_spans_equal_the_row_rule_with_one_person_holding_most_rows(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for _ in range(400):
        a = rnd.randrange(300)
        rows.append(("hot" if rnd.random() < 0.5 else rnd.choice("abcd"), a, a + rnd.randrange(-2, 12)))
    rows += [rows[0]] * 50
    for grace in (0, 3):
        assert spans(intervals.episode_spans(frame(spark, rows), ["p"], "s", "e", grace=grace)) == by_rows(rows, grace)


def test_gaps(spark):
    df = frame(spark, [("a", 0, 3), ("a", 0, 3), ("a", 6, 7), ("b", 1, 1)])
    got = rows_of(intervals.episode_gaps(df, ["p"], "s", "e").select("p", "s", "n_rows", "gap_days"))
    assert got == [("a", day(0), 2, None), ("a", day(6), 1, 2), ("b", day(1), 1, None)]


def test_look_ahead(spark):
    df = frame(spark, [("a", 0, 0), ("a", 0, 5), ("a", 4, 4)])
    got = rows_of(intervals.look_ahead(df, ["p"], "s", "2008-12-31"))
    assert got == sorted([("a", day(0), day(3)), ("a", day(4), dt.date(2008, 12, 31))], key=repr)


def timeline(spark, rows, last):
    df = frame(spark, rows, ", kind string")
    out = intervals.coverage_timeline(df, ["p"], "kind", {"m": "M", "d": "D"}, "s", "e", day(last).isoformat())
    return sorted((r["p"], (r["PeriodStart"] - D0).days, (r["PeriodEnd"] - D0).days, r["M"], r["D"]) for r in out.collect())


def test_timeline_splits_and_drops_uncovered(spark):
    got = timeline(spark, [("a", 0, 20, "m"), ("a", 10, 30, "d"), ("a", 50, 100, "m")], 100)
    assert got == [("a", 0, 9, "Y", "N"), ("a", 10, 20, "Y", "Y"), ("a", 21, 30, "N", "Y"), ("a", 50, 100, "Y", "N")]


@pytest.mark.parametrize("seed", range(3))
def test_timeline_equals_pairwise_overlap(spark, seed):
    rnd = random.Random(seed)
    last = 60
    rows = []
    for _ in range(60):
        a = rnd.randrange(55)
        rows.append((rnd.choice("ab"), a, min(last, a + rnd.randrange(1, 15)), rnd.choice("md")))
    want = []
    for p in "ab":
        own = [r for r in rows if r[0] == p]
        cuts = sorted({r[1] for r in own} | {r[2] + 1 for r in own if r[2] != last})
        for i, c in enumerate(cuts):
            end = cuts[i + 1] - 1 if i + 1 < len(cuts) else last
            hit = {r[3] for r in own if end >= r[1] and r[2] >= c}
            if hit:
                want.append((p, c, end, "Y" if "m" in hit else "N", "Y" if "d" in hit else "N"))
    assert timeline(spark, rows, last) == sorted(want)


@pytest.mark.parametrize("path", ["small", "shuffled"])
def test_points_and_overlaps_equal_brute_force(spark, ws, path, request):
    if path == "shuffled":
        request.getfixturevalue("shuffled")
    rnd = random.Random(5)
    stays = []
    for i in range(80):
        a = rnd.randrange(100)
        stays.append(("hot" if i % 2 else rnd.choice("abc"), a, a + rnd.randrange(0, 20)))
    points = [("hot" if rnd.random() < 0.5 else rnd.choice("abz"), rnd.randrange(110)) for _ in range(120)]
    pts = spark.createDataFrame([(p, day(n)) for p, n in points], "p string, v date")
    got = intervals.count_inside(frame(spark, stays), pts, ["p"], "s", "e", "v", "n", ws)
    want = [(p, day(a), day(b), sum(q == p and a <= n <= b for q, n in points)) for p, a, b in stays]
    assert rows_of(got) == sorted(want, key=repr)

    others = [(p, n, n + rnd.randrange(0, 9)) for p, n in points]
    over = intervals.count_overlaps(frame(spark, stays), frame(spark, others), ["p"], ("s", "e"), ("s", "e"), "n", ws)
    want = [(p, day(a), day(b), sum(q == p and b >= c and d >= a for q, c, d in others)) for p, a, b in stays]
    assert rows_of(over) == sorted(want, key=repr)


@pytest.mark.parametrize("days", [1, 7, 64])
def test_joined_intervals_equal_all_pairs(spark, days):
    rng = random.Random(days)
    day = lambda: dt.date(2009, 1, 1) + dt.timedelta(rng.randint(-30, 60)) if rng.random() < 0.95 else None
    left = [(rng.choice(["p", "p", "p", "q", None]), i, day(), day()) for i in range(70)]
    right = [(rng.choice(["p", "q", "r", None]), i, day(), day()) for i in range(50)] + [("p", 99, dt.date(1950, 1, 1), dt.date(2050, 1, 1))]
    a = spark.createDataFrame(left, "person string, i int, a date, b date")
    b = spark.createDataFrame(right, "person string, j int, c date, d date")
    got = rows_of(intervals.interval_join(a, b, ["person"], ("a", "b"), ("c", "d"), days).select("i", "j"))
    whole = [[r for r in side if None not in r and r[2] <= r[3]] for side in (left, right)]
    assert got == sorted(((x[1], y[1]) for x in whole[0] for y in whole[1] if x[0] == y[0] and x[2] <= y[3] and y[2] <= x[3]), key=repr)
    got = rows_of(intervals.point_join(a.drop("b"), b, ["person"], "a", ("c", "d"), days).select("i", "j"))
    points = [x for x in left if x[0] is not None and x[2] is not None]
    assert got == sorted(((x[1], y[1]) for x in points for y in whole[1] if x[0] == y[0] and y[2] <= x[2] <= y[3]), key=repr)
    with pytest.raises(ValueError, match="on both sides: a, b, i"):
        intervals.interval_join(a, a, ["person"], ("a", "b"), ("a", "b"))


def test_a_hot_person_is_split_by_bins(spark, shuffled):
    days = "date_add(date'2009-01-01', cast(id % 700 as int))"
    left = spark.range(900).selectExpr("cast(0 as int) as person", "id as i", f"{days} as a", f"date_add({days}, 3) as b")
    right = spark.range(800).selectExpr("cast(0 as int) as person", "id as j", f"date_add({days}, 1) as c", f"date_add({days}, 2) as d")
    joined = intervals.interval_join(left, right, ["person"], ("a", "b"), ("c", "d"), 16)
    plain = left.join(right, "person").where("a <= d AND c <= b")
    assert joined.count() == plain.count() and sorted(joined.columns) == sorted(plain.columns)


@pytest.mark.parametrize("path", ["small", "shuffled"])
def test_totals_of_joined_intervals_equal_those_of_all_pairs(spark, path, request):
    if path == "shuffled":
        request.getfixturevalue("shuffled")
    rng = random.Random(3)
    when = lambda: dt.date(2009, 1, 1) + dt.timedelta(rng.randint(0, 60)) if rng.random() < 0.95 else None
    left = [(rng.choice(["p", "p", "q", None]), i // 2, when(), when()) for i in range(120)]
    right = [(rng.choice(["p", "q", "r", None]), rng.choice([None, 1, 2, 50]), when(), when()) for _ in range(60)]
    a = spark.createDataFrame(left + left[:9], "person string, i int, a date, b date")
    b = spark.createDataFrame(right + right[:9], "person string, j int, c date, d date")
    totals = {"n": ("count", None), "first": ("min", "c"), "total": ("sum", "j")}
    got = intervals.interval_join(a, b, ["person"], ("a", "b"), ("c", "d"), totals=totals)
    want = []
    for p, i, lo, hi in left + left[:9]:
        own = [r for r in right + right[:9] if p is not None and r[0] == p and None not in (lo, hi, r[2], r[3]) and lo <= hi and r[2] <= r[3] and lo <= r[3] and r[2] <= hi]
        if own:
            known = [r[1] for r in own if r[1] is not None]
            want.append((p, i, lo, hi, len(own), min(r[2] for r in own), sum(known) if known else None))
    assert rows_of(got) == sorted(want, key=repr)
    for wrong in (("min", "d"), ("sum", "c")):
        with pytest.raises(ValueError, match="without pairs: x"):
            intervals.interval_join(a, b, ["person"], ("a", "b"), ("c", "d"), totals={"x": wrong})


def test_a_hot_person_of_ten_billion_pairs_is_totalled(spark, tmp_path):
    from claimloom.catalog.queries import QUERIES

    orders = spark.range(100_000).selectExpr(
        "id * 120 as o_orderkey", "id * 3 as o_custkey", "'1-URGENT' as o_orderpriority", "timestamp'1998-01-01' as o_orderdate"
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    found = QUERIES["interval_join_hot"](spark, str(tmp_path))
    seen = found.groupBy("person", "n_pairs", "first", "graces").count().collect()
    assert [tuple(r) for r in seen] == [(0, 100_000, dt.date(1998, 1, 1), 0, 100_000)]
