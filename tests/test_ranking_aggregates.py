"""Top-per-group, medians and counts, against brute force on random frames."""

import math
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from postflow.operators.aggregates import count_by, exact_quantile_by, median_by
from postflow.operators.ranking import top_overall, top_per_group

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_st = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]),
              st.one_of(st.none(), st.integers(min_value=-200_000, max_value=200_000))),
    min_size=0, max_size=60)


def brute_top(rows, descending=True):
    """rank() = 1 rows: NULLs sort last descending, first ascending."""
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    best = {}
    for g, vs in groups.items():
        vals = [v for v in vs if v is not None]
        if descending:
            best[g] = max(vals) if vals else None
        else:
            best[g] = None if len(vals) < len(vs) else min(vals)
    return sorted([(g, v) for g, v in rows if v == best[g]], key=repr)


@SETTINGS
@given(rows=rows_st)
def test_top_per_group_matches_rank_semantics(spark, rows):
    df = spark.createDataFrame(rows, "g string, v int")
    for descending in (True, False):
        want = brute_top(rows, descending)
        for strategy in ("window", "join"):
            got = top_per_group(df, ["g"], "v", strategy=strategy, descending=descending).collect()
            assert sorted(map(tuple, got), key=repr) == want, (strategy, descending)


def test_top_per_group_all_null_group_keeps_all(spark):
    df = spark.createDataFrame([("x", "p1", None), ("x", "p2", None), ("y", "p3", 5), ("y", "p4", None)],
                               "country string, poster string, fc int")
    got = sorted(tuple(r) for r in top_per_group(df, ["country"], "fc").collect())
    assert got == [("x", "p1", None), ("x", "p2", None), ("y", "p3", 5)]


def test_top_k_window(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 3), ("a", 2)], "g string, v int")
    assert sorted(r.v for r in top_per_group(df, ["g"], "v", k=2, ties=False).collect()) == [3, 3]
    assert sorted(r.v for r in top_per_group(df, ["g"], "v", k=2).collect()) == [3, 3]
    assert sorted(r.v for r in top_per_group(df, ["g"], "v", k=3).collect()) == [2, 3, 3]


def test_top_overall_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 9), ("a", 9), ("c", None), ("d", 1)], "country string, fc int")
    assert [tuple(r) for r in top_overall(df, "fc", ["country"]).collect()] == [("a", 9)]


def brute_lower_quantile(rows, q):
    groups = defaultdict(list)
    for g, v in rows:
        groups[g].append(v)
    out = {}
    for g, vs in groups.items():
        vals = sorted(v for v in vs if v is not None)
        out[g] = vals[max(1, math.ceil(q * len(vals))) - 1] if vals else None
    return out


@SETTINGS
@given(rows=rows_st, q=st.sampled_from([0.5, 0.1, 0.9, 1.0]))
def test_exact_quantile_matches_brute_force(spark, rows, q):
    df = spark.createDataFrame(rows, "g string, v int")
    got = {r.g: r.m for r in exact_quantile_by(df, ["g"], "v", q, "m").collect()}
    assert got == brute_lower_quantile(rows, q)


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from([1, 2]),
                               st.one_of(st.none(), st.integers(min_value=-(2 ** 40), max_value=2 ** 40))),
                     max_size=40))
def test_exact_quantile_long_values(spark, rows):
    df = spark.createDataFrame(rows, "g int, v bigint")
    got = {r.g: r.m for r in exact_quantile_by(df, ["g"], "v", 0.5, "m").collect()}
    assert got == brute_lower_quantile(rows, 0.5)


def test_exact_quantile_rejects_non_integral(spark):
    df = spark.createDataFrame([("a", 1.0)], "g string, v double")
    with pytest.raises(TypeError):
        exact_quantile_by(df, ["g"], "v", 0.5)


def test_approx_median_rank_error_bound(spark):
    n, accuracy = 20000, 100
    df = spark.range(n).selectExpr("'g' AS g", "CAST(id * 7 % 20000 AS INT) AS v")
    got = median_by(df, ["g"], "v", "m", accuracy=accuracy).collect()[0].m
    # the value's rank may be off by at most n / accuracy from the exact lower median
    exact_rank = math.ceil(n / 2)
    assert abs((got + 1) - exact_rank) <= n / accuracy
    assert median_by(df, ["g"], "v", "m", exact=True).collect()[0].m == exact_rank - 1


def test_count_by_null_is_a_group(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "g string")
    got = {r.g: r.n for r in count_by(df, ["g"], "n").collect()}
    assert got == {"a": 1, None: 2}


join_rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 3)), max_size=40)


@SETTINGS
@given(left=join_rows, right=join_rows, hot=st.integers(0, 3))
def test_salted_left_join_is_exact(spark, left, right, hot):
    from postflow.operators.joins import left_join
    lf = spark.createDataFrame(left, "k int, a int")
    rf = spark.createDataFrame(right, "k int, b int")
    plain = sorted(map(tuple, left_join(lf, rf, "k").collect()), key=repr)
    salted = left_join(lf, rf, "k", skew="salt", hot_rows=hot, buckets=3)
    assert salted.columns == ["k", "a", "b"]
    assert sorted(map(tuple, salted.collect()), key=repr) == plain


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 30), st.sampled_from(["p", "q", "r", None]),
                               st.one_of(st.none(), st.integers(0, 9)), st.sampled_from(["X", "Y", None])),
                     min_size=1, max_size=30))
def test_country_with_top_poster_equals_ranked_version(spark, rows):
    from postflow.plans import questions as Q
    posts = spark.createDataFrame([(i, p, f) for i, p, f, _ in rows],
                                  "ind int, poster_name string, follower_count int").dropDuplicates(["ind"])
    geo = spark.createDataFrame([(i, c) for i, _, _, c in rows], "ind int, country string") \
        .dropDuplicates(["ind"])
    direct = [tuple(r) for r in Q.country_with_top_poster(posts, geo).collect()]
    ranked = top_overall(Q.top_poster_by_country(posts, geo), "follower_count", ["country"]) \
        .select("country", "follower_count")
    assert direct == [tuple(r) for r in ranked.collect()]


def test_sorted_outputs(spark):
    """Mixed-direction and group-key sorts at the end of a question."""
    from postflow.plans import questions as Q
    posts = spark.createDataFrame([(1, "a", 5), (2, "a", 7), (3, "b", 1), (4, "b", 9), (5, "a", 3)],
                                  "ind int, category string, follower_count int")
    geo = spark.createDataFrame([(1, "Y"), (2, "Y"), (3, "X"), (5, "Y")], "ind int, country string")
    rows = [tuple(r) for r in Q.category_counts_by_country(posts, geo, sorted_=True).collect()]
    assert rows == [(None, "b", 1), ("X", "b", 1), ("Y", "a", 3)]
    users = spark.createDataFrame([(1, 20, None), (2, 40, None), (3, 30, None), (4, 60, None)],
                                  "ind int, age int, date_joined timestamp")
    med = [tuple(r) for r in Q.median_followers_by_age(posts, users, sorted_=True).collect()]
    assert [m[0] for m in med] == ["18-24", "25-35", "36-50", "50+"]
    assert med == [("18-24", 5), ("25-35", 1), ("36-50", 7), ("50+", 3)]


def test_exact_quantile_without_groups(spark):
    df = spark.range(1, 1002).selectExpr("CAST((id * 7919) % 100003 AS INT) AS v")
    vals = sorted(r.v for r in df.collect())
    got = exact_quantile_by(df, [], "v", 0.5, "m").collect()
    assert len(got) == 1 and got[0].m == vals[math.ceil(len(vals) / 2) - 1]


def test_top_without_groups_keeps_ties(spark):
    df = spark.createDataFrame([(1, 5), (2, 9), (3, 9), (4, None)], "id int, v int")
    assert sorted(r.id for r in top_per_group(df, [], "v").collect()) == [2, 3]
    with pytest.raises(ValueError):
        top_per_group(df, [], "v", k=2, ties=False)


@pytest.mark.parametrize("dtype", ["timestamp", "timestamp_ntz", "date"])
def test_year_between_boundaries(spark, dtype):
    from postflow.operators.aggregates import year_between
    texts = ["2014-12-31 23:59:59", "2015-01-01 00:00:00", "2020-12-31 23:59:59", "2021-01-01 00:00:00", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string").selectExpr(f"CAST(s AS {dtype}) AS ts")
    assert sorted(r.post_year for r in year_between(df, "ts", 2015, 2020).collect()) == [2015, 2020]
