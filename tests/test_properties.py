"""Property tests of the exact operators against plain-Python definitions."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tripmart.functions.columns import exact_mean
from tripmart.operators.impute import upper_medians
from tripmart.operators.percentiles import grouped_percentile_cont

CENTS = st.integers(min_value=0, max_value=5000).map(lambda c: Decimal(c) / 100)
ROWS = st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b"]), CENTS),
                min_size=1, max_size=120)
SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _cont(values, p):
    v = sorted(values)
    h = Decimal(str(p)) * (len(v) - 1)
    lo = int(h)
    hi = min(lo + 1, len(v) - 1)
    return v[lo] + (h - lo) * (v[hi] - v[lo])


@SETTINGS
@given(rows=ROWS, parts=st.integers(min_value=1, max_value=6))
def test_grouped_percentile_cont(spark, rows, parts):
    df = spark.createDataFrame(rows, "g string, v decimal(10,2)")
    got = {r.g: (r.p50, r.p90) for r in
           grouped_percentile_cont(df, ["g"], "v", {"p50": 0.5, "p90": 0.9}, parts).collect()}
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, values in groups.items():
        assert got[g][0] == _cont(values, 0.5) and got[g][1] == _cont(values, 0.9), g


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=80))
def test_upper_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    present = sorted(v for v in values if v is not None)
    want = present[len(present) // 2] if present else None
    assert upper_medians(df, ["x"]) == {"x": want}


@SETTINGS
@given(values=st.lists(CENTS, min_size=1, max_size=60))
def test_exact_mean_rounds_half_up(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x decimal(10,2)")
    got = df.agg(exact_mean("x").alias("m")).first().m
    want = (sum(values) / len(values)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    assert got == want
