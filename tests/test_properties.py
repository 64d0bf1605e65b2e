"""Property tests: random inputs against plain-Python definitions."""

import bisect

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tabfold.functions import columns as C
from tabfold.operators import metrics as M
from tabfold.operators.quantiles import exact_medians
from test_folds_metrics import brute_kappa

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
finite = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)


@SETTINGS
@given(xs=st.lists(st.one_of(st.none(), finite), min_size=1, max_size=40),
       cuts=st.lists(st.integers(-100, 100), min_size=1, max_size=4, unique=True), right=st.booleans())
def test_ordinal_bin_matches_bisect(spark, xs, cuts, right):
    cuts = sorted(float(c) for c in cuts)
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "id int, x double")
    got = {r.id: r.b for r in df.select("id", C.ordinal_bin("x", cuts, right=right).alias("b")).collect()}
    for i, x in enumerate(xs):
        want = None if x is None else (bisect.bisect_left(cuts, x) if right else bisect.bisect_right(cuts, x))
        assert got[i] == want


@SETTINGS
@given(pairs=st.lists(st.tuples(st.integers(0, 4), st.integers(0, 4)), min_size=2, max_size=60))
def test_qwk_matches_definition(spark, pairs):
    y, p = [a for a, _ in pairs], [b for _, b in pairs]
    df = spark.createDataFrame(pairs, "y int, p int")
    got = M.qwk(df, "y", "p").first()[0]
    with np.errstate(all="ignore"):
        want = brute_kappa(y, p, True)
    if want != want or got is None:          # undefined (no disagreement possible)
        assert got is None or got != got or want != want
    else:
        assert got == pytest.approx(want, abs=1e-9)


@SETTINGS
@given(xs=st.lists(st.one_of(st.none(), st.integers(-50, 50).map(float), finite), min_size=1, max_size=80),
       band=st.integers(1, 10))
def test_exact_median_matches_numpy(spark, xs, band):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = exact_medians(df, ["x"], max_band=band).collect()
    vals = [x for x in xs if x is not None]
    if not vals:
        assert got == []
    else:
        assert got[0]["value"] == pytest.approx(float(np.median(vals)), rel=1e-12, abs=1e-9)
