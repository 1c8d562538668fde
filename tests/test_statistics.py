"""Quantiles, bootstrap and sign test against numpy and exact sums."""

from fractions import Fraction
from math import comb, isnan

import numpy as np
import pytest

from millrace.operators import quantiles as Q
from millrace.operators import replies as R
from millrace.operators import stats as S
from pyspark.sql import functions as F


@pytest.mark.parametrize("bins", [16, 256])
def test_quantiles_match_numpy(spark, monkeypatch, bins):
    monkeypatch.setattr(Q, "BINS", bins)
    rng = np.random.default_rng(3)
    values = {"a": rng.normal(size=300), "b": np.repeat(7.5, 50), "c": np.array([1.0]), "d": np.concatenate([np.zeros(90), rng.normal(size=10) * 1e300, [-1.7e308, 1.7e308]]), None: rng.integers(0, 5, 80).astype(float), "e": np.array([5e-324, 0.0, 1e-300, 3.0])}
    rows = [(g, float(v)) for g, vs in values.items() for v in vs] + [("n", None), ("a", None), ("z", float("nan")), ("z", 1.0)]
    shares = {"low": 0.0, "q": 0.25, "m": 0.5, "p": 0.95, "top": 1.0}
    got = {r.g: r for r in Q.quantiles(spark.createDataFrame(rows, "g string, v double").repartition(4), ["g"], "v", shares).collect()}
    for g, vs in values.items():
        assert got[g].n == len(vs)
        for name, share in shares.items():
            lo, hi = np.quantile(vs, share, method="lower"), np.quantile(vs, share, method="higher")
            at = share * (len(vs) - 1)
            want = lo if lo == hi else (np.ceil(at) - at) * lo + (at - np.floor(at)) * hi
            assert got[g][name] == pytest.approx(want, rel=1e-12, abs=0), (g, name)
    assert (got["n"].n, got["n"].m) == (0, None) and got["z"].low == 1.0 and isnan(got["z"].top)


def test_quantiles_without_groups_and_rows(spark):
    df = spark.createDataFrame([(x,) for x in (3.0, 1.0, 2.0)], "v double")
    assert tuple(Q.quantiles(df, [], "v", {"m": 0.5}).first()) == (3, 2.0)
    assert tuple(Q.quantiles(df.limit(0), [], "v", {"m": 0.5}).first()) == (0, None)
    assert Q.quantiles(spark.createDataFrame([], "g string, v double"), ["g"], "v", {"m": 0.5}).collect() == []


def test_bootstrap_interval_and_cost(spark):
    rng = np.random.default_rng(1)
    d = rng.choice([-1.0, 0.0, 1.0, 2.5], 2_000, p=[0.2, 0.5, 0.2, 0.1])
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(d)] + [(-1, None), (-2, float("nan"))], "id long, difference double").repartition(7)
    got = R.bootstrap(df).first()
    plain = np.quantile(np.random.default_rng(5).multinomial(len(d), [np.mean(d == v) for v in np.unique(d)], 10_000) @ np.unique(d) / len(d), [0.025, 0.975])
    half = (plain[1] - plain[0]) / 2
    assert got["mean"] == pytest.approx(d.mean()) and abs(got["low"] - plain[0]) < half / 20 and abs(got["high"] - plain[1]) < half / 20
    again = R.bootstrap(df.repartition(2)).first()
    assert tuple(again) == pytest.approx(tuple(got))
    many = spark.createDataFrame([(i, float(x)) for i, x in enumerate(rng.normal(size=3_000))], "id long, difference double")
    wide = R.bootstrap(many, 2_000).first()
    assert wide["low"] < wide["mean"] < wide["high"] and abs((wide["high"] - wide["low"]) / 2 - 1.96 / np.sqrt(3_000)) < 0.005
    assert tuple(R.bootstrap(df.limit(0)).first()) == (None, None, None)


def test_sign_test_is_exact(spark):
    cases = [(0, 0), (1, 5), (3, 3), (0, 6), (40, 70), (480, 520), (900, 1300), (20, 2000)]
    got = {(r.a, r.b): r.p for r in spark.createDataFrame(cases, "a long, b long").select("a", "b", S.sign_test(F.col("a"), F.col("b")).alias("p")).collect()}
    for a, b in cases:
        n, k = a + b, min(a, b)
        want = float(min(Fraction(1), Fraction(2 * sum(comb(n, i) for i in range(k + 1)), 2**n))) if n else 1.0
        assert got[a, b] == pytest.approx(want, rel=1e-9, abs=1e-300), (a, b)


def test_win_rate(spark):
    df = spark.createDataFrame([(2, 1)] * 5 + [(1, 2)] + [(1, 1)] * 2 + [(None, 1)], "one int, other int")
    r = R.win_rate(df).first()
    assert (r.wins, r.losses, r.ties, r.win_rate) == (5, 1, 2, 0.75) and r.p == pytest.approx(0.21875)
    assert R.win_rate(df.limit(0)).first().win_rate is None
