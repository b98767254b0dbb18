"""Long cross-correlation against numpy and the join over shifted places."""

import numpy as np
import pytest

from wakeline.operators import correlation, signals
from wakeline.plans import fixtures as fx

SF = "/root/testdata/sf0.001"


def series(spark, name, values):
    return spark.createDataFrame([(name, i, float(x)) for i, x in enumerate(values)], "key string, idx long, x double")


@pytest.mark.parametrize("n_front,n_rear,most,fft", [(700, 900, 130, 512), (50, 300, 299, 1024), (1, 1, 3, None), (300, 40, 0, 64)])
def test_equals_numpy(spark, n_front, n_rear, most, fft):
    rng = np.random.default_rng(n_front)
    a, b = rng.normal(size=n_front), rng.normal(size=n_rear)
    got = {r.lag: r for r in correlation.cross_correlation(series(spark, "k", a), series(spark, "k", b), most, fft=fft).collect()}
    assert sorted(got) == list(range(-most, most + 1))
    full = np.correlate(b, a, "full")  # lag zero at n_front - 1
    for lag, r in got.items():
        at = lag + n_front - 1
        assert r.total == pytest.approx(full[at] if 0 <= at < len(full) else 0.0, abs=1e-9)
        assert r.overlap == max(1, min(n_front, n_rear - max(lag, 0), n_front + min(lag, 0)))


def test_equals_the_join_on_few_lags(spark):
    a, b = fx.hourly(spark, SF, "click").where("idx >= 0"), fx.hourly(spark, SF, "view").where("idx >= 0")
    join = {r.lag: r.score for r in signals.xcorr(a, b, 24).collect()}
    as_key = lambda df: df.selectExpr("'k' key", "idx", "x")
    fft = {-r.lag: r.score for r in correlation.cross_correlation(as_key(a), as_key(b), 24, fft=128).collect()}  # there the second series is moved
    assert fft.keys() == join.keys() and all(fft[k] == pytest.approx(join[k], abs=1e-9) for k in fft)


def test_sign_polarity_and_second_peak(spark):
    front = np.zeros(2000)
    front[500:510] = 1
    rear = -np.roll(front, 200)
    rear[1500:1510] = -0.5
    s = correlation.cross_correlation(series(spark, "k", front), series(spark, "k", rear), 1200)
    r = correlation.best_offset(s, 20.0, absolute=True).first()
    assert (r.offset_seconds, r.polarity) == (10.0, -1) and r.score_ratio > 1
    assert correlation.best_offset(s, 20.0).first().polarity == 1  # upright: the best of what is not negative
    one = correlation.cross_correlation(series(spark, "k", [1.0]), series(spark, "k", [1.0]), 2)
    assert tuple(correlation.best_offset(one, 1.0).first()) == ("k", 0.0, 1.0, 1, None)


def test_missing_keys_and_bad_lags(spark):
    a, b = series(spark, "a", [1, 2]), series(spark, "b", [1, 2])
    assert correlation.cross_correlation(a, b, 2).count() == 0
    with pytest.raises(ValueError, match="negative"):
        correlation.cross_correlation(a, b, -1)
    with pytest.raises(ValueError, match="longer"):
        correlation.cross_correlation(a, b, 50, fft=64)
