"""The driver-side tail probabilities agree with the commons-math3
distributions that ship with Spark."""

import pytest

from lendscope.functions import distributions as D


@pytest.mark.parametrize("t,df", [(0.3, 5.0), (2.1, 12.5), (-4.0, 30.0), (1.0, 1.0), (8.0, 200.0)])
def test_t(spark, t, df):
    jvm = spark.sparkContext._jvm.org.apache.commons.math3.distribution
    ref = 2 * jvm.TDistribution(df).cumulativeProbability(-abs(t))
    assert D.t_two_sided(t, df) == pytest.approx(ref, rel=1e-9, abs=1e-15)


@pytest.mark.parametrize("f,d1,d2", [(0.5, 3.0, 20.0), (2.7, 4.0, 9000.0), (15.0, 1.0, 40.0)])
def test_f(spark, f, d1, d2):
    jvm = spark.sparkContext._jvm.org.apache.commons.math3.distribution
    ref = 1 - jvm.FDistribution(d1, d2).cumulativeProbability(f)
    assert D.f_upper(f, d1, d2) == pytest.approx(ref, rel=1e-8, abs=1e-14)


@pytest.mark.parametrize("x,k", [(0.2, 1.0), (3.84, 1.0), (12.0, 6.0), (40.0, 4.0), (99.0, 120.0)])
def test_chi2(spark, x, k):
    jvm = spark.sparkContext._jvm.org.apache.commons.math3.distribution
    ref = 1 - jvm.ChiSquaredDistribution(k).cumulativeProbability(x)
    assert D.chi2_upper(x, k) == pytest.approx(ref, rel=1e-8, abs=1e-14)
