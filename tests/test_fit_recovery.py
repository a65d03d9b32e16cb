"""BG/NBD and Gamma-Gamma fits recover known parameters from data simulated in the test."""

import numpy as np

from valuescope.operators import btyd, spend


def _simulate_bgnbd(n, r, alpha, a, b, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        T = float(rng.integers(60, 400))
        lam = rng.gamma(r, 1.0 / alpha)
        p = rng.beta(a, b)
        t, x, tx = 0.0, 0, 0.0
        while True:
            t += rng.exponential(1.0 / lam) if lam > 0 else np.inf
            if t > T:
                break
            x += 1
            tx = t
            if rng.random() < p:
                break
        rows.append((i, float(x), float(np.floor(tx)), T))
    return rows


def test_bgnbd_recovery(spark):
    true = dict(r=0.6, alpha=12.0, a=0.9, b=3.0)
    rows = _simulate_bgnbd(4000, **true)
    df = spark.createDataFrame(rows, "customer_id long, frequency_cal double, recency_cal double, T_cal double")
    fit, info = btyd.fit_bgnbd(df, penalizer=0.0)
    assert info["converged"]
    assert abs(fit.r - true["r"]) / true["r"] < 0.25
    assert abs(fit.alpha - true["alpha"]) / true["alpha"] < 0.3
    # the dropout pair is weakly identified on short windows: check the mean dropout rate a/(a+b)
    assert abs(fit.a / (fit.a + fit.b) - 0.9 / 3.9) < 0.08


def test_bgnbd_standard_errors_cover_the_truth(spark):
    true = dict(r=0.6, alpha=12.0, a=0.9, b=3.0)
    df = spark.createDataFrame(_simulate_bgnbd(4000, **true, seed=8), "customer_id long, frequency_cal double, recency_cal double, T_cal double")
    fit, info = btyd.fit_bgnbd(df, penalizer=0.0)
    for name, value in true.items():
        assert abs(getattr(fit, name) - value) < 4 * info["standard_errors"][name]
    assert info["iterations"] <= 30


def test_bgnbd_derivatives_equal_differences(spark):
    df = spark.createDataFrame(_simulate_bgnbd(200, 0.6, 12.0, 0.9, 3.0), "customer_id long, frequency_cal double, recency_cal double, T_cal double")
    stats = btyd.sufficient_stats(df)
    tail = btyd._tail_counts(stats)

    def at(p):
        value, g, H, _ = btyd.loglik_with_derivatives(stats, p, 0.1)
        dg, dH = btyd._gamma_derivatives(tail, p[0], p[2], p[3])
        return value + btyd._gamma_part(tail, p[0], p[2], p[3]), g + dg, H + dH

    point = np.array([0.5, 2.0, 0.7, 2.5])
    _, g, H = at(point)
    for i in range(4):
        h = np.zeros(4)
        h[i] = 1e-5
        up, down = at(point + h), at(point - h)
        assert abs((up[0] - down[0]) / 2e-5 - g[i]) < 1e-4 * max(1, abs(g[i]))
        assert np.allclose((up[1] - down[1]) / 2e-5, H[i], rtol=1e-4, atol=1e-3)


def test_gamma_gamma_recovery(spark):
    p, q, v = 4.0, 5.0, 20.0
    rng = np.random.default_rng(5)
    rows = []
    for i in range(6000):
        x = int(rng.integers(2, 12))
        nu = rng.gamma(q, 1.0 / v)  # a customer's rate
        rows.append((i, x, float(rng.gamma(p * x, 1.0 / (nu * x)))))
    df = spark.createDataFrame([*rows, (-1, 1, 1e6)], "customer_id long, frequency long, monetary_value double")  # one invoice: no part in it
    fit, info = spend.fit_gamma_gamma_summary(df)
    assert info["converged"] and not info["gg_mean_undefined"]
    for name, value in (("p", p), ("q", q), ("v", v)):
        assert abs(getattr(fit, name) - value) < 4 * info["standard_errors"][name]
        assert abs(getattr(fit, name) - value) / value < 0.2


def test_expected_purchases_by_distinct_pairs_equal_the_column(spark):
    rows = [(i, float(i % 4), float((i % 4 > 0) * (i % 37)), float(40 + i % 23)) for i in range(500)] + [(900, None, 0.0, 50.0)]
    df = spark.createDataFrame(rows, "customer_id long, frequency_cal double, recency_cal double, T_cal double")
    for a in (0.793, 1.0):
        params = btyd.CDNOW_BGNBD | {"a": a}
        want = {r[0]: r[1] for r in df.select("customer_id", btyd.expected_purchases(params, 90.0)).collect()}
        for most in (10, 1_000_000):
            got = {r["customer_id"]: r["e"] for r in btyd.with_expected_purchases(df, params, 90.0, "e", max_factors=most).collect()}
            assert got == want and got[900] is None
