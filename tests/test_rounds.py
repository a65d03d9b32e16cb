"""Greedy selection with unequal costs, in few rounds; bootstrap weights by counts; seeded samples."""

import hashlib
import math
import random
from decimal import Decimal


from valuescope.operators import metrics, policy, sampling


def _sequential(rows, budget):
    left, taken = Decimal(str(budget)), set()
    for c, gain, cost in sorted(rows, key=lambda r: (-r[1] / r[2], r[0])):
        if Decimal(str(cost)) <= left:
            left -= Decimal(str(cost))
            taken.add(c)
    return taken


def _rounds(spark, rows, budget, monkeypatch):
    calls = []
    plain = policy.global_order
    monkeypatch.setattr(policy, "global_order", lambda *a, **k: calls.append(1) or plain(*a, **k))
    df = spark.createDataFrame(rows, "customer_id long, net_gain double, cost double")
    got = {r["customer_id"] for r in policy.take_while_affordable(df, budget).collect()}
    return got, len(calls) - 1


def test_alternating_costs_need_few_rounds(spark, monkeypatch):
    # the best gain per cost first: 1, 10000, 1, 9999, ...: each dear one misses by a little
    rows = []
    for i in range(5000):
        rows.append((2 * i, 1.0 * (20000 - 2 * i), 1.0))
        rows.append((2 * i + 1, float(10000 - i) * (20000 - 2 * i - 1), float(10000 - i)))
    got, rounds = _rounds(spark, rows, 10000.0, monkeypatch)
    assert got == _sequential(rows, 10000.0)
    assert rounds <= 40


def test_greedy_equals_the_sequential_rule(spark, monkeypatch):
    rng = random.Random(2)
    for budget in (0.0, 0.5, 7.3, 40.0, 1e6):
        rows = [(i, round(rng.uniform(0.1, 9), 3), rng.choice([0.25, 0.5, 1.0, 3.7, 3.7, 12.1])) for i in range(60)]
        got, _ = _rounds(spark, rows, budget, monkeypatch)
        assert got == _sequential(rows, budget)
        monkeypatch.undo()


def _poisson(n, u):
    p = c = math.exp(-n)
    k = 0
    while c <= u and k < 2000:
        k += 1
        p = p * n / k
        c += p
    return k


def test_bootstrap_by_counts_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(metrics, "DRAW_SIZE", 4)
    actual = [0.0] * 11 + [1.5, 1.5, 2.25, 8.0] + [0.0] * 3 + [4.0, 4.0, 9.0]
    df = spark.createDataFrame([(i, i // 15 + 1, 0.0, y) for i, y in enumerate(actual)], "customer_id long, decile int, _s double, _y double")
    got = {r["decile"]: (r["ci_lower"], r["ci_upper"]) for r in metrics.bootstrap_decile_ci(df, n_boot=40, seed=9).collect()}
    for decile in (1, 2):
        counts = {}
        for i, y in enumerate(actual):
            if i // 15 + 1 == decile:
                counts[y] = counts.get(y, 0) + 1
        means = []
        for rep in range(1, 41):
            total = weight = 0.0
            for y, n in counts.items():
                for part in range((n - 1) // 4 + 1):
                    text = f"9|{rep}|{decile}|{part}|{y:.10f}"
                    u = int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / 4294967296.0
                    w = _poisson(min(4, n - 4 * part), u)
                    total, weight = total + w * y, weight + w
            means.append(total / weight if weight else 0.0)
        means.sort()

        def at(q, means=means):
            x = q * (len(means) - 1)
            lo = math.floor(x)
            return means[lo] + (means[min(lo + 1, len(means) - 1)] - means[lo]) * (x - lo)

        alpha = (1 - 0.95) / 2
        assert abs(got[decile][0] - at(alpha)) < 1e-6 and abs(got[decile][1] - at(1 - alpha)) < 1e-6


def test_poisson_weights_have_mean_and_variance_n(spark):
    table = metrics.poisson_table(spark.createDataFrame([(1,), (7,), (512,)], "n long"))
    for r in table.collect():
        steps = [b - a for a, b in zip([0.0, *r["cdf"]], r["cdf"])]
        mean = sum(k * p for k, p in enumerate(steps))
        assert r["cdf"][-1] > 1 - 2**-33
        assert abs(mean - r["n"]) < 1e-6 * r["n"]
        assert abs(sum(k * k * p for k, p in enumerate(steps)) - mean**2 - r["n"]) < 1e-4 * r["n"]


def test_samples_are_the_least_digests_of_each_stratum(spark):
    rows = [(i if i % 13 else None, ["a", "b", None][i % 3]) for i in range(200)]
    df = spark.createDataFrame(rows, "customer_id long, s string")

    def u(c):
        return int(hashlib.md5(f"5|{'' if c is None else c}".encode()).hexdigest()[:8], 16)

    got = [tuple(r) for r in sampling.bottom_k(df, 7, 5, strata=["s"]).collect()]
    for s in ("a", "b", None):
        want = sorted((u(c), c is not None, c or 0) for c, t in rows if t == s)[:7]
        assert sorted((u(c), c is not None, c or 0) for c, t in got if t == s) == want
    assert sampling.bottom_k(df, 7, 5, strata=["s"]).exceptAll(sampling.bottom_k(df.repartition(11), 7, 5, strata=["s"])).isEmpty()
    assert sampling.bottom_k(df, 1000, 5).count() == 200
    assert sampling.bottom_k(df.limit(0), 7, 5).isEmpty() and sampling.bottom_k(df, 0, 5).isEmpty()
