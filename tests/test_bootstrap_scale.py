"""Bootstrap draws: digests of many texts at once, exact sums of wide amounts, no row per replicate in the plan."""

import hashlib
import random
from decimal import Decimal

import numpy as np
import pyarrow as pa

from valuescope.functions import digests
from valuescope.operators import metrics


def test_md5_heads_are_those_of_hashlib(monkeypatch):
    monkeypatch.setattr(digests, "TOGETHER", 300)  # several blocks of prefixes
    rng = random.Random(3)
    tails = np.array([bytes(rng.choices(b"0123456789.|-", k=rng.randint(0, 130))) for _ in range(120)])
    prefixes = [b"", *(f"42|{rep}|".encode() for rep in (1, 2, 9, 10, 57, 99, 100, 500)), b"x" * 70]
    got = np.concatenate(list(digests.md5_heads(prefixes, tails)))
    assert got.tolist() == [[int(hashlib.md5(p + t).hexdigest()[:8], 16) for t in tails] for p in prefixes]


def test_decimals_as_integers():
    values = [Decimal("0"), Decimal("-0.0000000001"), Decimal("12345678901234567890.0123456789"), None, Decimal("-99999999999999999999.9999999999"), Decimal("7.25")]
    parts = metrics._integer_parts(pa.array(values, pa.decimal128(30, 10))[1:])
    got = [sum(int(p[i]) << (32 * k) for k, p in enumerate(parts)) for i in range(5)]
    assert got == [-1, 123456789012345678900123456789, 0, -999999999999999999999999999999, 72500000000]


def test_bootstrap_makes_no_row_per_replicate(spark):
    rows = [(i, i % 2 + 1, 0.0, float(i % 7) * 1.5) for i in range(60)]
    df = spark.createDataFrame(rows, "customer_id long, decile int, _s double, _y double")
    ci = metrics.bootstrap_decile_ci(df, n_boot=30, seed=5)
    plan = ci._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "md5(" not in plan
    assert {r["decile"] for r in ci.collect()} == {1, 2}
    assert ci.exceptAll(metrics.bootstrap_decile_ci(df.repartition(5), n_boot=30, seed=5)).isEmpty()  # however rows are dealt
    assert metrics.bootstrap_decile_ci(df.limit(0), n_boot=30, seed=5).isEmpty()
