"""Benchmark shards: rows do not depend on how items are dealt out."""

import numpy as np

from valuescope.llm import decontaminate


def test_one_shard_and_many_give_equal_rows(spark, monkeypatch):
    rng = np.random.default_rng(4)
    # word frequencies and lengths differ much between items, and leaks are partly edited
    items = [(k, " ".join(f"w{int(x)}" for x in rng.zipf(1.3, int(rng.integers(6, 40))) % 300)) for k in range(60)]
    docs = []
    for k, t in items:
        words = t.split()
        for x in rng.integers(0, len(words), int(rng.integers(0, 1 + len(words) // 3))):
            words[x] = "edited"
        docs.append((k, " ".join(["before"] * int(rng.integers(0, 50)) + words + ["after"] * 9)))
    docs, items = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    one = sorted(tuple(r) for r in decontaminate.leaks(docs, items).collect())
    monkeypatch.setattr(decontaminate, "SHARD_ITEMS", 7)
    assert len(list(decontaminate.load_shards(items))) > 1
    many = sorted(tuple(r) for r in decontaminate.leaks(docs, items).collect())
    assert one == many and one and min(r[2] for r in one) < 1
