"""What the driver holds is bounded: bits instead of ids, columns instead of rows, no rounds over links that are stars."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from valuescope.llm import jaccard, langid


def roots(edges):
    """Least node of each node's component."""
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    return {x: r for x, r in root.items() if any(x in e and e[0] != e[1] for e in edges)}


@pytest.mark.parametrize(
    "edges, writes",
    [
        ([], 1),
        ([(1, 2), (3, 1), (2, 1), (9, -4), (5, 5)], 1),  # stars, one of them told twice, and a loop
        ([(k, k + 1) for k in range(20)], None),
        ([(9, 1), (9, 2), (2, 7)], None),
        ([tuple(e) for e in np.random.default_rng(3).integers(-30, 30, (35, 2)).tolist()], None),
    ],
)
def test_components_end_with_stars(spark, monkeypatch, edges, writes):
    names, write = [], jaccard.materialise
    monkeypatch.setattr(jaccard, "materialise", lambda df, name: (names.append(name), write(df, name))[1])
    got = jaccard.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r["node"]: r["root"] for r in got} == roots(edges) and len(got) == len(roots(edges))
    assert writes is None or len(names) == writes


def test_picked_parts_are_bits(spark):
    part = F.pmod(F.xxhash64("id"), F.lit(jaccard.PICKED_PARTS))
    picked = spark.range(200_000).select(part.alias("part"))
    bits = jaccard.part_bits(picked, "part")
    assert bits.count() <= jaccard.PICKED_PARTS // 64
    got = {64 * r["word"] + k for r in bits.collect() for k in range(64) if r["bits"] >> k & 1}
    assert got == {r[0] for r in picked.collect()}


def test_texts_of_broadcasts_bits_only(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    classes = docs.select(F.col("doc_id").alias("class"), F.col("doc_id").alias("least_id"))
    near = jaccard.texts_of(classes.filter("class % 3 = 0").select("class"), classes, docs, "doc_id", "text")
    got = [r[0] for r in near.collect()]
    assert {*range(0, 3000, 3)} <= {*got} and len(got) == len({*got}) < 1020
    assert "bit_or" in near._jdf.queryExecution().toString()


def test_frequent_shingles_are_chosen_before_they_come_to_the_driver(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 3)
    rows = [(5, 20), (-5, 30), (6, 15), (7, 16), (8, 17), (5, 1), (None, None), (9, 8), (9, 9)]
    token, times = jaccard.frequent_shingles(spark.createDataFrame(rows, "token bigint, times bigint"))
    assert token.tolist() == [5, 8, 2**64 - 5] and times.tolist() == [21, 17, 30]
    none = jaccard.frequent_shingles(spark.createDataFrame([], "token bigint, times bigint"))
    assert [len(x) for x in none] == [0, 0]


def test_grams_come_as_columns(spark, monkeypatch):
    def rows(self):
        raise AssertionError("an object a value")

    docs = spark.createDataFrame([(1, "ab ba", "xx"), (2, "cd dc", "yy"), (3, None, "yy"), (4, "ef", None)], "doc_id bigint, text string, lang string")
    monkeypatch.setattr(type(docs), "toPandas", rows)
    model = langid.train(docs)
    assert model.langs == ["xx", "yy"]
    assert langid.judge(model, ["abba", "dccd", "", None])[0] == ["xx", "yy", "und", "und"]
    assert langid.train(docs.limit(0)) is None
