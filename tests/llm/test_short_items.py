"""Benchmark items too short to score are matched exactly."""

from valuescope.llm import decontaminate as d


def rows(spark, docs, items):
    a = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted((r["doc_id"], r["item_id"], r["score"]) for r in d.leaks(a, b).collect())


LONG = (9, "The river that runs through the old city is called what by those who live there? Vltava is its name.")
ITEMS = [(1, "capital of France? Paris"), (2, "法国的首都是哪里？巴黎"), (3, "Paris"), (4, None), (5, ""), (6, "capital of France? Paris"), (7, "eins zwei drei")]
DOCS = [
    (1, "Q: the CAPITAL of France, Paris!"), (2, "请问法国的首都是哪里? 巴黎。"), (3, "Paris is the capital of France"), (4, "the capital of France paristan"),
    (5, None), (6, "eins\nzwei drei"), (7, "eins zwei einsdrei"), (8, "words " * 3000 + "capital of france paris"), (8, "capital of france paris"),
]


def test_short_items_match_whole_and_in_order(spark):
    want = [(1, 1, 1.0), (1, 6, 1.0), (2, 2, 1.0), (6, 7, 1.0), (8, 1, 1.0), (8, 1, 1.0), (8, 6, 1.0), (8, 6, 1.0)]
    assert rows(spark, DOCS, ITEMS) == want
    # beside scored items, and in shards
    assert [r for r in rows(spark, DOCS, [*ITEMS, LONG]) if r[1] != 9] == want
    assert rows(spark, [(1, "x " + LONG[1] + " y")], [*ITEMS, LONG])[0][:2] == (1, 9)


def test_short_items_in_shards(spark, monkeypatch):
    monkeypatch.setattr(d, "SHARD_ITEMS", 2)
    assert len(list(d.load_shards(spark.createDataFrame([*ITEMS, LONG], "item_id long, text string")))) > 1
    assert [r for r in rows(spark, DOCS, [*ITEMS, LONG]) if r[1] != 9] == rows(spark, DOCS, ITEMS)


def test_too_short_items_alone_match_nothing(spark):
    assert rows(spark, DOCS, [(3, "Paris"), (4, None), (5, "?!"), (8, "巴黎")]) == []
