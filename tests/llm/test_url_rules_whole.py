"""Mined URL rules: none that support and confidence admit is cut away."""

import pytest

from valuescope.llm import url_rules

RULES = "tokens array<string>, label string"


def test_pure_hosts_do_not_crowd_out_other_rules(spark):
    # 27 hosts of ten tokens each give 27 x 1023 sets of confidence 1, of which the single tokens aren't redundant
    rows = [([f"h{h}t{k}" for k in range(10)], "block") for h in range(27)] * 10 + [(["weak"], "block")] * 12 + [(["weak"], "allow")] * 8
    rules = {r["rule_id"]: r["confidence"] for r in url_rules.mine_rules(spark.createDataFrame(rows, RULES)).collect()}
    assert rules == {f"h{h}t{k}": 1.0 for h in range(27) for k in range(10)} | {"weak": 0.6}


def test_rules_of_many_tokens_and_no_redundant_ones(spark):
    five = list("abcde")
    rows = [(five, "block")] * 12 + [([t for t in five if t != out], "allow") for out in five] * 20
    # x alone is as sure as x with y; y alone isn't sure enough
    rows += [(["x", "y"], "block")] * 12 + [(["y"], "allow")] * 20
    rules = {r["rule_id"]: r["confidence"] for r in url_rules.mine_rules(spark.createDataFrame(rows, RULES)).collect()}
    assert rules == {"a b c d e": 1.0, "x": 1.0}


@pytest.mark.parametrize("most", [10_000, 0])
def test_broadcast_and_shuffled_index_judge_alike(spark, monkeypatch, most):
    monkeypatch.setattr(url_rules, "BROADCAST_RULES", most)
    rules = spark.createDataFrame([("a b", ["a", "b"], 0.1, 1.0), ("b", ["b"], 0.2, 0.6)], "rule_id string, tokens array<string>, support double, confidence double")
    urls = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["b"]), (3, ["a"]), (4, None)], "k int, tokens array<string>")
    assert {r["k"]: r["rule_id"] for r in url_rules.judge(urls, "tokens", rules).collect()} == {1: "a b", 2: "b", 3: None, 4: None}


def test_many_tokens_of_the_same_pages(spark):
    many = [f"t{k}" for k in range(30)]
    rows = [(many, "block")] * 12 + [(["t0x", "common"], "allow")] * 20 + [(["common", "z"], "block")] * 15
    rules = {r["rule_id"]: r["confidence"] for r in url_rules.mine_rules(spark.createDataFrame(rows, RULES)).collect()}
    assert rules == {t: 1.0 for t in many} | {"z": 1.0}


def test_mined_rules_equal_brute_force(spark):
    import random
    from itertools import combinations

    rng = random.Random(6)
    pages = [["a", "b"], ["a", "b", "c"], ["a", "b", "d", "e"], ["d", "e"], ["c", "f"], ["c", "d", "e", "f"], ["f"], []]
    rows = [(rng.choice(pages), rng.choice(["block", "allow", "block"])) for _ in range(300)] + [(["g", "h", "i"], "block")] * 10 + [(["g", "h", "i", "j"], "allow")] * 4
    sets = {}
    for k in range(1, 7):
        for some in combinations("abcdefghij", k):
            hits = [y for t, y in rows if set(some) <= set(t)]
            if (n := hits.count("block")) >= url_rules.MIN_PAGES:
                sets[some] = (n / len(rows), n / len(hits))
    want = {}
    for some, (support, confidence) in sets.items():
        if confidence >= url_rules.MIN_CONFIDENCE and all(sets[part][1] < confidence for k in range(1, len(some)) for part in combinations(some, k)):
            want[" ".join(some)] = (support, confidence)
    got = {r["rule_id"]: (r["support"], r["confidence"]) for r in url_rules.mine_rules(spark.createDataFrame(rows, RULES)).collect()}
    assert got == want and len(want) > 5
