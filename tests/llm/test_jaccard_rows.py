"""Near duplicates of rows that repeat an id or have none, against brute force."""

from collections import Counter

import numpy as np
import pytest

from valuescope.llm import jaccard


def text(seed, n=120, changed=()):
    words = [f"w{x}" for x in np.random.default_rng(seed).integers(0, 10**6, n)]
    for k in changed:
        words[k] = f"changed{seed}x{k}"
    return " ".join(words)


def brute_force(rows):
    """(doc_id, n_shingles, component_id, n_links) of each row, sorted; texts of five words or more."""
    sets = [frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) for w in (t.split() for _, t in rows)]
    linked = lambda x, y: 100 * len(x & y) >= 80 * len(x | y)
    links = {x: {y for y in set(sets) if y != x and linked(x, y)} for x in set(sets)}
    out = []
    for (i, _), s in zip(rows, sets):
        group, todo = {s}, [s]
        while todo:
            todo += (more := links[todo.pop()] - group)
            group |= more
        out.append((i, len(s), min((j for (j, _), t in zip(rows, sets) if t in group and j is not None), default=None), len(links[s])))
    return sorted(out, key=str)


def found(spark, rows, columns):
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    return sorted((tuple(r[c] for c in columns) for r in got), key=str)


@pytest.mark.parametrize("a, b", [(5, 5), (None, None)])
def test_own_shingles_are_a_class_s(spark, a, b):
    # 100 shingles, of which 95 are shared, beside an unrelated text of the same id
    rows = [(a, text(1, 104)), (b, text(2, 104)), (7, text(1, 104, changed=(50,)))]
    rows += [(k, text(k, 104)) for k in (11, 12)]
    assert found(spark, rows, ["doc_id", "n_shingles", "component_id"]) == sorted([r[:3] for r in brute_force(rows)], key=str)


def kept(spark, rows):
    return Counter((r[0], r[1]) for r in jaccard.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())


def test_rows_without_an_id_are_judged_by_their_own_text(spark):
    a, b, c = text(1), text(2), text(3)
    assert kept(spark, [(None, a), (None, b)]) == Counter([(None, a), (None, b)])
    # a near copy of a numbered text goes, unrelated ones stay, and one of exact copies does
    near = text(3, changed=(60,))
    got = kept(spark, [(None, a), (None, b), (None, b), (None, near), (7, c), (None, None), (None, " ")])
    assert got == Counter([(None, a), (None, b), (7, c), (None, None), (None, " ")])


def test_rows_that_repeat_an_id_are_judged_by_their_own_text(spark):
    a, b = text(1), text(2)
    rows = [(5, a), (5, b), (9, text(1, changed=(50,))), (3, text(2, changed=(50,)))]
    assert kept(spark, rows) == Counter([(5, a), (3, rows[3][1])])


@pytest.mark.parametrize("block", [256, 4])
def test_links_are_counted_in_full(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    # chains and groups of near copies, an exact copy, a pair and a single
    rows = [(k, text(1, changed=range(10 * (k % 3), 10 * (k % 3) + 1 + k // 3))) for k in range(12)]
    rows += [(20, text(1)), (21, rows[0][1]), (22, text(2)), (23, text(2, changed=(60,))), (24, text(3))]
    rows += [(30 + k, text(4, changed=range(60, 60 + 4 * k))) for k in range(8)]
    want = brute_force(rows)
    assert {r[3] for r in want} >= {0, 1, 2, 3}
    assert found(spark, rows, ["doc_id", "n_shingles", "component_id", "n_links"]) == want
