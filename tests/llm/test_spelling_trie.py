"""op13 against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from valuescope.llm import spelling_trie as st


def brute_words(rows, damage, min_chars, min_n):
    total = Counter()
    for d, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= min_chars:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= min_n}


def brute_variants(total, factor):
    near = {w: set() for w in total}
    gaps = {}
    for w in total:
        for i in range(len(w)):
            gaps.setdefault((i, w[:i] + w[i + 1 :]), []).append(w)
            if (s := w[:i] + w[i + 1 :]) in total:
                near[w].add(s)
                near[s].add(w)
    for group in gaps.values():
        for w in group:
            near[w].update(x for x in group if x != w)
    form = {}
    for w, n in total.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-total[x], x))
            if total[best] >= factor * n:
                form[w] = best
    out = []
    for w, n in total.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), total[form[w]] if w in form else None))
    return sorted(out)


@pytest.mark.parametrize(("cut_words", "leaf_words"), [(1000, 48), (20, 3), (1, 1)])
def test_variants_equal_brute_force(spark, monkeypatch, cut_words, leaf_words):
    monkeypatch.setattr(st, "CUT_WORDS", cut_words)
    monkeypatch.setattr(st, "LEAF_WORDS", leaf_words)
    rng = random.Random(cut_words)
    total = {}
    for _ in range(300):
        total["".join(rng.choice("abié×") for _ in range(rng.randint(1, 7)))] = rng.choice([1, 5, 30, 200, 2000])
    for size in (47, 48, 49, 50, 130, 300):  # around the matrix's width and the vectors' bound
        for _ in range(5):
            w = list("a" * size)
            w[rng.randrange(size)] = rng.choice("abc")
            total["".join(w)] = rng.choice([1, 9, 50])
    df = spark.createDataFrame(list(total.items()), "word string, n long")
    assert sorted(tuple(r) for r in st.variants(df, 5).collect()) == brute_variants(total, 5)


def test_chains_of_forms_end_at_the_root(spark):
    total = {"abcdef" + "x" * k: 7**k for k in range(9)}
    df = spark.createDataFrame(list(total.items()), "word string, n long")
    got = sorted(tuple(r) for r in st.variants(df, 5).collect())
    assert got == brute_variants(total, 5) and got[0][2] == "abcdefxxxxxxxx"


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words = st.count_words(docs, 199, 6, 5)
    want = brute_words([(r["doc_id"], r["text"]) for r in docs.collect()], 199, 6, 5)
    assert {r["word"]: r["n"] for r in words.collect()} == want
    assert sorted(tuple(r) for r in st.variants(words, 5).collect()) == brute_variants(want, 5)


def test_odd_texts_and_tables(spark, monkeypatch):
    monkeypatch.setattr(st, "COUNTED", 3)
    rows = [(1, None), (None, "Straße ÀÉ÷ß İstanbul straßeſ"), (2, ""), (3, "Word " * 9 + "WORD wördĀword"), (3, "Word " * 9), (4, "q" * 5000), (4, "q" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for damage in (1, 2, 199):
        got = {r["word"]: r["n"] for r in st.count_words(df, damage, 1, 1).collect()}
        assert got == {w: n for w, n in brute_words(rows, damage, 1, 1).items() if w}
    empty = st.count_words(df.limit(0), 199, 6, 5)
    assert empty.collect() == [] and st.variants(empty, 5).collect() == []
    clash = df.withColumn("word", F.lit("x")).withColumn("n", F.lit(1)).withColumn("k", F.lit(1)).withColumn("t", F.lit("y"))
    assert st.count_words(clash, 199, 1, 1).exceptAll(st.count_words(df, 199, 1, 1)).isEmpty()
