"""Training-data operators: brute force, round trips, held-out accuracy and odd inputs."""

from collections import defaultdict

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from valuescope.llm import bpe, decontaminate, jaccard, langid, preference, quality, quality_rules, training_order, url_rules, warc
from valuescope.llm.common import shared_path, table
from valuescope.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, rule string"
ODD = [
    (1, None, None, None, None, "x", "r"), (2, "", "en", "s", 0, "x", "r"), (3, "a b c", "en", "s", 5, None, None), (3, "a b c", "en", "s", 5, None, None),
    (4, "one two three four five six " * 3000, "en", "s", None, "x", "r"), (None, "one two three four five six", "en", "s", 9, "x", "r"), (6, "%%% 12 !!\n\n", "de", "s", 9, "x", "r"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOC)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOC)


def test_bpe_equals_the_library():
    from tokenizers import Tokenizer

    mine, theirs = bpe.SegmentTreeBpe(open(tokenizer_path(), encoding="utf-8").read()), Tokenizer.from_file(tokenizer_path())
    texts = ["", " ", "Hello, World's 12 ends", "a" * 3000, "ab" * 500, "ΑΣ İé́ \x1c x\x85y <|endoftext|>z", "nächste ﬁ 漢字 😀!!"]
    for text, (n, ids, tokens) in zip(texts, mine.encode_block(texts)):
        e = theirs.encode(text, add_special_tokens=False)
        assert ids == " ".join(map(str, e.ids)) and n == len(e.ids)
        assert tokens == theirs.decode(e.ids, skip_special_tokens=False)


def test_bpe_side_by_side_equals_one_by_one():
    m = bpe.SegmentTreeBpe(open(tokenizer_path(), encoding="utf-8").read())
    pieces = [b"hello", b"a", b"tttttt", "été".encode(), b"internationalisations"]
    for p in pieces:
        assert m.merge_side_by_side([p], 31)[0] == m.merge(p)


def test_jaccard_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    base = [list(rng.integers(0, 400, int(rng.integers(4, 90)))) for _ in range(12)]
    rows = []
    for k in range(160):
        words = list(base[k % 12])
        for _ in range(int(rng.integers(0, 4))):
            words[int(rng.integers(len(words)))] = 1000 + k
        rows.append((k, " ".join(f"W{w}" for w in words)))
    rows += [(900, None), (901, "  "), (902, "One two"), (903, "oNE\ttwo")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r[0]: (r[1], r[2]) for r in jaccard.jaccard_components(docs).select("doc_id", "n_shingles", "component_id").collect()}
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert got == {i: (len(sets[i]), find(i)) for i in sets}
    kept = {r[0] for r in jaccard.keep_one(docs).select("doc_id").collect()}
    assert kept == {i for i in sets if find(i) == i}


def test_language_held_out(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = langid.train(docs.filter(~langid.held_out(F.col("doc_id"))))
    rows = langid.predict(docs.filter(langid.held_out(F.col("doc_id"))), model, ["lang"]).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)


def test_code_lengths_do_not_depend_on_blocks():
    import pandas as pd

    grams = defaultdict(int)
    for text in (b"the cat and the hat", b"la rata"):
        for size in (1, 2, 3):
            for k in range(len(text) - size + 1):
                grams[("en" if text[0] == 116 else "es", int.from_bytes(text[k : k + size], "big") | size << 56)] += 1
    m = langid.compile_model(pd.DataFrame([(a, g, n) for (a, g), n in grams.items()], columns=["lang", "gram", "n"]), 2)
    long, old = b"the hat and the rat " * 40, langid.BLOCK_BYTES
    whole = langid.code_lengths(m, [long, b"la"])
    try:
        langid.BLOCK_BYTES = 64
        parts = langid.code_lengths(m, [long, b"la"])
    finally:
        langid.BLOCK_BYTES = old
    assert np.allclose(whole, parts, rtol=1e-5)


def test_quality_held_out(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    m = quality.train(docs, labels.filter(~quality.held_out(F.col("doc_id"))))
    rows = quality.score(docs, m, ["doc_id"]).join(labels.filter(quality.held_out(F.col("doc_id"))), "doc_id").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)


def test_pair_term_is_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    m = quality.Machine(0.3, rng.normal(size=6), rng.normal(size=(6, 3)))
    idx, val = np.array([0, 2, 5]), np.array([1.0, 0.5, 2.0])
    pairs = sum(m.factors[idx[a]] @ m.factors[idx[b]] * val[a] * val[b] for a in range(3) for b in range(a))
    assert np.isclose(m.raw(idx, val, np.array([0]))[0], 0.3 + m.linear[idx] @ val + pairs)


def test_wand_finds_all_above_the_threshold():
    rng = np.random.default_rng(3)
    items = [(k, " ".join(f"w{x}" for x in rng.integers(0, 60, 12))) for k in range(40)]
    ix = decontaminate.build_index(items)
    for _ in range(30):
        query = [ix.term[t] for t in {f"w{x}" for x in rng.integers(0, 60, 30)} if t in ix.term]
        scores = defaultdict(float)
        for t in query:
            for d, w in ix.posts[t]:
                scores[d] += w
        want = {d for d, s in scores.items() if s >= 0.5}
        got = {d for low in range(0, 40, decontaminate.RANGE_ITEMS) for d, _ in decontaminate.wand(ix, query, low, low + decontaminate.RANGE_ITEMS, 0.5)}
        assert got == want


def test_leaks_equal_containment(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    got = {(r[0], r[1]) for r in decontaminate.leaks(docs, items).select("doc_id", "item_id").collect()}
    want = set()
    words = [(r["item_id"], " ".join(decontaminate.words_of(r["text"]))) for r in items.collect()]
    for d in docs.select("doc_id", "text").collect():
        text = f" {' '.join(decontaminate.words_of(d['text']))} "
        want |= {(d["doc_id"], i) for i, w in words if f" {w} " in text}
    assert want <= got


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 1000, 4097])
def test_slots_are_a_permutation(n):
    slots = training_order.slot_of(np.arange(n), n)
    assert sorted(slots.tolist()) == list(range(n))
    assert (training_order.index_of(slots, n) == np.arange(n)).all()


def test_shards_round_trip(spark, odd, nothing):
    path = shared_path(spark, "t")
    n = training_order.write_shards(odd, path, length=64, shard_slots=16)
    rows = training_order.read_from(spark, path, shard_slots=16).collect()
    assert sorted(r["slot"] for r in rows) == list(range(n))
    by = defaultdict(list)
    for r in rows:
        assert len(r["tokens"]) == 128 and r["shard"] == r["slot"] // 16
        by[r["doc_id"]].append((r["chunk"], np.frombuffer(r["tokens"], "<u2")[: r["n_tokens"]]))
    ids = np.concatenate([x for _, x in sorted(by[4], key=lambda p: p[0])])
    assert bytes(ids[:-1].astype(np.uint8)).decode() == ODD[4][1] and ids[-1] == training_order.END
    for start in (0, 20, 32, n - 1, n):
        assert [r["slot"] for r in training_order.read_from(spark, path, start, 16).collect()] == list(range(start, n))
    # every shard is one file whose rows stand by slot, all of one stride
    files = [f for f in os.listdir(path.removeprefix("file:")) if f.startswith("part-")]
    assert len(files) == -(-n // 16)
    for shard in range(len(files)):
        here = training_order.read_shard(spark, path, shard).selectExpr("slot", "length(tokens) as size", "_metadata.row_index as at").collect()
        assert [r["slot"] for r in here] == list(range(shard * 16, min(n, shard * 16 + 16)))
        assert all(r["at"] * r["size"] == r["slot"] % 16 * 128 for r in here)
        assert [r["slot"] for r in training_order.read_shard(spark, path, shard, skip=5).collect()] == [r["slot"] for r in here][5:]
    # a sequence's slot is the permutation of its place among the documents, task by task
    assert sorted(training_order.index_of(np.array([r["slot"] for r in rows]), n).tolist()) == list(range(n))
    empty = shared_path(spark, "t")
    assert training_order.write_shards(nothing, empty) == 0 and training_order.read_from(spark, empty).count() == 0


def test_archive_round_trip(spark):
    tricky = "<p>WARC/1.1\r\n\r\nContent-Length: 3\r\n</p>" + "é" * 600
    rows = [(1, "http://a/x", tricky, 0), (2, "http://b/\ny", tricky, 0), (3, None, None, 0), (4, "http://c", "short", 0), (4, "http://c", "short", 0), (None, "u", tricky, 0)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, record int")
    path = shared_path(spark, "t")
    warc.write_archive(warc.page_records(pages), path)
    records = warc.read_archive(spark, path)
    assert {bytes(r[0]).decode() for r in records.filter("record_type = 'response'").select("payload").collect()} == {tricky, "", "short"}
    got = sorted((r[0] or 0, r[1], r[3], r[4]) for r in warc.page_captures(warc.assemble(records)).collect())
    size = len(tricky.encode())
    assert got == [(0, size, "revisit", 2), (1, size, "revisit", 2), (2, size, "response", None), (3, 0, "response", None), (4, 5, "response", None), (4, 5, "response", None)]


def test_preference_prefix(spark):
    c = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 1, "assistant", "yes"), (2, 0, None, None), (None, 0, "user", "x")]
    r = [(1, 0, "user", "hi"), (1, 1, "assistant", "no"), (3, 0, "user", "q")]
    s = "pair_id bigint, turn bigint, role string, text string"
    got = {x["pair_id"]: x for x in preference.format_pairs(spark.createDataFrame(c, s), spark.createDataFrame(r, s)).collect()}
    one = got[1]
    assert one["prompt"] == "<|im_start|>user\nhi<|im_end|>\n" and one["n_prompt_turns"] == 1
    assert one["chosen"] == "<|im_start|>assistant\nyes<|im_end|>\n" and one["chosen_mask"] == "22:0,14:1"
    assert sum(int(x.split(":")[0]) for x in one["rejected_mask"].split(",")) == len(one["rejected"])
    assert got[2]["rejected"] == "" and got[3]["chosen"] == ""


def test_binomial_tail_equals_the_sum(spark):
    from math import comb, log

    cases = [(0, 0, 0.02), (1, 0, 0.02), (500, 3, 0.02), (500, 9, 0.02), (3000, 40, 0.02), (200, 1, 0.1), (100, 30, 0.02)]
    for n, k, a in cases:
        got = spark.range(1).select(quality_rules.log_tail(F.lit(n), F.lit(k), a)).first()[0]
        want = log(sum(comb(n, i) * a**i * (1 - a) ** (n - i) for i in range(k + 1))) if k < n * a else 0.0
        assert abs(got - want) < 1e-8 * max(1, abs(want))
    far = spark.range(1).select(quality_rules.log_tail(F.lit(10**9), F.lit(19_990_000), 0.02)).first()[0]  # 2.26 deviations below the mean
    assert abs(far - log(0.0119)) < 0.02


def _labelled(spark, rows):
    import hashlib

    return spark.createDataFrame([(s, hashlib.md5(f"{s}{i}".encode()).hexdigest(), m, y) for i, (s, m, y) in enumerate(rows)], "stratum string, digest string, m int, label int")


def test_cutoffs_keep_their_promise(spark):
    rules = {"m": ("m", (0, 10, 20, 30))}
    # 500 labels: bad texts lie above 20, good ones below 12; a small stratum is pooled with another
    rows = [("en", 25 + i % 9, 0) for i in range(60)] + [("en", i % 12, 1) for i in range(500)]
    rows += [(s, 40, 0) for s in ("de", "fr") for _ in range(20)] + [(s, 1, 1) for s in ("de", "fr") for _ in range(280)]
    rows += [("es", 40, 0)] * 20 + [("es", 39, 1)] * 500
    got = {(r["stratum"], r["rule"]): r for r in quality_rules.choose_cutoffs(_labelled(spark, rows), rules).collect()}
    assert {k: r["cutoff"] for k, r in got.items()} == {("en", "m"): 20, ("de", "m"): 10, ("fr", "m"): 10}
    assert got["de", "m"]["judged_with"] is None and got["de", "m"]["n"] == got["fr", "m"]["n"] and got["en", "m"]["judged_with"] == "en"
    assert ("es", "m") not in got  # what catches bad texts there rejects the good ones
    copies = _labelled(spark, [("en", 25, 0)] * 30 + [("en", 1, 1)] * 500).withColumn("digest", F.when(F.col("label") == 1, F.lit("f0")).otherwise(F.col("digest")))
    assert quality_rules.choose_cutoffs(copies, rules).collect() == []  # 500 copies of a good text are one trial
    assert quality_rules.choose_cutoffs(copies.limit(0), rules).collect() == []


def test_false_rejections_stay_bounded_on_new_texts(spark):
    import random

    rng = random.Random(4)
    rules = {"m": ("m", tuple(range(0, 100, 5))), "w": ("w", tuple(range(0, 100, 5)))}

    def draw(n):
        rows = []
        for i in range(n):
            y = int(rng.random() < 0.8)
            rows.append(("en", f"{rng.getrandbits(128):032x}", int(rng.gauss(20 if y else 60, 15)), int(rng.gauss(30 if y else 50, 20)), y))
        return spark.createDataFrame(rows, "stratum string, digest string, m int, w int, label int")

    cut = {r["rule"]: r["cutoff"] for r in quality_rules.choose_cutoffs(draw(6000), rules).collect()}
    rejected = F.expr(" or ".join(f"{name} > {c}" for name, c in cut.items()))
    shares = {r["label"]: r["s"] for r in draw(6000).groupBy("label").agg(F.avg(rejected.cast("int")).alias("s")).collect()}
    assert shares[1] <= 0.025 and shares[0] > 0.3


def test_url_rules(spark):
    urls = ["http://A.Example.NET/en/1?x#y", "http://net/en/", "https://notnet/fr/2", "x", None, "http://m.org/fr/", "http://example.net"]
    host, path = url_rules.split_url(F.col("url"))
    df = spark.createDataFrame([(u,) for u in urls], "url string").select(host.alias("h"), path.alias("p"))
    rule, verdict = url_rules.explicit_rule(F.col("h"), F.col("p"), [("net", "/", "block"), ("example.net", "/en/", "allow"), ("org", "/fr/", "allow")])
    got = [tuple(r) for r in df.select("h", "p", rule, verdict).collect()]
    assert got == [("a.example.net", "/en/1", "example.net/en/", "allow"), ("net", "/en/", "net/", "block"), ("notnet", "/fr/2", None, None), ("", "", None, None), ("", "", None, None), ("m.org", "/fr/", "org/fr/", "allow"), ("example.net", "", None, None)]


def test_mined_rules(spark):
    rows = [(["a", "b"], "block")] * 30 + [(["a"], "allow")] * 50 + [(["b"], "allow")] * 40
    rules = url_rules.mine_rules(spark.createDataFrame(rows, "tokens array<string>, label string"))
    assert [(r["rule_id"], r["confidence"]) for r in rules.collect()] == [("a b", 1.0)]
    judged = url_rules.judge(spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a"]), (2, None)], "k int, tokens array<string>"), "tokens", rules).collect()
    assert sorted((r["k"], r["rule_id"] or "") for r in judged) == [(1, "a b"), (2, ""), (2, "")]


def test_odd_and_empty_inputs(spark, odd, nothing):
    items = spark.createDataFrame([(1, "one two three four five six"), (2, None), (3, "a b")], "item_id bigint, text string")
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, 0), (6, None, 1), (77, 0, 0)], "doc_id bigint, quality int, toxic int")
    for docs, n in ((odd, len(ODD)), (nothing, 0)):
        model = langid.train(docs)
        got = langid.predict(docs, model, ["doc_id", "score", "rule"][:1]).collect()
        assert len(got) == n and all(r["lang_pred"] == "und" for r in got if r["doc_id"] in (1, 2, 6))
        assert quality.score(docs, quality.train(docs, labels), ["doc_id"]).count() == n
        assert quality_rules.controlled_filter(docs, labels).count() == n
        assert jaccard.jaccard_components(docs).count() == n
        assert bpe.encode_decode(docs, tokenizer_path(), ["doc_id"]).count() == n
        assert {r["doc_id"] for r in decontaminate.leaks(docs, items).collect()} == ({4, None} if n else set())
    # the row (3, "a b c") comes twice and one of it stays
    assert jaccard.keep_one(odd).filter("doc_id = 3").count() == 1
    assert jaccard.keep_one(odd).columns == odd.columns


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    docs = table(spark, SF, "documents")
    before = docs.count()
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        rows = out.count()
        assert 0 < rows <= before, name
