"""Odd tables through op1, op2, op9 and every pipeline stage: nulls, empty and long values, repeats, clashing names."""

import hashlib

import pytest
from pyspark.sql import functions as F

from valuescope.llm import preference, queries, warc
from valuescope.llm.common import shared_path

PAGES = "page_id bigint, url string, html string"
TURNS = "conv_id bigint, turn bigint, role string, text string"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def clash(df, *names):
    return df.withColumns({n: F.lit("clash") for n in names})


def written(tmp_path, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def op1_rows(spark, pages):
    path = shared_path(spark, "odd-warc")
    warc.write_archive(warc.page_records(pages), path)
    return sorted((tuple(r) for r in warc.page_captures(warc.assemble(warc.read_archive(spark, path))).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_op1(spark, tmp_path):
    big = "ü" * 3_000_000
    rows = [(1, "http://a/", big), (2, "http://a/", big), (3, None, None), (4, "http://b/ x\r\n", ""), (5, "", "k" * 1000), (6, "", "k" * 999), (7, "", "k" * 999), (8, "u", "k" * 1000)]
    pages = spark.createDataFrame(rows, PAGES)
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    last = {big: 2, "k" * 1000: 8}
    want = [(i, len((h or "").encode()), sha(h), "revisit" if last.get(h, i) != i else "response", last[h] if last.get(h, i) != i else None) for i, _, h in rows]
    assert op1_rows(spark, pages) == sorted(want, key=str)
    assert op1_rows(spark, clash(pages, "uid", "digest", "size", "body", "revisit", "first_id", "salt", "n", "uri")) == sorted(want, key=str)
    assert queries.op1_warc_transactions(spark, written(tmp_path, pages=pages.limit(0))).count() == 0


def test_op2(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", f"t{k}") for k in range(1500)] + [(2, None, None, None), (2, 0, "assistant", "x"), (3, 0, "user", "q"), (None, 0, "assistant", "y")]
    turns = spark.createDataFrame(rows, TURNS)

    def pairs(df):
        return {r["pair_id"]: r for r in preference.render_pairs(preference.echo_negatives(df)).collect()}

    got = pairs(turns)
    assert set(got) == {1, 2} and got[1]["n_prompt_turns"] == 1499 and got[1]["chosen"] != got[1]["rejected"]
    assert pairs(clash(turns, "a", "b", "last", "n", "pair_id")) == got
    assert pairs(turns.limit(0)) == {} and pairs(turns.filter("conv_id = 3")) == {}


def test_op9(spark, tmp_path_factory):
    long = "http://www.example.com/de/" + "a" * 200_000 + "?q=" + "b&c=" * 2000
    rows = [(1, long, ""), (2, None, ""), (3, "no scheme", ""), (4, "HTTP://EXAMPLE.NET/en/x", ""), (4, "HTTP://EXAMPLE.NET/en/x", ""), (None, "http://x.net", ""), (6, "://", "")]
    pages = spark.createDataFrame(rows, PAGES)
    labels = spark.createDataFrame([(1, 0, 0), (None, 1, 1), (4, None, None)], "doc_id bigint, quality int, toxic int")

    def verdicts(pages, labels):
        out = queries.op9_url_rules(spark, written(tmp_path_factory.mktemp("op9"), pages=pages, labels=labels))
        return sorted((tuple(r)[:5] for r in out.collect()), key=str)

    got = verdicts(pages, labels)
    assert len(got) == len(rows)
    assert (1, "www.example.com", long[len("http://www.example.com") : long.index("?")], "example.com/de/", "block") in got
    assert got.count((4, "example.net", "/en/x", "example.net/en/", "allow")) == 2 and (None, "x.net", "", None, "allow") in got
    assert verdicts(clash(pages, "host", "path", "rule", "tokens", "verdict", "explicit", "rule_id"), labels.limit(0)) == got
    assert verdicts(pages.limit(0), labels) == []


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    items = spark.createDataFrame([(1, "one two three four five six seven eight"), (2, None)], "item_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(40)], "doc_id bigint, quality int, toxic int")
    return written(tmp_path_factory.mktemp("sf"), benchmark=items, labels=labels)


def test_pipeline_stages(spark, sf):
    import corpus_pipeline as p

    good = "the cat sat on the mat and looked at the moon above the old town wall"
    rows = [(k, f"{good} {k} times", "en", "s", None) for k in range(40)]
    rows += [(None, None, None, None, None), (50, "", "en", "s", 0), (51, "!!! 12", None, "s", 5), (52, good * 2000, "en", "s", 1), (3, rows[3][1], "en", "s", None), (None, "a wholly other sentence about boats and nets", "en", "s", 1)]
    docs = clash(spark.createDataFrame(rows, DOCS), "score", "_text", "_key", "_part", "_rows", "class", "n_tokens", "part")
    for k, (name, stage) in enumerate(p.STAGES):
        out = stage(spark, docs, sf).collect()
        if k < len(p.STAGES) - 1:
            before = {tuple(r) for r in docs.collect()}
            assert all(tuple(r) in before for r in out), name
        else:
            assert len(out) == len(rows)
        empty = stage(spark, docs.limit(0), sf)
        assert empty.count() == 0 and (k == len(p.STAGES) - 1 or empty.columns == docs.columns), name
    kept = {r["doc_id"] for r in p.language(spark, docs, sf).collect()}
    assert 51 not in kept and 50 not in kept and {0, 52} <= kept
    assert p.one_of_each(spark, docs, sf).filter("doc_id = 3").count() == 1
