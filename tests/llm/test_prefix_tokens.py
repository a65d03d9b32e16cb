"""op12 against the library, prefix by prefix."""

import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from valuescope.llm import prefix_tokens as pt

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [" ", "  ", "▁", "\n", "a", "e", "th", "the", "é", "日本", "𝄞", "\x00", "<s>", "<0x0A>", "ing", " t", "\t", "😀", "ö", "1", "22", "   ", ".", ",", "')", "(", "\"s", "://", ".com", "-", "__", "²", "²."]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def _texts(seed, n, longest):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def test_every_prefix_equals_the_library(library):
    counter = pt.PrefixCounter(pt.load_pieces(PATH))
    for text in _texts(1, 400, 14):
        want = [len(library.encode(text[:i])) for i in range(len(text) + 1)]
        assert counter.all_prefixes(text).tolist() == want
        assert sum(counter.totals(text)[1]) == want[-1]
        for budget in (0, 1, 4):
            assert counter.cut(text, budget) == max(i for i, n in enumerate(want) if n <= budget)


def test_memo_limits_change_nothing(library, monkeypatch):
    monkeypatch.setattr(pt, "MEMO_BYTES", 300)
    monkeypatch.setattr(pt, "PAIR_ENTRIES", 5)
    monkeypatch.setattr(pt, "MEMO_CHARS", 3)
    counter = pt.PrefixCounter(pt.load_pieces(PATH))
    for text in _texts(2, 60, 40):
        assert sum(counter.totals(text)[1]) == len(library.encode(text))


def test_documents_and_long_texts(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["doc_id"]: r for r in pt.count_tokens(docs, PATH, ["doc_id"], 50).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert set(got) == set(texts)
    for c, text in texts.items():
        n = len(library.encode(text))
        assert (got[c]["n_bytes"], got[c]["n_tokens"], got[c]["over_limit"]) == (len(text.encode()), n, n > 50)
        cut = got[c]["limit_chars"]
        assert len(library.encode(text[:cut])) <= 50 and (n > 50 or cut == len(text))
    long = ["ab" * 100_000, " " * 50_000 + "x", "日" * 30_000, "a\n" * 20_000]
    df = spark.createDataFrame(list(enumerate(long)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in pt.count_tokens(df, PATH, ["doc_id"], 4096).collect()}
    assert got == {i: len(library.encode(t)) for i, t in enumerate(long)}


def test_stored_counts_answer_questions(spark, library):
    texts = [*_texts(3, 80, 30), None, ""]
    rows = [(i, t, [None, -1, 0, 3, 10, 10**6][i % 6], [0, 5, None, 10**6][i % 4]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, budget long, chars long")
    table = pt.prefix_table(df, PATH, ["doc_id", "budget", "chars"])
    assert table.columns == ["doc_id", "budget", "chars", "prefix_steps"]
    got = {r["doc_id"]: r for r in pt.answer(table, ["doc_id"], "budget", "chars").collect()}
    for i, text, budget, chars in rows:
        text = text or ""
        counts = [len(library.encode(text[:k])) for k in range(len(text) + 1)]
        at = None if budget is None or budget < 0 else max(k for k, n in enumerate(counts) if n <= budget)
        assert got[i]["n_tokens"] == counts[-1]
        assert got[i]["budget_chars"] == at and got[i]["budget_tokens"] == (None if at is None else counts[at])
        assert got[i]["chars_tokens"] == (None if chars is None else counts[min(chars, len(text))])


def test_odd_tables(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, "a"), (2, "")], "doc_id long, text string")
    got = sorted(tuple(r)[1:] for r in pt.count_tokens(df, PATH, ["doc_id"], 4).collect())
    assert got == [(0, 0, False, 0)] * 3 + [(1, 1, False, 1)]
    assert pt.count_tokens(df.limit(0), PATH, ["doc_id"], 4).collect() == []
    clash = df.withColumn("n_tokens", F.lit(9)).withColumn("_text", F.lit("zz")).withColumn("n_bytes", F.lit("q"))
    assert sorted(tuple(r)[1:] for r in pt.count_tokens(clash, PATH, ["doc_id"], 4).collect()) == got


def test_only_pieces_that_can_end_here_are_looked_up():
    counter = pt.PrefixCounter({"a": -1.0, "b": -2.0, "ab": -0.5, "cccccab": -0.1, "c": -3.0})
    tried = []

    class Numbers(dict):
        def get(self, piece, default=None):
            tried.append(piece)
            return super().get(piece, default)

    counter._numbers = Numbers(counter._numbers)
    assert counter.count_prefixes("aaaaaab") == [0, 1, 2, 3, 4, 5, 6, 6]
    assert max(map(len, tried)) == 2  # no piece of three characters or more ends with "aab"
