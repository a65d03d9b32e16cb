"""Benchmark decontamination by BM25 with block-max WAND.

Test items are the documents of a small inverted index, training passages are
the queries. A posting's weight is its BM25 term weight over the item's own
total, so a passage with all of an item's words scores 1 and one threshold holds
for items of any length. Every passage of every text is looked up and every
item above the threshold retrieved:

- item numbers are cut into ranges, and each term knows its largest weight in
  each range (its block maxima); ranges whose maxima, summed over the passage's
  terms, stay below the threshold are passed over, a matrix sum for many
  passages at once;
- in the other ranges WAND walks the terms' postings in item order, picks as
  pivot the first item whose terms' maxima reach the threshold, and scores it.

A retrieved item counts as leaked when enough word n-grams of its question and
of its answer stand in the passage. The answer is the item's last sentence; an
item of one sentence, or whose last has fewer than three words, is split after
two thirds of its words.

Passages are windows of twice the longest item's words, one item length apart,
so each run of words as long as an item lies whole in one.

The index is broadcast in shards of about ``SHARD_ITEMS`` items and ``SHARD_WORDS``
words; a larger benchmark takes one pass over the texts a shard. Number of items,
document frequencies, mean and longest length are those of the whole benchmark,
so rows don't depend on the shards.

Items too short to score (fewer than ``MIN_ITEM_WORDS`` words) are matched exactly:
all their words, one after another, found in one pass of an Aho-Corasick automaton over
the words of a text; of scripts written without blanks, all their letters. Their score
and overlaps are 1. Items of fewer than ``EXACT_WORDS`` words (``EXACT_LETTERS`` letters
without blanks) match nothing, as any text may hold them.

Defined cases: null texts and null items have no words; equal items all match; repeated documents each give their rows; empty tables give an empty
result; other columns are ignored.
"""

from __future__ import annotations

import pickle
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import fsum, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuescope.llm.common import let_workers_import, materialise

K1, B = 1.2, 0.75
THRESHOLD, QUESTION_OVERLAP, ANSWER_OVERLAP, NGRAM = 0.6, 0.6, 0.5, 3
MIN_ITEM_WORDS, RANGE_ITEMS = 5, 8
#: Least words of an item that is matched exactly, and least letters of one in a script without blanks.
EXACT_WORDS, EXACT_LETTERS = 3, 6
SHARD_ITEMS, SHARD_WORDS = 512, 200_000
#: Words of text that are looked up together.
BLOCK_WORDS = 200_000

_WORD, _SENTENCE = re.compile(r"\w+"), re.compile(r"[.!?\n]+")
#: Letters of scripts that put no blanks between words: Thai, Lao, Burmese, Khmer, Kana, Han (fixed ranges).
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\U00020000-\U0003ffff]")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    parts = [w for w in map(words_of, _SENTENCE.split(text)) if w]
    whole = [w for p in parts for w in p]
    if len(parts) > 1 and len(parts[-1]) >= 3:
        return [w for p in parts[:-1] for w in p], parts[-1]
    cut = max(1, len(whole) * 2 // 3)
    return whole[:cut], whole[cut:]


def exact_pattern(words: list[str]) -> tuple[bool, str] | None:
    """How a short item is matched: (whether without blanks, its text); None if it is too short for that too."""
    joined = "".join(words)
    if _UNSPACED.search(joined):
        return (True, joined) if len(joined) >= EXACT_LETTERS else None
    return (False, f" {' '.join(words)} ") if len(words) >= EXACT_WORDS else None


class ExactItems:
    """Numbers of short items by pattern; the automata are built where they are used."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.items: dict[tuple[bool, str], list[int]] = {}
        for item, words in items:
            if pattern := exact_pattern(words):
                self.items.setdefault(pattern, []).append(item)
        self._automata: list | None = None

    def __getstate__(self):
        return {"items": self.items, "_automata": None}

    def _built(self) -> list:
        if self._automata is None:
            import ahocorasick

            self._automata = []
            for unspaced in (False, True):
                automaton = ahocorasick.Automaton()
                for (kind, text), items in self.items.items():
                    if kind == unspaced:
                        automaton.add_word(text, items)
                if len(automaton):
                    automaton.make_automaton()
                    self._automata.append((unspaced, automaton))
        return self._automata

    def find(self, words: list[str]) -> set[int]:
        """Items that stand in a text of these words."""
        found: set[int] = set()
        for unspaced, automaton in self._built() if self.items and words else ():
            text = "".join(words) if unspaced else f" {' '.join(words)} "
            for _, items in automaton.iter(text):
                found.update(items)
        return found


@dataclass
class Index:
    items: list[int]
    term: dict[str, int]
    posts: list[list[tuple[int, float]]]  # term -> (item number, weight) in item order
    most: list[float]  # term -> largest weight
    range_max: np.ndarray  # term x range
    parts: list[tuple[list[str], list[str]]]
    longest: int
    exact: ExactItems = field(default_factory=lambda: ExactItems([]))


@dataclass
class Corpus:
    n: int
    mean: float
    longest: int
    df: dict[str, int]  # of the words of the items at hand


def build_index(rows: list[tuple[int, str]], corpus: Corpus | None = None) -> Index | None:
    """Index of (item_id, text); ``corpus`` has the statistics of all items where these are a part."""
    every = [(i, t, words_of(t)) for i, t in rows if t]
    kept = [r for r in every if len(r[2]) >= MIN_ITEM_WORDS]
    short = [(i, w) for i, _, w in every if 0 < len(w) < MIN_ITEM_WORDS]
    exact = ExactItems([(len(kept) + k, w) for k, (_, w) in enumerate(short)])  # their numbers follow the scored items'
    if not kept:
        return Index([i for i, _ in short], {}, [], [], np.zeros((0, 0), np.float32), [], 1, exact) if exact.items else None
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    term: dict[str, int] = {}
    counts = []
    for _, _, words in kept:
        c: dict[int, int] = {}
        for w in words:
            k = term.setdefault(w, len(term))
            c[k] = c.get(k, 0) + 1
        counts.append(c)
    n = len(kept)
    df = np.zeros(len(term))
    for c in counts:
        df[list(c)] += 1
    if corpus is None:
        corpus = Corpus(n, sum(len(w) for _, _, w in kept) / n, max(len(w) for _, _, w in kept), {})
    else:
        df = np.array([corpus.df[t] for t in term], np.float64)
    idf = [log1p((corpus.n - x + 0.5) / (x + 0.5)) for x in df.tolist()]  # numpy's last digits depend on the place in the array
    posts: list[list[tuple[int, float]]] = [[] for _ in term]
    range_max = np.zeros((len(term), -(-n // RANGE_ITEMS)), np.float32)
    for d, c in enumerate(counts):
        norm = K1 * (1 - B + B * len(kept[d][2]) / corpus.mean)
        weight = {t: idf[t] * f * (K1 + 1) / (f + norm) for t, f in c.items()}
        own = fsum(weight.values())
        for t, w in weight.items():
            posts[t].append((d, w / own))
            range_max[t, d // RANGE_ITEMS] = max(range_max[t, d // RANGE_ITEMS], w / own)
    return Index([i for i, _, _ in kept] + [i for i, _ in short], term, posts, [max(w for _, w in p) for p in posts], range_max, [question_and_answer(t) for _, t, _ in kept], corpus.longest, exact)


def wand(index: Index, terms: list[int], low: int, high: int, threshold: float) -> list[tuple[int, float]]:
    """(item number, score) of all items of low .. high - 1 whose score reaches the threshold."""
    slack = threshold - 1e-9  # sums in another order differ in the last digits
    part = low // RANGE_ITEMS
    lists = []
    for t in terms:
        posts = index.posts[t]  # in item order: a search finds the block, nothing before it is read
        block = posts[bisect_left(posts, (low,)) : bisect_left(posts, (high,))]
        if block:
            lists.append([block, 0, float(index.range_max[t, part]) + 1e-7])
    out = []
    while lists:
        lists.sort(key=lambda x: x[0][x[1]][0])
        bound, pivot = 0.0, None
        for x in lists:
            bound += x[2]
            if bound >= slack:
                pivot = x[0][x[1]][0]
                break
        if pivot is None:
            break
        weights = []
        for x in lists:
            block, at, _ = x
            at = bisect_left(block, (pivot,), at)
            if at < len(block) and block[at][0] == pivot:
                weights.append(block[at][1])
                at += 1
            x[1] = at
        score = fsum(weights)  # the same in any order of terms
        if score >= slack:
            out.append((pivot, score))
        lists = [x for x in lists if x[1] < len(x[0])]
    return out


def overlap(part: list[str], text: list[str]) -> float:
    """Share of the part's word n-grams that stand in the text."""
    n = min(NGRAM, len(part))
    if not n:
        return 1.0
    grams = set(zip(*(part[k:] for k in range(n))))
    there = set(zip(*(text[k:] for k in range(n))))
    return len(grams & there) / len(grams)


def find_leaks(index: Index, texts: list[list[str]], threshold: float = THRESHOLD) -> list[dict[int, tuple[float, float, float]]]:
    """For each text (a list of words): item number -> (score, question overlap, answer overlap)."""
    step = index.longest
    found: list[dict[int, tuple[float, float, float]]] = [dict.fromkeys(index.exact.find(words), (1.0, 1.0, 1.0)) for words in texts]
    if not index.parts:
        return found
    # blocks of one item length; a passage is two of them that follow each other
    terms, starts, of, at = [], [], [], []
    get = index.term.get
    for k, words in enumerate(texts):
        for a in range(0, len(words), step):
            ids = list({t for t in map(get, words[a : a + step]) if t is not None})
            starts.append(len(terms))
            terms += ids or [-1]
            of.append(k)
            at.append(a)
    if not starts:
        return found
    maxima = np.vstack([index.range_max, np.zeros((1, index.range_max.shape[1]), np.float32)])  # the last row: no term
    bound = np.add.reduceat(maxima[np.array(terms)], starts, axis=0)
    of_, follows = np.array(of), np.zeros(len(of), bool)
    follows[:-1] = of_[1:] == of_[:-1]
    passage = bound.copy()
    passage[:-1][follows[:-1]] += bound[1:][follows[:-1]]
    ends = [*starts[1:], len(terms)]
    for i, r in zip(*(x.tolist() for x in np.nonzero(passage >= threshold - 1e-4))):
        query = set(terms[starts[i] : ends[i]])
        if follows[i]:
            query |= set(terms[starts[i + 1] : ends[i + 1]])
        query.discard(-1)
        hits = wand(index, sorted(query), r * RANGE_ITEMS, (r + 1) * RANGE_ITEMS, threshold)
        words = texts[of[i]][at[i] : at[i] + 2 * step] if hits else []
        for d, score in hits:
            q, a = (overlap(p, words) for p in index.parts[d])
            if q >= QUESTION_OVERLAP and a >= ANSWER_OVERLAP:
                old = found[of[i]].get(d)
                if old is None or (score, q, a) > old:
                    found[of[i]][d] = (score, q, a)
    return found


def blocks(texts, most: int = BLOCK_WORDS):
    """Lists of texts' words, of about ``most`` words in all."""
    part, size = [], 0
    for t in texts:
        words = words_of(t)
        part.append(words)
        size += len(words)
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def load_shards(items: DataFrame, key: str = "item_id", text: str = "text") -> Iterator[Index]:
    """The benchmark's index, in shards of bounded size, one at a time; tasks build them."""

    def count(batches):
        for batch in batches:
            words = [words_of(t) for t in batch.column(1).to_pylist()]
            cols = [pa.array([len(w) for w in words], pa.int64()), pa.array([sorted(set(w)) for w in words], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=["item_id", "text", "size", "words"])

    let_workers_import(items.sparkSession)
    rows = items.select(F.col(key).cast("bigint").alias("item_id"), F.col(text).alias("text")).mapInArrow(count, "item_id bigint, text string, size bigint, words array<string>")
    rows = materialise(rows.filter("size > 0").withColumn("row", F.monotonically_increasing_id()), "items")
    scored = F.col("size") >= MIN_ITEM_WORDS
    every, words, n, total, longest = rows.agg(F.count("*"), F.sum("size"), F.count(F.when(scored, 1)), F.sum(F.when(scored, F.col("size"))), F.max(F.when(scored, F.col("size")))).first()
    if not every:
        return
    shards = max(-(-every // SHARD_ITEMS), -(-words // SHARD_WORDS))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    pairs = rows.filter(scored).select("shard", F.explode("words").alias("word")).groupBy("shard", "word").agg(F.count("*").alias("here"))
    frequencies = materialise(pairs.join(pairs.groupBy("word").agg(F.sum("here").alias("df")), "word").select("shard", "word", "df"), "frequencies")

    def build(part, words):
        df = dict(zip(words.column("word").to_pylist(), words.column("df").to_pylist()))
        index = build_index(list(zip(part.column("item_id").to_pylist(), part.column("text").to_pylist())), Corpus(n, (total or 0) / max(n, 1), longest or 1, df))
        return pa.table({"shard": pa.array([part.column("shard")[0].as_py()], pa.int32()), "index": pa.array([pickle.dumps(index)], pa.binary())})

    built = rows.select("shard", "item_id", "text").groupBy("shard").cogroup(frequencies.groupBy("shard")).applyInArrow(build, "shard int, index binary")
    for r in materialise(built, "index").toLocalIterator():
        if (index := pickle.loads(r["index"])) is not None:
            yield index


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap: one row for each document and item that it holds."""
    base = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("_text"))
    schema = "doc_id bigint, item_id bigint, score double, question_overlap double, answer_overlap double"
    names = [c.split()[0] for c in schema.split(", ")]
    out = docs.sparkSession.createDataFrame([], schema)
    for k, index in enumerate(load_shards(items)):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            index = sent.value
            for batch in batches:
                ids, at = batch.column(0).to_pylist(), 0
                for part in blocks(t.as_py() for t in batch.column(1)):
                    got = [(doc, index.items[d], *x) for doc, f in zip(ids[at : at + len(part)], find_leaks(index, part)) for d, x in sorted(f.items())]
                    at += len(part)
                    if got:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if j < 2 else pa.float64()) for j, c in enumerate(zip(*got))], names=names)

        each = base.mapInArrow(run, schema)
        out = each if k == 0 else out.union(each)
    return out


def clean_mask(shards: list, texts: list[str | None]) -> list[bool]:
    """Whether each text holds no item."""
    out: list[bool] = []
    for part in blocks(texts):
        found = [find_leaks(s.value, part) for s in shards]
        out += [not any(f[i] for f in found) for i in range(len(part))]
    return out
