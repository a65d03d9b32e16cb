"""Language identification by prediction by partial matching over bytes.

Training counts, for every language, which byte follows each context of up to
``order`` bytes. A byte's code length is -log2 of its frequency in the longest
context that holds it; each shorter context costs an escape (method C: with d
distinct followers and n in all, a follower of count c has c / (n + d), the
escape d / (n + d)). Below the empty context all 256 bytes are alike.
Statistics stay frozen while scoring, so a byte's code length depends only on
its context, and a text's is a sum.

The context trees of all languages are compiled into one automaton: its states
are the contexts that any language has, its step goes to the longest known
suffix. The state before a byte depends on no more than ``order`` bytes, so
numpy finds the states of a whole block with ``order`` look-ups a byte. A text's
language is that with the shortest code; its score is that language's share of
2^-(``EVIDENCE`` * bits a byte) among the learned ones and plain bytes of 8 bits: as
sure as so many bytes of the text's kind would make one, however long it is, and
near 0 for a text in none of the learned languages, whose code is longer than
the plain bytes.

Training reads a sample of at most ``docs_per_lang`` documents a language (a
documented bound; the rest of the counts is Spark's). The model's size depends
on the sample and the order, not on the corpus; it is broadcast.

Defined cases: null text, or text without a letter: language ``und``, score 0.
Null language or null text: not learned from. No labelled rows at all: every
row is ``und``, score 0. Ties go to the alphabetically first language. Rows
are independent, so repeated rows repeat their result; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuescope.llm.common import bounded_sample, crc_mod, give_back

ORDER, DOCS_PER_LANG = 3, 1500
#: Longest sampled text that is learned from whole; longer ones are left out of the sample.
MAX_SAMPLE_CHARS = 200_000
#: Bytes that are scored together.
BLOCK_BYTES = 1 << 20
UNDETERMINED = "und"
#: Bytes of evidence that a score stands for.
EVIDENCE = 8
#: Bits that a byte takes without any model.
PLAIN_BITS = 8.0
#: A byte that no UTF-8 text holds: it stands between texts.
GAP = 0xFF

_LETTER = regex.compile(r"\p{L}")


@dataclass
class PpmModel:
    langs: list[str]
    order: int
    symbol: np.ndarray  # byte -> symbol; 0: never seen
    step: np.ndarray  # state * symbols + symbol -> state
    bits: np.ndarray  # language, state * symbols + symbol -> code length


def gram_counts(sample: DataFrame, lang: str, text: str, order: int) -> DataFrame:
    """lang, gram, n: how often each byte string of 1 to order + 1 bytes occurs (its length in the top byte)."""

    def run(batches):
        for batch in batches:
            names = batch.column(0).to_pylist()
            texts = batch.column(1).to_pylist()
            for name in sorted(set(names)):
                gap = bytes([GAP])
                data = np.frombuffer(gap.join(t.encode("utf-8") for n, t in zip(names, texts) if n == name), np.uint8).astype(np.int64)
                for size in range(1, order + 2):
                    if len(data) < size:
                        break
                    m = len(data) - size + 1
                    gram, clean = np.zeros(m, np.int64), np.ones(m, bool)
                    for k in range(size):
                        gram = gram << 8 | data[k : k + m]
                        clean &= data[k : k + m] != GAP
                    grams, n = np.unique(gram[clean], return_counts=True)
                    yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(grams), pa.string()), "gram": pa.array(grams | size << 56), "n": pa.array(n.astype(np.int64))})

    per_batch = sample.select(F.col(lang).alias("lang"), F.col(text).alias("text")).mapInArrow(run, "lang string, gram bigint, n bigint")
    return per_batch.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def compile_model(counts, order: int) -> PpmModel:
    """``counts``: pandas frame of lang, gram, n."""
    langs = sorted(set(counts["lang"]))
    code = {x: k for k, x in enumerate(langs)}
    which = counts["lang"].map(code).to_numpy(np.int64)
    size = (counts["gram"].to_numpy() >> 56).astype(np.int64)
    gram = counts["gram"].to_numpy() & ((1 << 56) - 1)
    n = counts["n"].to_numpy(np.float64)

    seen = np.unique(gram[size == 1])
    symbol = np.zeros(256, np.int64)
    symbol[seen] = np.arange(1, len(seen) + 1)
    symbol[GAP] = len(seen) + 1
    width = len(seen) + 2

    # states: the empty context, then the known contexts by length; parents come first
    contexts = [np.zeros(1, np.int64)] + [np.unique(gram[size == k]) for k in range(1, order + 1)]
    first = np.cumsum([0] + [len(c) for c in contexts])
    states = int(first[-1])

    def find(k: int, value: np.ndarray) -> np.ndarray:
        """State of each context of k bytes; -1 if unknown."""
        at = np.minimum(np.searchsorted(contexts[k], value), max(len(contexts[k]) - 1, 0))
        if not len(contexts[k]):
            return np.full(len(value), -1)
        return np.where(contexts[k][at] == value, first[k] + at, -1)

    step = np.zeros((states, width), np.int32)
    bits = np.zeros((len(langs), states, width), np.float32)
    for k in range(order + 1):
        rows = np.arange(first[k], first[k + 1])
        if not len(rows):
            continue
        shorter = contexts[k] & ((1 << 8 * (k - 1)) - 1) if k else None  # without the oldest byte
        up = find(k - 1, shorter) if k else None
        # steps: the longest known suffix of context + byte, at most ``order`` long
        step[rows] = step[up] if k else 0
        if k < order:
            for s, b in enumerate(seen, 1):
                to = find(k + 1, contexts[k] << 8 | int(b))
                step[rows, s] = np.where(to >= 0, to, step[rows, s])
        step[rows, width - 1] = 0
        # code lengths
        here = size == k + 1
        state = find(k, gram[here] >> 8)
        sym = symbol[gram[here] & 255]
        for lang in range(len(langs)):
            own = which[here] == lang
            total = np.bincount(state[own] - first[k], weights=n[here][own], minlength=len(rows))
            kinds = np.bincount(state[own] - first[k], minlength=len(rows))
            with np.errstate(divide="ignore"):
                escape = np.where(total > 0, np.log2(total + kinds) - np.log2(np.maximum(kinds, 1)), 0.0)
            bits[lang, rows] = (bits[lang, up] if k else 8.0) + escape[:, None]
            at = state[own] - first[k]
            bits[lang, state[own], sym[own]] = np.log2(np.maximum(total + kinds, 1))[at] - np.log2(n[here][own])
    bits[:, :, width - 1] = 0.0
    return PpmModel(langs, order, symbol, step.reshape(-1), bits.reshape(len(langs), -1))


def code_lengths(model: PpmModel, texts: list[bytes]) -> np.ndarray:
    """Code length in bits, texts x languages."""
    out = np.zeros((len(texts), len(model.langs)))
    width = int(model.symbol[GAP]) + 1
    gap = bytes([GAP]) * model.order

    def add(rows: list[int], parts: list[bytes], skips: list[int]) -> None:
        """Adds the code lengths of parts; the first ``skips`` bytes of a part only serve as context."""
        data = model.symbol[np.frombuffer(gap + gap.join(parts) if model.order else b"".join(parts), np.uint8)]
        m = len(data) - model.order
        state = np.zeros(m, np.int32)
        for k in range(model.order):
            state = model.step[state * width + data[k : k + m]]
        at = state * width + data[model.order :]
        lens = np.array([len(p) for p in parts])
        starts = np.concatenate([[0], np.cumsum(lens + model.order)[:-1]])
        sums = np.empty(m + 1)
        sums[0] = 0
        for lang in range(len(model.langs)):
            np.cumsum(model.bits[lang][at], dtype=np.float64, out=sums[1:])
            got = sums[starts + lens] - sums[starts + np.array(skips)]
            np.add.at(out[:, lang], rows, got)

    rows, parts, size = [], [], 0
    for i, t in enumerate(texts):
        if not t:
            continue
        if len(t) > BLOCK_BYTES:  # a long text goes in slices, each with the context that stands before it
            for k in range(0, len(t), BLOCK_BYTES):
                before = min(k, model.order)
                add([i], [t[k - before : k + BLOCK_BYTES]], [before])
            continue
        rows.append(i)
        parts.append(t)
        size += len(t)
        if size >= BLOCK_BYTES:
            add(rows, parts, [0] * len(parts))
            rows, parts, size = [], [], 0
    if parts:
        add(rows, parts, [0] * len(parts))
    return out


def judge(model: PpmModel | None, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and bits a byte of each text."""
    known = np.array([model is not None and t is not None and _LETTER.search(t) is not None for t in texts], bool)
    if not known.any():
        return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    data = [t.encode("utf-8") if k else b"" for t, k in zip(texts, known)]
    bits = code_lengths(model, data)
    best, least = bits.argmin(axis=1), bits.min(axis=1)
    size = np.maximum([len(d) for d in data], 1)
    rate = least / size
    rivals = np.column_stack([bits / size[:, None], np.full(len(texts), PLAIN_BITS)])
    share = 1.0 / np.exp2(np.clip((rate[:, None] - rivals) * EVIDENCE, -1000.0, 1000.0)).sum(axis=1)
    return [model.langs[b] if k else UNDETERMINED for b, k in zip(best, known)], np.where(known, share, 0.0), np.where(known, rate, 0.0)


def train(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", order: int = ORDER, docs_per_lang: int = DOCS_PER_LANG) -> PpmModel | None:
    """Model from the rows with a text and a language; None if there are none."""
    rows = df.select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text")).filter("lang is not null and key is not null")
    sample = bounded_sample(rows, "key", "lang", docs_per_lang).filter(F.col("text").isNotNull() & (F.length("text") <= MAX_SAMPLE_CHARS))
    counts = gram_counts(sample, "lang", "text", order).toArrow().to_pandas()  # as columns: a Python object a value would take ten times the driver's memory
    model = compile_model(counts, order) if len(counts) else None
    del counts
    give_back()
    return model


def predict(df: DataFrame, model: PpmModel | None, keep: list[str], text: str = "text", with_bits: bool = False) -> DataFrame:
    """Columns ``keep`` plus lang_pred, score (and bits_per_byte of the best code with ``with_bits``)."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    base = df.select(*keep, F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema if f.name != "_text")
    schema += ", lang_pred string, score double" + (", bits_per_byte double" if with_bits else "")

    def run(batches):
        for batch in batches:
            langs, score, rate = judge(sent.value, batch.column("_text").to_pylist())
            cols = {c: batch.column(c) for c in keep} | {"lang_pred": pa.array(langs, pa.string()), "score": pa.array(score)}
            if with_bits:
                cols["bits_per_byte"] = pa.array(rate)
            yield pa.RecordBatch.from_pydict(cols)

    return base.mapInArrow(run, schema)


def held_out(key, fold: int = 2, of: int = 4):
    return crc_mod(key, of) == fold
