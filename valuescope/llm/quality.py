"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text becomes a sparse vector: hashed lower-cased words (1 + log count, scaled
to length 1), one bin of each structure statistic, and one bin of the recorded
length (metadata). The machine scores w0 + w.x + sum over pairs <v_i, v_j> x_i x_j;
the pair term is computed in linear time as half of (sum_i v_i x_i)^2 -
sum_i (v_i x_i)^2, summed over the factors.

Training takes a sample of at most ``docs_per_label`` labelled rows a label (a
documented bound). The sample's vectors are written once to the shared folder;
in each round every part of them runs one epoch of AdaGrad from the last
weights, and the driver averages the parts' weights (iterative parameter
mixing). Weights have a fixed size, whatever the input.

Defined cases: a null text counts as empty; empty texts are scored like others
(bins for nothing, no words). Null labels and null keys aren't learned from; a
key labelled more than once counts once, with its highest label. Without both
labels in the sample there is no model and every score is 0.5. Rows are
independent, so repeated rows repeat their score; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

import pickle
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuescope.llm.common import bounded_sample, crc_mod, materialise

#: Hash space of words, bins of a statistic, factors.
WORD_SLOTS, BINS, FACTORS = 1 << 14, 12, 8
DOCS_PER_LABEL, PARTS, ROUNDS, BATCH, RATE, DECAY, SEED = 6000, 6, 8, 64, 0.1, 1e-4, 20
#: Words that a task remembers the slot of.
MEMO_WORDS = 100_000

#: Structure statistics, in the order of their bins; the last is metadata.
STATISTICS = ("n_words", "word_length", "upper", "symbols", "digits", "marks", "distinct_words", "top_word", "same_as_previous", "same_lines", "letters", "recorded_length")
SLOTS = WORD_SLOTS + len(STATISTICS) * BINS

_SYMBOLS, _DIGITS, _MARKS = regex.compile(r"[#*$%&|<>]"), regex.compile(r"\p{N}"), regex.compile(r"[!?]")
_UPPER, _LETTERS = regex.compile(r"\p{Lu}+"), regex.compile(r"\p{L}+")


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, idx: np.ndarray, val: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores of rows in compressed form; every row has at least one entry."""
        vx = self.factors[idx] * val[:, None]
        total = np.add.reduceat(vx, starts, axis=0)
        squares = np.add.reduceat(vx * vx, starts, axis=0)
        return self.bias + np.add.reduceat(self.linear[idx] * val, starts) + 0.5 * (total * total - squares).sum(axis=1)


class Slots(dict):
    """Slots of words, remembered while a task runs."""

    def __missing__(self, word: str) -> int:
        if len(self) > MEMO_WORDS:
            self.clear()
        self[word] = slot = zlib.crc32(word.encode("utf-8")) % WORD_SLOTS
        return slot


def _share(part: float, whole: float) -> int:
    """Bin of a share: 0 for none, then by powers of 2 below 1, the last for all."""
    if part <= 0 or whole <= 0:
        return 0
    return max(1, BINS - 1 + int(np.floor(np.log2(min(1.0, part / whole)) * 1.5)))


def features(text: str | None, recorded: int | None, known: Slots) -> tuple[list[int], list[float]]:
    """Slots and values of one whole text."""
    text = text or ""
    words = text.lower().split()
    n, chars = len(words), len(text)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    letters = sum(map(len, _LETTERS.findall(text)))
    in_words = sum(map(len, words))
    bins = (
        min(BINS - 1, int(np.log2(n + 1))),
        min(BINS - 1, int(in_words / n)) if n else 0,
        _share(sum(map(len, _UPPER.findall(text))), letters),
        _share(len(_SYMBOLS.findall(text)), chars),
        _share(len(_DIGITS.findall(text)), chars),
        _share(len(_MARKS.findall(text)), chars),
        min(BINS - 1, int(len(counts) / n * (BINS - 1))) if n else 0,
        _share(max(counts.values()), n) if n else 0,
        _share(sum(map(str.__eq__, words, words[1:])), n),
        _share(len(lines) - len(set(lines)), len(lines)),
        min(BINS - 1, int(letters / chars * (BINS - 1))) if chars else 0,
        0 if recorded is None else min(BINS - 1, 1 + int(np.log2(max(recorded, 0) + 1) / 2)),
    )
    idx = [WORD_SLOTS + k * BINS + b for k, b in enumerate(bins)]
    val = [1.0] * len(idx)
    if n:
        slots: dict[int, int] = {}
        for word, c in counts.items():
            s = known[word]
            slots[s] = slots.get(s, 0) + c
        x = 1.0 + np.log(np.fromiter(slots.values(), np.float64, len(slots)))
        idx += slots
        val += (x / np.sqrt((x * x).sum())).tolist()
    return idx, val


def _packed(rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots and values of all rows one after another, and where each row starts."""
    lens = np.array([len(i) for i, _ in rows])
    idx = np.concatenate([np.asarray(i, np.int64) for i, _ in rows])
    val = np.concatenate([np.asarray(v, np.float64) for _, v in rows])
    return idx, val, np.concatenate([[0], np.cumsum(lens)[:-1]])


def _epoch(m: Machine, grads: Machine, rows, labels: np.ndarray, order: np.ndarray) -> None:
    """One pass of AdaGrad in batches, in place."""
    for k in range(0, len(order), BATCH):
        some = order[k : k + BATCH]
        idx, val, starts = _packed([rows[i] for i in some])
        y = labels[some]
        err = 1.0 / (1.0 + np.exp(-np.clip(m.raw(idx, val, starts), -30, 30))) - y
        of = np.repeat(np.arange(len(some)), np.diff([*starts, len(idx)]))
        v = m.factors[idx]
        total = np.add.reduceat(v * val[:, None], starts, axis=0)
        g = err[of] * val / len(some)
        used, at = np.unique(idx, return_inverse=True)
        gl = np.bincount(at, weights=g, minlength=len(used)) + DECAY * m.linear[used]
        each = g[:, None] * (total[of] - v * val[:, None])
        gf = np.stack([np.bincount(at, weights=each[:, f], minlength=len(used)) for f in range(FACTORS)], axis=1) + DECAY * m.factors[used]
        grads.linear[used] += gl * gl
        grads.factors[used] += gf * gf
        grads.bias += err.mean() ** 2
        m.linear[used] -= RATE * gl / np.sqrt(grads.linear[used])
        m.factors[used] -= RATE * gf / np.sqrt(grads.factors[used])
        m.bias -= RATE * err.mean() / np.sqrt(grads.bias)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", key: str = "doc_id", recorded: str = "n_chars", docs_per_label: int = DOCS_PER_LABEL) -> Machine | None:
    """Machine from the documents that ``labels`` (key, label of 0 or 1) marks; None unless both labels occur.

    The sample is drawn from the slim labels, so that only its bounded list of keys is sent to the texts.
    """
    spark = docs.sparkSession
    marked = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).filter("label in (0, 1) and key is not null").groupBy("key").agg(F.max("label").alias("label"))
    keys = bounded_sample(marked, "key", "label", docs_per_label)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(recorded).cast("bigint").alias("recorded"))
    sample = rows.join(F.broadcast(keys), "key").dropDuplicates(["key"])

    def extract(batches):
        known = Slots()
        for batch in batches:
            got = [features(t, r, known) for t, r in zip(batch.column("text").to_pylist(), batch.column("recorded").to_pylist())]
            yield pa.RecordBatch.from_pydict({"key": batch.column("key").cast(pa.string()), "label": batch.column("label"), "idx": pa.array([g[0] for g in got], pa.list_(pa.int32())), "val": pa.array([g[1] for g in got], pa.list_(pa.float32()))})

    vectors = materialise(sample.mapInArrow(extract, "key string, label int, idx array<int>, val array<float>"), "quality-sample")
    if vectors.select("label").distinct().count() < 2:
        return None
    rng = np.random.default_rng(SEED)
    machine = Machine(0.0, np.zeros(SLOTS), rng.normal(0, 0.02, (SLOTS, FACTORS)))
    # dealt by key, so that the parts, and with them the machine, don't depend on the sample's files
    parts = vectors.repartitionById(PARTS, F.pmod(F.xxhash64("key"), F.lit(PARTS)).cast("int"))
    for turn in range(ROUNDS):
        sent = spark.sparkContext.broadcast(machine)

        def run(batches, sent=sent, turn=turn):
            keys, rows, labels = [], [], []
            for batch in batches:
                keys += batch.column("key").to_pylist()
                idx, val = (batch.column(c) for c in ("idx", "val"))
                ends = idx.offsets.to_numpy()
                flat = idx.values.to_numpy(), val.values.to_numpy()
                rows += [(flat[0][a:b], flat[1][a:b]) for a, b in zip(ends, ends[1:])]
                labels += batch.column("label").to_pylist()
            if rows:
                order = sorted(range(len(rows)), key=keys.__getitem__)  # the same epoch, however the rows arrive
                rows, labels = [rows[i] for i in order], [labels[i] for i in order]
                start = sent.value
                m = Machine(start.bias, start.linear.copy(), start.factors.copy())
                grads = Machine(1.0, np.full(SLOTS, 1e-2), np.full((SLOTS, FACTORS), 1e-2))
                _epoch(m, grads, rows, np.array(labels, np.float64), np.random.default_rng([SEED, turn]).permutation(len(rows)))
                yield pa.RecordBatch.from_pydict({"n": pa.array([len(rows)], pa.int64()), "machine": pa.array([pickle.dumps((m.bias, m.linear.astype(np.float32), m.factors.astype(np.float32)))], pa.binary())})

        got = parts.mapInArrow(run, "n bigint, machine binary").toArrow().to_pylist()  # the driver's JVM passes Arrow on as it comes
        sent.destroy()
        each = [(r["n"], *pickle.loads(r["machine"])) for r in sorted(got, key=lambda r: r["machine"])]
        n = sum(e[0] for e in each)
        machine = Machine(*(sum(e[0] / n * np.asarray(e[k], np.float64) for e in each) for k in (1, 2, 3)))
        machine.bias = float(machine.bias)
    return machine


def judge(machine: Machine | None, texts: list[str | None], recorded: list[int | None], known: Slots | None = None) -> np.ndarray:
    """Scores of texts, 0 to 1; ``known`` is a task's memo."""
    known = Slots() if known is None else known
    if machine is None:
        return np.full(len(texts), 0.5)
    out = [np.zeros(0)]
    for at in range(0, len(texts), 500):
        rows = [features(t, r, known) for t, r in zip(texts[at : at + 500], recorded[at : at + 500])]
        out.append(1.0 / (1.0 + np.exp(-np.clip(machine.raw(*_packed(rows)), -500, 500))))
    return np.concatenate(out)


def score(df: DataFrame, machine: Machine | None, keep: list[str], text: str = "text", recorded: str = "n_chars") -> DataFrame:
    """Columns ``keep`` plus score (0 to 1, higher: better) and predicted (score >= 0.5)."""
    sent = df.sparkSession.sparkContext.broadcast(machine)
    base = df.select(*keep, F.col(text).alias("_text"), F.col(recorded).cast("bigint").alias("_recorded"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema if f.name not in ("_text", "_recorded"))

    def run(batches):
        known = Slots()
        for batch in batches:
            p = judge(sent.value, batch.column("_text").to_pylist(), batch.column("_recorded").to_pylist(), known)
            cols = {c: batch.column(c) for c in keep} | {"score": pa.array(p), "predicted": pa.array((p >= 0.5).astype(np.int32))}
            yield pa.RecordBatch.from_pydict(cols)

    return base.mapInArrow(run, schema + ", score double, predicted int")


def held_out(key, fold: int = 1, of: int = 3):
    return crc_mod(key, of) == fold
