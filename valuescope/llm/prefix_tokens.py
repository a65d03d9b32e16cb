"""Token counts at every prefix of a text, by dynamic programming over its characters.

The tokenizer merges neighbouring symbols whose union is a piece, best score
first, leftmost among equals. Two facts about such merging carry the method:
the encoding of a prefix that ends between two tokens is those tokens, and a
sequence of tokens is an encoding if each neighbouring pair, encoded alone,
stays that pair. So the encoding of prefix ``i`` is the encoding of a shorter
prefix ``k`` plus one piece that ends at ``i`` and goes with the last token of
``k``. Exactly one piece does, which gives count[i] = count[k] + 1; characters
outside the vocabulary cost one token for each UTF-8 byte. No prefix is ever
encoded by itself. The verdict on a pair of pieces depends on the vocabulary
alone and is remembered.

No piece holds a blank behind another character, nor a line feed, nor certain
punctuation behind a letter (which marks, is read off the vocabulary), so a text
falls into chunks between which nothing merges; counts of equal chunks are
remembered by a worker, bounded by bytes.

``prefix_table`` stores a text's counts as one signed byte a character (the
step from one prefix to the next), so that ``answer`` tells the tokens of any
prefix and the longest prefix within a budget without the text or a tokenizer.
Counts don't always grow with the prefix (a further character may merge two
tokens into one): the longest prefix within a budget may stand behind a
shorter one that is over it.

Defined cases: a null text counts as the empty text, with 0 tokens; rows are
independent, so repeated rows repeat their result; an empty table gives an
empty table; columns that aren't asked for are ignored, whatever their names.
Texts of any length are read whole, in time linear in their length.
"""

from __future__ import annotations

import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuescope.llm.common import let_workers_import

#: Bytes of remembered chunks and entries of remembered pairs in a worker, and the longest chunk remembered.
MEMO_BYTES, PAIR_ENTRIES, MEMO_CHARS = 96 << 20, 400_000, 48
#: About what Python needs for a memo entry besides its characters.
ENTRY_BYTES = 150
#: Pieces that are broadcast at most.
MAX_PIECES = 1_000_000
_SHIFT, _MASK = 20, (1 << 20) - 1  # two numbers of pieces in one
#: The character that stands for a blank in pieces.
BLANK = "▁"


def load_pieces(path: str) -> dict[str, float]:
    """Score of each mergeable piece of a sentencepiece model; refuses models for which the method isn't proven."""
    import sentencepiece

    with open(path, "rb") as f:
        sp = sentencepiece.SentencePieceProcessor(model_proto=f.read())
    if not 0 < sp.get_piece_size() <= MAX_PIECES:
        raise ValueError(f"{sp.get_piece_size()} pieces; at most {MAX_PIECES} are broadcast")
    if sp.normalize(" Ａ  ﬁ\né ") != f"{BLANK}{BLANK}Ａ{BLANK}{BLANK}ﬁ\né{BLANK}":
        raise ValueError("the model must keep texts as they are, with one blank put in front")
    ids = range(sp.get_piece_size())
    if any(map(sp.is_unused, ids)) or not any(map(sp.is_byte, ids)):
        raise ValueError("the model must fall back to bytes and have no unused pieces")
    pieces = {sp.id_to_piece(i): sp.get_score(i) for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    if any(BLANK in p.lstrip(BLANK) or "\n" in p for p in pieces):
        raise ValueError("pieces with an inner blank or a line feed would merge across chunks")
    return pieces


class PrefixCounter:
    """Token counts of all prefixes of texts, under one vocabulary."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        # pieces by number, from 1 on; 0 is none: a chunk's start, or a character outside the vocabulary
        self._names = ["", *pieces]
        self._numbers = {p: i for i, p in enumerate(pieces, 1)}
        # the longest piece that ends with three given characters; shorter pieces need no entry
        self._reach: dict[str, int] = {}
        for p in pieces:
            if len(p) > 2:
                self._reach[p[-3:]] = max(len(p), self._reach.get(p[-3:], 1))
        marks = re.escape("".join(sorted(self._marks(pieces))))
        mark, other = (f"[{marks}]", f"[^ \\n{marks}]") if marks else ("(?!)", "[^ \\n]")
        self._chunks = re.compile(f"\\n+| *(?:{mark}+{other}*|{other}+)| +")
        self._pairs: dict[int, bool] = {}
        self._totals: dict[str, int] = {}
        self._bytes = 0

    @staticmethod
    def _marks(pieces: dict[str, float]) -> set[str]:
        """Punctuation that no piece holds behind a letter or digit, nor behind a mark of which that isn't true."""
        marks = {c for p in pieces for c in p if not (c.isalpha() or c.isdecimal())} - {BLANK}
        behind = {(a, b) for p in pieces for a, b in zip(p, p[1:]) if b in marks}
        while joined := {b for a, b in behind if b in marks and a not in marks and a != BLANK}:
            marks -= joined
        return marks

    def merge(self, text: str) -> list[str]:
        """The encoding of a short text, merge by merge."""
        parts, score = list(text), self.pieces
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _stay(self, key: int) -> bool:
        """Whether two tokens stay as they are side by side (``key``: both numbers); number 0 on the left asks for the other alone."""
        if len(self._pairs) >= PAIR_ENTRIES:
            self._pairs.clear()
        left, right = self._names[key >> _SHIFT], self._names[key & _MASK]
        verdict = self._pairs[key] = self.merge(left + right) == ([left, right] if left else [right])
        return verdict

    def count_prefixes(self, chunk: str) -> list[int]:
        """Tokens of each prefix of ``chunk`` (blanks as ``BLANK``), the empty one first."""
        number, reach, pairs = self._numbers.get, self._reach.get, self._pairs
        counts, last = [0], [0]  # last: the last token's number, shifted
        start = 0  # where the last token of the prefix before starts: most often the next character joins it
        for i, char in enumerate(chunk, 1):
            token = number(chunk[start:i])
            if token is not None:
                key = last[start] | token
                stays = pairs.get(key)
                if stays or stays is None and self._stay(key):
                    counts.append(counts[start] + 1)
                    last.append(token << _SHIFT)
                    continue
            most = reach(chunk[i - 3 : i], 2) if i > 2 else 2
            for k in range(i - most if i > most else 0, i):
                token = number(chunk[k:i])
                if token is not None:
                    key = last[k] | token
                    stays = pairs.get(key)
                    if stays or stays is None and self._stay(key):
                        counts.append(counts[k] + 1)
                        last.append(token << _SHIFT)
                        start = k
                        break
            else:
                # no piece ends here: a character outside the vocabulary, which merges with nothing
                if char in self.pieces:
                    raise AssertionError(f"no encoding ends at {i} of {chunk!r}")
                counts.append(counts[-1] + len(char.encode("utf-8")))
                last.append(0)
                start = i
        return counts

    def forget(self) -> None:
        """Drops what is remembered of chunks."""
        self._totals.clear()
        self._bytes = 0

    def chunks(self, text: str) -> list[str]:
        """``text`` with the blank in front, in parts between which nothing merges."""
        return self._chunks.findall(" " + text.replace(BLANK, " ")) if text else []

    def _within(self, chunk: str) -> list[int]:
        """Tokens of each prefix of a chunk."""
        return list(range(len(chunk) + 1)) if chunk[0] == "\n" else self.count_prefixes(chunk.replace(" ", BLANK))

    def totals(self, text: str) -> tuple[list[str], list[int]]:
        """Chunks of ``text`` and tokens of each."""
        parts, known = self.chunks(text), self._totals
        try:
            return parts, list(map(known.__getitem__, parts))
        except KeyError:
            pass
        if self._bytes > MEMO_BYTES:
            self.forget()
        own = {}
        for c in set(parts).difference(known):
            if len(c) > MEMO_CHARS:
                own[c] = self._within(c)[-1]
            else:
                known[c] = self._within(c)[-1]
                self._bytes += len(c) + ENTRY_BYTES
        return parts, list(map((known | own if own else known).__getitem__, parts))

    def all_prefixes(self, text: str) -> np.ndarray:
        """Tokens of the prefixes of 0, 1, ... len(text) characters."""
        parts, totals = self.totals(text)
        if not parts:
            return np.zeros(1, np.int64)
        steps = np.fromiter(chain.from_iterable(self._within(c)[1:] for c in parts), np.int64, len(text) + 1)
        before = np.concatenate(([0], np.cumsum(totals)[:-1]))
        counts = steps + np.repeat(before, [len(c) for c in parts])
        counts[0] = 0  # the blank in front alone belongs to the empty prefix, which has no tokens
        return counts

    def cut(self, text: str, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens."""
        parts, totals = self.totals(text)
        ends = np.cumsum(totals)
        if not parts or ends[-1] <= budget:
            return len(text)
        # a prefix that ends inside a chunk has more tokens than all chunks before it
        k = int(np.searchsorted(np.concatenate(([0], ends[:-1])), budget, "right")) - 1
        spent = int(ends[k]) - totals[k]
        chars = sum(map(len, parts[:k]))
        within = self._within(parts[k])
        return max(0, chars - 1 + max(j for j, n in enumerate(within) if spent + n <= budget))


#: The counter that a worker has built last: its verdicts on pairs and counts of chunks, both bounded, serve the worker's later tasks.
_LOADED: dict[int, PrefixCounter] = {}


def _in_task(pieces: dict[str, float]) -> PrefixCounter:
    key = hash(tuple(pieces.items()))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = PrefixCounter(pieces)
    return _LOADED[key]


def _counter(df: DataFrame, model_path: str):
    let_workers_import(df.sparkSession)
    return df.sparkSession.sparkContext.broadcast(load_pieces(model_path))


def _kept_schema(df: DataFrame, keep: list[str]) -> str:
    return "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in keep)


def count_tokens(df: DataFrame, model_path: str, keep: list[str], limit: int, text: str = "text") -> DataFrame:
    """Columns ``keep`` plus n_bytes (UTF-8), n_tokens, over_limit and limit_chars, the longest prefix of at most ``limit`` tokens."""
    sent = _counter(df, model_path)
    base = df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = _kept_schema(df, keep) + "n_bytes bigint, n_tokens bigint, over_limit boolean, limit_chars bigint"

    def run(batches):
        counter = _in_task(sent.value)
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            tokens = [sum(counter.totals(t)[1]) for t in texts]
            chars = [counter.cut(t, limit) if n > limit else len(t) for t, n in zip(texts, tokens)]
            cols = [batch.column(c) for c in keep]
            cols += [pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()), pa.array(tokens, pa.int64())]
            cols += [pa.array([n > limit for n in tokens], pa.bool_()), pa.array(chars, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, [*keep, "n_bytes", "n_tokens", "over_limit", "limit_chars"])

    return base.mapInArrow(run, schema)


def prefix_table(df: DataFrame, model_path: str, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` plus prefix_steps: byte i is what character i adds to the count of the prefix before it (signed)."""
    sent = _counter(df, model_path)
    base = df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))

    def run(batches):
        counter = PrefixCounter(sent.value)
        for batch in batches:
            steps = [np.diff(counter.all_prefixes(t)).astype(np.int8).tobytes() for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(steps, pa.binary())], [*keep, "prefix_steps"])

    return base.mapInArrow(run, _kept_schema(df, keep) + "prefix_steps binary")


def answer(table: DataFrame, keep: list[str], budget: str | None = None, chars: str | None = None) -> DataFrame:
    """What a ``prefix_table`` knows: columns ``keep``, n_tokens, and for the columns named

    - ``budget``: budget_chars, the longest prefix of at most so many tokens, and budget_tokens, its count;
    - ``chars``: chars_tokens, the tokens of the prefix of so many characters (of the whole text, where it is shorter).

    A null or negative question gives null.
    """
    let_workers_import(table.sparkSession)
    asked = {name: c for name, c in (("budget", budget), ("chars", chars)) if c}
    base = table.select(*keep, "prefix_steps", *(F.col(c).cast("bigint").alias(f"_{name}") for name, c in asked.items()))
    names = ["n_tokens", *(["budget_chars", "budget_tokens"] if budget else []), *(["chars_tokens"] if chars else [])]

    def run(batches):
        for batch in batches:
            rows = {n: [] for n in names}
            ask = {q: batch.column(f"_{q}").to_pylist() if q in asked else repeat(None) for q in ("budget", "chars")}
            for steps, most, upto in zip(batch.column("prefix_steps").to_pylist(), ask["budget"], ask["chars"]):
                counts = np.concatenate(([0], np.cumsum(np.frombuffer(steps or b"", np.int8), dtype=np.int64)))
                rows["n_tokens"].append(int(counts[-1]))
                if budget:
                    at = None if most is None or most < 0 else int(np.flatnonzero(counts <= most)[-1])
                    rows["budget_chars"].append(at)
                    rows["budget_tokens"].append(None if at is None else int(counts[at]))
                if chars:
                    rows["chars_tokens"].append(None if upto is None or upto < 0 else int(counts[min(upto, len(counts) - 1)]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(rows[n], pa.int64()) for n in names)], [*keep, *names])

    return base.mapInArrow(run, _kept_schema(table, keep) + ", ".join(f"{n} bigint" for n in names))
