"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

A piece (a word with its end mark) starts as its bytes. Leaf i of the tree
holds the rank of the pair that starts at symbol i, joined with i, so the
root's minimum is the leftmost pair of lowest rank. A merge changes at most
three leaves, each with a logarithmic update, and the loop ends when the root
is empty: O(n log n) for a piece of n bytes, so very long words are no danger.

Texts are normalised whole and cut into pieces, of which a task keeps a memo
bounded by bytes; it is dropped when the task ends. The pieces that a block of
texts brings anew are merged side by side: one segment tree per row of a
matrix, one merge per row and step.

Defined cases: a null text encodes as the empty text (0 tokens); special
tokens that stand in a text are matched before normalisation, as the
tokenizer file asks; rows are independent, so repeated rows repeat their
result; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of pieces that a task remembers before it starts anew, the longest piece among them, and what an entry needs besides characters.
MEMO_BYTES, MEMO_CHARS, ENTRY_BYTES = 96 << 20, 64, 300
#: Characters of text that are handled together.
BLOCK_CHARS = 2_000_000
#: Piece lengths that share a matrix; a tree has one leaf more. Longer pieces go one by one.
WIDTHS = (7, 15, 31, 63)
#: Largest tokenizer file that is broadcast.
MAX_FILE_BYTES = 64 << 20

#: Unicode White_Space, which the tokenizer's \s means (fixed values).
SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


#: In front of a special token among pieces; no piece begins so and holds more.
_MARK = "\x00special "


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next free code point from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b if b in plain else next(free)) for b in range(256)]


class SegmentTreeBpe:
    """Encoder and decoder for a word-level BPE tokenizer file (JSON)."""

    def __init__(self, spec: str):
        d = json.loads(spec)
        model = d["model"]
        vocab = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.token = {i: t for t, i in vocab.items()} | {a["id"]: a["content"] for a in d["added_tokens"]}
        chars = byte_alphabet()
        self.inner = [vocab[c] for c in chars]
        self.last = [vocab[c + self.suffix] for c in chars]
        self.made: list[int] = []
        self.rank: dict[int, int] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.made.append(vocab[a + b])
            self.rank[vocab[a] << 20 | vocab[b]] = r
        # ids, ranks and tree cells of small vocabularies fit 32 bits, also two ids side by side
        small = len(self.token) < 0xFFFF and len(self.made) < 1 << 25
        self._shift, self._key, self._cell = (16, np.uint32, np.int32) if small else (20, np.int64, np.int64)
        self._none = (1 << self._shift) - 1  # an id without pairs
        pairs = np.fromiter(self.rank, np.int64, len(self.rank))
        keys = (pairs >> 20 << self._shift | (pairs & 0xFFFFF)).astype(self._key)
        by_key = np.argsort(keys)
        self._keys = keys[by_key]
        self._ranks = (np.fromiter(self.rank.values(), np.int64, len(self.rank))[by_key] << 6).astype(self._cell)
        self._made = np.array(self.made, self._cell)
        self._inner, self._last = np.array(self.inner, self._cell), np.array(self.last, self._cell)
        self._number = [str(i) for i in range(max(self.token) + 1)]
        self.special = {a["content"]: a["id"] for a in d["added_tokens"]}
        self._specials = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        split = next(p for p in d["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # \s inside the file's pattern means White_Space
        self._pieces = regex.compile(split["pattern"]["Regex"].replace("\\s", SPACE))
        self.forget()

    def forget(self) -> None:
        """Drops what is remembered of pieces: ids and tokens of each as text, joined by a blank."""
        self._ids: dict[str, str] = {_MARK + s: str(i) for s, i in self.special.items()}
        self._tokens: dict[str, str] = {_MARK + s: s for s in self.special}
        self._bytes = 0

    def merge(self, data: bytes) -> list[int]:
        """Token ids of one piece."""
        n = len(data)
        ids = [self.inner[b] for b in data]
        ids[-1] = self.last[data[-1]]
        if n == 1:
            return ids
        rank, made = self.rank, self.made
        size = 1 << (n - 2).bit_length()
        empty = len(made) * n
        tree = [empty] * (2 * size)
        for i in range(n - 1):
            r = rank.get(ids[i] << 20 | ids[i + 1])
            if r is not None:
                tree[size + i] = r * n + i
        for p in range(size - 1, 0, -1):
            tree[p] = min(tree[2 * p], tree[2 * p + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(i: int, value: int) -> None:
            p = size + i
            tree[p] = value
            while p > 1:
                low = min(tree[p], tree[p ^ 1])
                p >>= 1
                if tree[p] == low:
                    break
                tree[p] = low

        def pair(i: int) -> int:
            j = after[i]
            r = rank.get(ids[i] << 20 | ids[j]) if j < n else None
            return empty if r is None else r * n + i

        while (top := tree[1]) < empty:
            r, i = divmod(top, n)
            j = after[i]
            k = after[j]
            ids[i] = made[r]
            ids[j] = -1
            after[i] = k
            if k < n:
                before[k] = i
            if j < n - 1:
                put(j, empty)
            put(i, pair(i))
            if before[i] >= 0:
                put(before[i], pair(before[i]))
        return [x for x in ids if x >= 0]

    def _leaves(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, empty: int) -> np.ndarray:
        key = left.astype(self._key) << self._shift | right.astype(self._key)
        k = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[k] == key, self._ranks[k] | at, empty).astype(self._cell, copy=False)

    def merge_side_by_side(self, pieces: list[bytes], width: int) -> list[list[int]]:
        """Token ids of each piece of at most ``width`` bytes (width + 1 is a power of two)."""
        m, size = len(pieces), width + 1
        empty = len(self.made) << 6
        lens = np.fromiter(map(len, pieces), np.int64, m)
        data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(m, width)
        cols, rows = np.arange(size), np.arange(m)
        ids = np.full((m, size), self._none, self._cell)
        inside = cols[:width] < lens[:, None]
        ids[:, :width][inside] = self._inner[data[inside]]
        ids[rows, lens - 1] = self._last[data[rows, lens - 1]]
        after = np.broadcast_to(cols + 1, (m, size)).copy()
        after[rows, lens - 1] = width
        before = np.broadcast_to(cols - 1, (m, size)).copy()
        before[:, 0] = width  # the last column stands for "none"
        tree = np.full((m, 2 * size), empty, self._cell)
        tree[:, size : size + width - 1] = self._leaves(ids[:, : width - 1], ids[:, 1:width], cols[: width - 1], empty)
        for p in range(size - 1, 0, -1):
            tree[:, p] = np.minimum(tree[:, 2 * p], tree[:, 2 * p + 1])
        row = np.nonzero(tree[:, 1] < empty)[0]
        while len(row):
            top = tree[row, 1]
            i = top & 63
            j = after[row, i]
            k = after[row, j]
            p = before[row, i]
            ids[row, i] = self._made[top >> 6]
            ids[row, j] = -1
            after[row, i] = k
            before[row, k] = i
            tree[row, size + j] = empty
            ids[row, width] = self._none
            n = len(row)
            put = self._leaves(ids[np.tile(row, 2), np.concatenate((i, p))], ids[np.tile(row, 2), np.concatenate((k, i))], np.concatenate((i, p)), empty)
            tree[row, size + i] = put[:n]
            tree[row, size + p] = put[n:]
            nodes = [size + i, size + j, size + p]
            for _ in range(size.bit_length() - 1):
                nodes = [n >> 1 for n in nodes]
                for n in nodes:
                    tree[row, n] = np.minimum(tree[row, 2 * n], tree[row, 2 * n + 1])
            row = row[tree[row, 1] < empty]
        got = ids[:, :width]
        keep = (got >= 0) & inside
        flat, ends = got[keep].tolist(), np.cumsum(keep.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def merge_all(self, pieces: set[str]) -> dict[str, list[int]]:
        """Token ids of each piece."""
        out: dict[str, list[int]] = {}
        by_width: dict[int, list[tuple[str, bytes]]] = {w: [] for w in WIDTHS}
        for piece in pieces:
            data = piece.encode("utf-8")
            width = next((w for w in WIDTHS if len(data) <= w), 0)
            if width:
                by_width[width].append((piece, data))
            else:
                out[piece] = self.merge(data)
        for width, group in by_width.items():
            for k in range(0, len(group), 1 << 14):
                part = group[k : k + (1 << 14)]
                out |= zip((p for p, _ in part), self.merge_side_by_side([d for _, d in part], width))
        return out

    def learn(self, pieces: set[str]) -> None:
        """Remembers ids and tokens of new pieces."""
        number, token = self._number, self.token
        for piece, ids in self.merge_all(pieces).items():
            self._ids[piece] = " ".join([number[x] for x in ids])
            self._tokens[piece] = " ".join([token[x] for x in ids])
            self._bytes += ENTRY_BYTES + 8 * len(piece)

    def pieces(self, text: str) -> list[str]:
        """Pieces of a whole text; special tokens, marked, stand for themselves."""
        out = []
        for part in self._specials.split(text) if self._specials else [text]:
            if part in self.special:
                out.append(_MARK + part)
            elif part.isascii():
                out += self._pieces.findall(part.lower())
            else:  # character by character: no final sigma
                out += self._pieces.findall(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
        return out

    def encode_block(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(number of ids, ids joined by a space, decoded text) of each whole text."""
        if self._bytes > MEMO_BYTES:
            self.forget()
        split = [self.pieces(t) for t in texts]
        new = set().union(*split).difference(self._ids)
        self.learn(new)
        ids, tokens = self._ids.__getitem__, self._tokens.__getitem__
        out = []
        for parts in split:
            text = " ".join(map(ids, parts))
            out.append((text.count(" ") + 1 if parts else 0, text, " ".join(map(tokens, parts))))
        for piece in new:
            if len(piece) > MEMO_CHARS:
                del self._ids[piece], self._tokens[piece]
        return out


def blocks(texts: list[str], most: int):
    """Consecutive parts of ``texts`` of about ``most`` characters, at least one text each."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > most:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


#: The tokenizer that a worker has parsed last, without memo.
_LOADED: dict[str, SegmentTreeBpe] = {}


def _model(spec: str) -> SegmentTreeBpe:
    key = hashlib.md5(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = SegmentTreeBpe(spec)
    return _LOADED[key]


def encode_decode(df: DataFrame, tokenizer_path: str, keep: list[str], text: str = "text", with_ids: bool = False) -> DataFrame:
    """Columns ``keep`` plus n_tokens, ids_sha256, decoded_sha256 (and ids, decoded with ``with_ids``) of each row's whole text.

    The tokenizer file is read on the driver and broadcast; its size is checked.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    if len(spec) > MAX_FILE_BYTES:
        raise ValueError(f"tokenizer file of {len(spec)} characters exceeds {MAX_FILE_BYTES}")
    sent = df.sparkSession.sparkContext.broadcast(spec)
    base = df.select(*keep, F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema if f.name != "_text")
    schema += ", n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids string, decoded string" if with_ids else "")

    def run(batches):
        bpe = _model(sent.value)
        collected = gc.isenabled()
        gc.disable()  # the memo's many strings hold no cycles; scanning them costs more than the work
        try:
            for batch in batches:
                at = 0
                for part in blocks([t or "" for t in batch.column("_text").to_pylist()], BLOCK_CHARS):
                    rows = bpe.encode_block(part)
                    cols = {c: batch.column(c).slice(at, len(part)) for c in keep}
                    at += len(part)
                    cols["n_tokens"] = pa.array([r[0] for r in rows], pa.int64())
                    for k, name in ((1, "ids_sha256"), (2, "decoded_sha256")):
                        cols[name] = pa.array([hashlib.sha256(r[k].encode("utf-8")).hexdigest() for r in rows], pa.string())
                    if with_ids:
                        cols["ids"] = pa.array([r[1] for r in rows], pa.string())
                        cols["decoded"] = pa.array([r[2] for r in rows], pa.string())
                    yield pa.RecordBatch.from_pydict(cols)
        finally:
            bpe.forget()
            if collected:
                gc.enable()

    return base.mapInArrow(run, schema)
