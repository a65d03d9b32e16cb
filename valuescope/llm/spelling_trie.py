"""Spelling variants: words one edit apart, found in a trie over letter-group counts.

A word's vector counts the letters of each of ``GROUPS`` groups. One inserted
letter raises one count by one, a deleted one lowers one, a replaced one does
both at most. A trie with one level a group therefore finds all words near a
given one by a depth-first search that may pass a level with one letter too
many once and with one too few once; words in the leaves it reaches are
verified letter by letter.

The top of the trie is cut where at most ``limit`` words are left; the cut
nodes (some ten thousand, whatever the input) are broadcast. Each word goes to
its own cut node to be found there, and to every cut node that its search may
reach. A task builds the rest of one cut's trie and searches it for all its
visitors at once: the recursion follows the trie, the budgets of the visitors
that are still alive are arrays. It returns counts and the best word of each
visitor, no pairs.

Words are counted by text, then by task, then by Spark; a frequent word is one
row a task.

Defined cases: null texts have no words; a null doc_id counts as the empty
text; repeated rows count each time; an empty table gives an empty table;
other columns are ignored, whatever their names. Words of any length are
whole; their counts are cut at 127 in vectors, which only lets more words
reach verification.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuescope.llm.common import let_workers_import, materialise

#: Letter groups: the code point modulo so many.
GROUPS = 16
#: Words of a cut node at least allowed, and cut nodes of that size at most.
CUT_WORDS, CUTS = 1000, 4096
#: Words that are compared with all visitors that reach their node.
LEAF_WORDS = 48
#: Visitors compared with a leaf at once, and longest word verified in a matrix.
VISITORS, MATRIX_CHARS = 2048, 48
#: Different words that a task counts before it hands them on.
COUNTED = 300_000

_RUNS = re.compile("[a-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def lower_latin(text: str) -> str:
    """``text`` with A to Z, and nothing else, in lower case."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


def count_words(docs: DataFrame, damage: int, min_chars: int, min_n: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word and n, its occurrences: lower-cased runs of letters of at least ``min_chars`` code points.

    A run whose checksum h (crc32 of "<key>:<run>") is a multiple of ``damage`` first loses its code point h % length.
    """
    let_workers_import(docs.sparkSession)

    def count(batches):
        seen: Counter = Counter()

        def rows():
            out = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["word", "n"])
            seen.clear()
            return out

        for batch in batches:
            for k, t in zip(batch.column("k").to_pylist(), batch.column("t").to_pylist()):
                start = zlib.crc32(f"{k}:".encode())
                for run, n in Counter(_RUNS.findall(lower_latin(t))).items():
                    h = zlib.crc32(run.encode(), start)
                    if h % damage == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                    if len(run) >= min_chars:
                        seen[run] += n
                if len(seen) > COUNTED:
                    yield rows()
        yield rows()

    texts = docs.filter(F.col(text).isNotNull()).select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), F.col(text).alias("t"))
    return texts.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_n)


def vectors(words: list[str]) -> np.ndarray:
    """Letters of each group in each word, cut at 127."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
    return np.minimum(np.bincount(row * GROUPS + points % GROUPS, minlength=len(words) * GROUPS), 127).reshape(-1, GROUPS).astype(np.int8)


def cut_trie(words: DataFrame) -> tuple[set[bytes], set[bytes]]:
    """Inner nodes and cut nodes of the trie's top, as prefixes of vectors; ``words`` has vector."""
    spark = words.sparkSession
    limit = max(CUT_WORDS, -(-words.count() // CUTS))
    inner, cuts, low = set(), {b""}, 0
    rows = words.groupBy("vector").agg(F.count(F.lit(1)).alias("n"))
    if words.limit(limit + 1).count() <= limit:
        return inner, cuts
    inner, cuts = {b""}, set()
    while low < GROUPS and (open_ := [p for p in inner if len(p) == low]):
        high = min(GROUPS, low + 5)
        at = spark.createDataFrame([(bytearray(p),) for p in open_], "_at binary")
        below = rows.join(F.broadcast(at), F.expr(f"substring(vector, 1, {low})") == F.col("_at"), "left_semi")
        counted = below.select(F.explode(F.transform(F.sequence(F.lit(low + 1), F.lit(high)), lambda i: F.col("vector").substr(F.lit(1), i))).alias("node"), "n").groupBy("node").agg(F.sum("n").alias("n"))
        counted = materialise(counted, "trie-top")
        big = counted.filter(F.col("n") > limit).select("node")  # at most CUTS a level
        level = {bytes(r[0]) for r in big.collect()}
        parents = big.union(at).select(F.col("node").alias("_parent"))
        small = counted.filter(F.col("n") <= limit).join(F.broadcast(parents), F.expr("substring(node, 1, length(node) - 1)") == F.col("_parent"), "left_semi")
        cuts |= {bytes(r[0]) for r in small.select("node").collect()} | {p for p in level if len(p) == GROUPS}
        inner |= {p for p in level if len(p) < GROUPS}
        low = high
    return inner, cuts


def reachable(vector: bytes, inner: set[bytes], cuts: set[bytes]) -> list[bytes]:
    """Cut nodes that a depth-first search for ``vector`` reaches with one letter too many and one too few to spend."""
    found, stack = [], [(b"", 1, 1)]
    while stack:
        node, more, less = stack.pop()
        if node in cuts:
            found.append(node)
        elif node in inner:
            n = vector[len(node)]
            stack.append((node + bytes((n,)), more, less))
            if more and n < 255:
                stack.append((node + bytes((n + 1,)), 0, less))
            if less and n:
                stack.append((node + bytes((n - 1,)), more, 0))
    return found


def _route(words: DataFrame, inner: set[bytes], cuts: set[bytes]) -> DataFrame:
    """cut, word, n, own (whether the word stands there) for every cut node that a word's search reaches."""
    sent = words.sparkSession.sparkContext.broadcast((inner, cuts))
    depth = max(map(len, cuts), default=0)

    def route(batches):
        inner, cuts = sent.value

        @lru_cache(1 << 16)
        def goals(start: bytes) -> tuple[list[bytes], bytes]:
            own = next((start[:i] for i in range(depth + 1) if start[:i] in cuts), None)
            return [c for c in reachable(start, inner, cuts) if c != own], own

        for batch in batches:
            to, at, own = [], [], []
            for i, v in enumerate(batch.column("vector").to_pylist()):
                others, home = goals(v[:depth])
                to += [home, *others]
                at += [i] * (1 + len(others))
                own += [True] + [False] * len(others)
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.binary()), batch.column("word").take(at), batch.column("n").take(at), pa.array(own, pa.bool_())], ["cut", "word", "n", "own"])

    return words.mapInArrow(route, "cut binary, word string, n bigint, own boolean")


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point lies between two different words."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


class CutTrie:
    """The trie below a cut node, searched for many words at once."""

    def __init__(self, standing: list[str], visiting: list[str]):
        self.standing, self.visiting = standing, visiting
        self.v, self.w = vectors(visiting), vectors(standing)
        self.order = np.lexsort(self.w.T[::-1])
        self.w = self.w[self.order]
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def search(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of visiting and standing words that are near each other."""
        if self.standing and self.visiting:
            none = np.zeros(len(self.visiting), np.int8)
            self._descend(0, 0, len(self.standing), np.arange(len(self.visiting)), none, none)
        if not self.pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b = (np.concatenate(x) for x in zip(*self.pairs))
        return a, self.order[b]

    def _descend(self, level: int, low: int, high: int, who: np.ndarray, more: np.ndarray, less: np.ndarray) -> None:
        """Visitors ``who`` have spent ``more`` and ``less`` on their way to the node of standing words low to high."""
        if high - low <= LEAF_WORDS or level == GROUPS:
            for k in range(low, high, LEAF_WORDS):
                for i in range(0, len(who), VISITORS):
                    part = slice(i, i + VISITORS)
                    self._leaf(level, k, min(high, k + LEAF_WORDS), who[part], more[part], less[part])
            return
        column = self.w[low:high, level]
        starts = np.flatnonzero(np.diff(column, prepend=column[0] - 1 if column[0] > 0 else 127))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), high - low]):
            over = self.v[who, level] - column[a]
            m, d = more + (over == 1), less + (over == -1)
            alive = (np.abs(over) <= 1) & (m <= 1) & (d <= 1)
            if alive.any():
                self._descend(level + 1, low + a, low + b, who[alive], m[alive], d[alive])

    def _leaf(self, level: int, low: int, high: int, who: np.ndarray, more: np.ndarray, less: np.ndarray) -> None:
        over = self.v[who, None, level:] - self.w[None, low:high, level:]
        up, down = np.maximum(over, 0).sum(2, dtype=np.int16), np.maximum(-over, 0).sum(2, dtype=np.int16)
        a, b = np.nonzero((up + more[:, None] <= 1) & (down + less[:, None] <= 1))
        a, b = who[a], b + low
        near = self._verify(a, b)
        if near.any():
            self.pairs.append((a[near], b[near]))

    def _letters(self) -> tuple[np.ndarray, ...]:
        """Letters of both sides from the left and from the right, and lengths; words above MATRIX_CHARS are cut."""
        if not hasattr(self, "_matrix"):
            sides = []
            for words in (self.visiting, [self.standing[i] for i in self.order.tolist()]):
                size = np.fromiter(map(len, words), np.int64, len(words))
                width = min(MATRIX_CHARS, int(size.max()))
                left = np.array([list(w[:width].ljust(width, "\0").encode("latin-1")) for w in words], np.uint8).reshape(len(words), width)
                right = np.array([list(w[-width:].rjust(width, "\0").encode("latin-1")) for w in words], np.uint8).reshape(len(words), width)
                sides += [left, right, size]
            self._matrix = tuple(sides)
        return self._matrix

    def _verify(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        left_a, right_a, size_a, left_b, right_b, size_b = self._letters()
        na, nb = size_a[a], size_b[b]
        short = np.minimum(na, nb)
        near = (np.abs(na - nb) <= 1) & (short > 0)
        width = min(left_a.shape[1], left_b.shape[1])
        same_left = left_a[a, :width] == left_b[b, :width]
        same_right = right_a[a, -width:] == right_b[b, -width:]
        ahead = np.where(same_left.all(1), width, (~same_left).argmax(1))
        behind = np.where(same_right.all(1), width, (~same_right[:, ::-1]).argmax(1))
        # one edit: what is equal from both ends covers the shorter word, but for a replaced letter
        covered = np.minimum(ahead, short) + np.minimum(behind, short)
        equal = (na == nb) & (ahead >= short)
        near &= ~equal & (covered >= short - (na == nb))
        long = np.flatnonzero(np.maximum(na, nb) > width)
        if len(long):
            words = self.order.tolist()
            near[long] = [one_edit(self.visiting[i], self.standing[words[j]]) for i, j in zip(a[long].tolist(), b[long].tolist())]
        return near


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near and best (struct of n and word: of largest n, then least in code-point order), for words with a near word."""
    spark = words.sparkSession
    let_workers_import(spark)

    def add(batches):
        for batch in batches:
            found = vectors(batch.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array([v.tobytes() for v in found], pa.binary())], ["word", "n", "vector"])

    base = materialise(words.select("word", "n").mapInArrow(add, "word string, n bigint, vector binary"), "word-vectors")
    inner, cuts = cut_trie(base)

    def search(table: pa.Table) -> pa.Table:
        all_words, n, own = table.column("word").to_pylist(), table.column("n").to_numpy(), table.column("own").to_numpy()
        home = np.flatnonzero(own)
        standing = [all_words[i] for i in home.tolist()]
        a, b = CutTrie(standing, all_words).search()
        rank = np.empty(len(home), np.int64)
        rank[sorted(range(len(home)), key=standing.__getitem__)] = np.arange(len(home))
        by = np.lexsort((rank[b], -n[home][b], a))
        a, b = a[by], b[by]
        first = np.flatnonzero(np.diff(a, prepend=-1))
        sizes = np.diff(np.append(first, len(a)))
        who, best = a[first].tolist(), b[first].tolist()
        return pa.table({
            "word": pa.array([all_words[i] for i in who], pa.string()), "n_near": pa.array(sizes, pa.int64()),
            "form_n": pa.array(n[home][best] if best else [], pa.int64()), "form": pa.array([standing[i] for i in best], pa.string()),
        })

    found = _route(base, inner, cuts).groupBy("cut").applyInArrow(search, "word string, n_near bigint, form_n bigint, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best")).select("word", "n_near", F.struct((-F.col("_best.less")).alias("n"), F.col("_best.form").alias("word")).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root for rows (word, form): the last word that is reached by following forms.

    A form is more frequent than its word, so chains end; each round doubles the way followed.
    """
    now = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        after = materialise(now.join(ahead, now["root"] == ahead["_at"], "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        now = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return now


def variants(words: DataFrame, factor: int) -> DataFrame:
    """word, form, root, n, n_near, form_n of rows (word, n): a word's form is its best near word, if that is ``factor`` times as frequent."""
    words = materialise(words, "words")
    near = near_words(words)
    formed = F.col("best.n") >= factor * F.col("n")
    rows = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("best.word")).alias("form"), F.when(formed, F.col("best.n")).alias("form_n"))
    rows = materialise(rows, "variants")
    ends = roots(rows.filter("form is not null"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
