"""N-gram Jaccard join with token-combination prefixes.

A text's set is its distinct 5-word shingles (64-bit hashes). Texts with equal
sets form a class; classes whose sets are at least 80 % alike are linked.

Candidates come from prefixes. Shingles have one global order: rare ones first,
by hash, then the frequent ones by frequency. A set of n shingles may lose at
most t = n div 5 of them to a partner, so a prefix in which any t losses leave
one signature whole must share a signature with every partner's prefix:

- a rare shingle is a signature by itself;
- a frequent shingle belongs to a class k of its frequency and to a cell of that
  class, and every combination of k shingles of one cell is a signature. A cell
  of c shingles withstands c - k + 1 losses less one, so the prefix is extended
  until rare shingles and cells together withstand more than t.

Towards partners no smaller than itself a set may lose only n div 9 or so. The
part of a prefix that withstands that many is its short part, and the smaller
set of a pair must meet the other in it.

The number of cells follows the set's size (a power of two, and its neighbour
where a partner may fall there), which keeps cells and combinations small for
texts of any length.

Which shingles are frequent is counted over all texts: each part of a task's
texts reports the shingles that it holds more than once, the reports are summed,
and the ``FREQUENT`` largest sums are broadcast. That table only sets the order;
whatever it holds, no link is lost.

Signatures shared by two classes or more are kept. In each group one class, the
one with the fewest shingles of its own, is compared with all others (a star);
linked classes are merged, and then only pairs of a group that are still in
different components are compared, all of them. Linked classes share a component,
so their links are counted by comparing all pairs of each. Shingles that no other candidate
has can't be common to a pair: their number bounds every overlap, which spares
noisy copies most comparisons. Every comparison counts the whole sets.

Defined cases: texts are lower-cased in A-Z, words are runs of other than blank,
tab, line feed, vertical tab, form feed and carriage return; fewer words than five
are one shingle; null or wordless texts have an empty set and link with nothing
(their component is their own doc_id). Rows that repeat a doc_id with another
text are versions, each linked by its own text. Null ids never name a component
unless it has no other. An empty table gives an empty table; other columns are
ignored. Two classes of equal 64-bit hash and different 128-bit hash raise an error.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from valuescope.llm.common import materialise, tidy

WORDS, PERCENT = 5, 80
#: Frequent shingles that are told apart, and the reports (sums) from which a shingle is in a class of combinations of k.
FREQUENT, CLASSES = 1 << 17, ((16, 2), (1024, 3))
#: Shingles of texts that a task counts together; classes that a task remembers to have seen.
COUNTED_TOGETHER, MEMO_CLASSES = 2_000_000, 400_000
#: Set size for one cell.
CELL = 12
#: Classes of either side that a task compares.
BLOCK = 256
#: Parts of the id space by which texts are picked for comparison (bounds what is broadcast).
PICKED_PARTS = 1 << 20

#: Characters of text that are hashed together.
BLOCK_CHARS = 1_000_000

#: Multipliers of the mixing steps (fixed values).
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


#: A number for each byte, the same for A-Z and a-z.
_BYTE = _mix(np.arange(1, 257, dtype=np.uint64))
_BYTE[0x41:0x5B] = _BYTE[0x61:0x7B]


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles.

    A word's hash is the sum of its bytes' numbers, each times an odd number of
    its place; a shingle's hash mixes its words' one after another.
    """
    out: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(texts)
    data = [t.encode("utf-8") if t else b"" for t in texts]
    blob = np.frombuffer(b" ".join(data) + b" ", np.uint8)
    begins = np.cumsum([0] + [len(d) + 1 for d in data])
    space = _SPACE[blob]
    inside = np.flatnonzero(~space)
    if not len(inside):
        return out
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    first = np.searchsorted(inside, starts)
    lens = np.diff(np.append(first, len(inside)))
    place = np.arange(len(inside)) - np.repeat(first, lens)
    factor = _mix(np.arange(lens.max(), dtype=np.uint64) + np.uint64(1 << 20)) | np.uint64(1)
    word = _mix(np.add.reduceat(_BYTE[blob[inside]] * factor[place], first) + lens.astype(np.uint64))
    of = np.searchsorted(starts, begins)  # the first word of each text
    size = max(0, len(word) - WORDS + 1)
    full = np.full(size, WORDS, np.uint64)
    for k in range(WORDS):
        full = (full ^ word[k : k + size]) * _M1
        full ^= full >> np.uint64(32)
    full *= _M2
    for i, (a, b) in enumerate(zip(of.tolist(), of[1:].tolist())):
        if b - a >= WORDS:
            out[i] = np.unique(full[a : b - WORDS + 1])
        elif b > a:
            one = np.full(1, b - a, np.uint64)
            for k in range(a, b):
                one = (one ^ word[k]) * _M1
                one ^= one >> np.uint64(32)
            out[i] = one * _M2
    return out


def sets_of(column):
    """The set of each text of an Arrow column, block by block."""
    part, held = [], 0
    for t in column:
        t = t.as_py()
        part.append(t)
        held += len(t) if t else 0
        if held > BLOCK_CHARS:
            yield from shingle_sets(part)
            part, held = [], 0
    yield from shingle_sets(part) if part else ()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _class_of(tokens: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(tokens.tobytes())
    return _signed(d & ((1 << 64) - 1)), _signed(d >> 64)


def scan(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per text: doc_id, n, class, check. Besides, reports of shingles that occur more than once: token, times."""

    def run(batches):
        seen, sets, held = set(), [], 0

        def report():
            if not sets:
                return None
            token, times = np.unique(np.concatenate(sets), return_counts=True)
            more = times > 1
            token, times = token[more].view(np.int64), times[more].astype(np.int64)
            m = len(token)
            return pa.RecordBatch.from_arrays([pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.array(token), pa.array(times)], names=names)

        names = ["doc_id", "n", "class", "check", "token", "times"]
        for batch in batches:
            n, cls, check = [], [], []
            for s in sets_of(batch.column(1)):
                c = _class_of(s) if len(s) else (None, None)
                n.append(len(s))
                cls.append(c[0])
                check.append(c[1])
                if len(s) and c not in seen:
                    seen.add(c)
                    sets.append(s)
                    held += len(s)
                    if held > COUNTED_TOGETHER:
                        yield report()
                        seen, sets, held = set(), [], 0
            m = len(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(check, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())], names=names)
        if (last := report()) is not None:
            yield last

    base = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return base.mapInArrow(tidy(run), "doc_id bigint, n bigint, class bigint, check bigint, token bigint, times bigint")


def scales(n: int) -> range:
    """Powers of two between the sizes that a partner of a set of n may have."""
    return range((-(-n * PERCENT // 100)).bit_length() - 1, (n * 100 // PERCENT).bit_length())


def signatures(tokens: np.ndarray, frequent: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rare shingles and combinations of the prefix of a set, and which of them are short; ``frequent`` is sorted, ``times`` its sums.

    Short ones lie in the part that suffices towards partners that are no smaller, where fewer losses are allowed.
    """
    n = len(tokens)
    need = n - -(-n * PERCENT // 100) + 1
    need_short = n - -(-2 * n * PERCENT // (100 + PERCENT)) + 1
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        often = np.where(frequent[at] == tokens, times[at], 0)
        rare = tokens[often == 0]
    else:
        often, rare = np.zeros(n, np.int64), tokens
    if len(rare) >= need:
        return rare[:need].view(np.int64), np.arange(need) < need_short
    common, often = tokens[often > 0], often[often > 0]
    order = np.lexsort((common, often))
    common, often = common[order].tolist(), often[order].tolist()
    out: dict[int, bool] = {}
    for scale in scales(n):
        cells: dict[tuple[int, int], list[int]] = {}
        withstood, number, last_short = len(rare), max(1, (1 << scale) // CELL), -1
        place = {}
        for at, (token, f) in enumerate(zip(common, often)):
            if withstood < need_short:
                last_short = at
            k = next(k for least, k in reversed(CLASSES) if f >= least)
            cell = cells.setdefault((k, (token >> 20) % number), [])
            cell.append(token)
            place[token] = at
            withstood += len(cell) >= k
            if withstood >= need:
                break
        for (k, cell_number), cell in cells.items():
            for some in combinations(sorted(cell), k):
                sig = _signed(xxhash.xxh3_64_intdigest(np.array([scale, k, cell_number, *some], np.uint64).tobytes()))
                out[sig] = max(map(place.__getitem__, some)) <= last_short
    short = np.concatenate([np.arange(len(rare)) < need_short, np.fromiter(out.values(), bool, len(out))])
    return np.concatenate([rare.view(np.int64), np.fromiter(out, np.int64, len(out))]), short


def frequent_shingles(seen: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The ``FREQUENT`` shingles of the largest sums, sorted, and their sums.

    They are written before they are read: collected at once, every part's own ``FREQUENT`` would come to the driver.
    """
    sums = seen.filter("token is not null").groupBy("token").agg(F.sum("times").alias("times")).filter(F.col("times") >= CLASSES[0][0])
    chosen = materialise(sums.orderBy(F.desc("times"), "token").limit(FREQUENT), "frequent").toArrow()
    token, times = chosen.column("token").to_numpy().view(np.uint64), chosen.column("times").to_numpy()
    order = np.argsort(token)
    return token[order], times[order]


def index_rows(docs: DataFrame, sent: Broadcast, key: str, text: str) -> DataFrame:
    """signature, class, n, short: the prefixes of all texts; ``sent`` has the frequent shingles."""

    def rows(parts):
        lens = [len(p[0][0]) for p in parts]
        each = lambda k: np.repeat(np.array([p[k] for p in parts], np.int64), lens)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([p[0][0] for p in parts])), pa.array(each(1)), pa.array(each(2)), pa.array(np.concatenate([p[0][1] for p in parts]))], names=["signature", "class", "n", "short"])

    def run(batches):
        tokens, times = sent.value
        seen = set()
        for batch in batches:
            parts, held = [], 0
            for s in sets_of(batch.column(0)):
                if len(s) < 4:  # nothing but an equal set is as much alike
                    continue
                cls = _class_of(s)[0]
                if cls in seen:
                    continue
                if len(seen) >= MEMO_CLASSES:
                    seen.clear()
                seen.add(cls)
                parts.append((signatures(s, tokens, times), cls, len(s)))
                held += len(parts[-1][0][0])
                if held > 200_000:
                    yield rows(parts)
                    parts, held = [], 0
            if parts:
                yield rows(parts)

    return docs.select(F.col(text).alias("text")).mapInArrow(tidy(run), "signature bigint, class bigint, n bigint, short boolean")


def shared_only(index: DataFrame) -> DataFrame:
    """The rows of signatures that two classes or more have, each class once a signature.

    Rows come sorted by signature and class, so a look at both neighbours decides; nothing of a group is held.
    """
    ordered = index.repartition("signature").sortWithinPartitions("signature", "class")

    def run(batches):
        before, held = None, False  # the last row so far, not decided yet, and whether it has a partner
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches(([before] if before is not None else []) + [batch]).combine_chunks()
            sig, cls = table.column("signature").to_numpy(), table.column("class").to_numpy()
            fresh = np.ones(len(sig), bool)
            fresh[1:] = (sig[1:] != sig[:-1]) | (cls[1:] != cls[:-1])
            table, sig = table.filter(pa.array(fresh)), sig[fresh]
            alike = sig[1:] == sig[:-1]
            partner = np.zeros(len(sig), bool)
            partner[1:] |= alike
            partner[:-1] |= alike
            partner[0] |= held
            # the last row waits for the next batch
            out = table.slice(0, len(sig) - 1).filter(pa.array(partner[:-1]))
            before, held = table.slice(len(sig) - 1).combine_chunks().to_batches()[0], bool(partner[-1])
            yield from out.combine_chunks().to_batches()
        if before is not None and held:
            yield before

    return ordered.mapInArrow(tidy(run), index.schema)


def part_bits(parts: DataFrame, part: str) -> DataFrame:
    """word, bits: the numbers in column ``part`` as bits, 64 a row: ``PICKED_PARTS`` / 64 rows at most, whatever the input."""
    bit = F.expr(f"shiftleft(1L, cast({part} & 63 as int))")
    return parts.select(F.shiftright(part, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))


def _has_bit(bits: str, part: str) -> Column:
    """Whether the row's part is among its word's; false where there is no such word."""
    return F.expr(f"coalesce(shiftright({bits}, cast({part} & 63 as int)) & 1, 0) = 1")


def texts_of(some: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, text of one document of each class of ``some`` (class), and of few others.

    Ids are told by two parts of the id space, which bounds what is broadcast and spares a shuffle of the texts.
    """
    wanted = some.join(classes.select("class", F.col("least_id").alias("doc_id")), "class")
    parts = [F.pmod(F.xxhash64(F.col("doc_id"), F.lit(k)), F.lit(PICKED_PARTS)) for k in (0, 1)]
    picked = materialise(wanted.select(*[p.alias(f"part{k}") for k, p in enumerate(parts)]), "picked")
    near = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    for k, p in enumerate(parts):
        bits = F.broadcast(part_bits(picked, f"part{k}"))
        near = near.withColumn("part", p).join(bits, F.shiftright("part", 6) == F.col("word")).filter(_has_bit("bits", "part")).select("doc_id", "text")
    return near


def own_shingles(texts: DataFrame) -> DataFrame:
    """class, own: how many shingles of a class no other text of ``texts`` has."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                sets = [s for s in sets_of(batch.column(0).slice(at, 256)) if len(s)]
                if sets:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64)), pa.array(np.repeat(np.array([_class_of(s)[0] for s in sets], np.int64), [len(s) for s in sets]))], names=["token", "class"])

    tokens = texts.select("text").mapInArrow(tidy(run), "token bigint, class bigint")
    # a text that comes twice only makes its class's number smaller, and the bound weaker
    return tokens.groupBy("token").agg(F.min("class").alias("class"), F.count("*").alias("times")).filter("times = 1").groupBy("class").agg(F.count("*").alias("own"))


def _overlap(nx: Column, ny: Column) -> Column:
    """Least common shingles of two linked sets."""
    return F.ceil((nx + ny) * PERCENT / (100 + PERCENT))


def _possible(x: str, y: str) -> Column:
    """Whether two classes may be linked: by their sizes, by the shingles that no other candidate has, and by the smaller one's short part."""
    c = lambda s, name: F.col(f"{s}.{name}")
    small, large = F.least(c(x, "n"), c(y, "n")), F.greatest(c(x, "n"), c(y, "n"))
    most = F.least(c(x, "n") - c(x, "own"), c(y, "n") - c(y, "own"))
    short = ((c(x, "n") <= c(y, "n")) & c(x, "short")) | ((c(y, "n") <= c(x, "n")) & c(y, "short"))
    return (small * 100 >= large * PERCENT) & (most >= _overlap(c(x, "n"), c(y, "n"))) & short


def sets_by_class(some: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """class, tokens of each class of ``some`` (class), dealt out by class: joins on it read it so."""
    near = texts_of(some, classes, docs, key, text)

    def sets(batches):
        seen = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out = {}
                for s in sets_of(batch.column(0).slice(at, 256)):
                    if len(s) and (c := _class_of(s)[0]) not in seen:
                        out[c] = s.tobytes()
                if len(seen) > MEMO_CLASSES:
                    seen.clear()
                seen |= out.keys()
                yield pa.RecordBatch.from_arrays([pa.array(out.keys(), pa.int64()), pa.array(out.values(), pa.binary())], names=["class", "tokens"])

    return near.select("text").mapInArrow(tidy(sets), "class bigint, tokens binary").dropDuplicates(["class"])


def _linked(sets: list[np.ndarray], asks, there: np.ndarray):
    """For each number in ``asks``: it, and those of ``there`` whose sets are alike enough (itself, where it is there)."""
    size = np.array([len(sets[i]) for i in there])
    token, owner = np.concatenate([sets[i] for i in there]), np.repeat(np.arange(len(there)), size)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    for i in asks:
        first, last = np.searchsorted(token, sets[i], "left"), np.searchsorted(token, sets[i], "right")
        n = last - first
        at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        common = np.bincount(owner[at], minlength=len(there))
        yield i, there[100 * common >= PERCENT * (len(sets[i]) + size - common)]


def verify_blocks(mixed: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """a, b of the links between classes of different roots that meet in a group.

    Groups with the same main root form a cluster. Its minor classes, those of
    other roots, are compared with all its classes, block by block: a task holds
    about ``BLOCK`` classes of either side, however large the cluster is.
    """
    cluster = mixed.groupBy("main", "class").agg(F.min("root").alias("root"))
    counts = cluster.groupBy("main").agg(F.sum((F.col("root") != F.col("main")).cast("bigint")).alias("minors"), F.count("*").alias("all"))
    number = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    rows = cluster.join(counts.select("main", number("minors").alias("xs"), number("all").alias("ys")), "main")
    part = lambda c: F.pmod(F.xxhash64("class", F.lit(c)), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    x = rows.filter("root <> main").select("main", "class", "root", F.lit(True).alias("asks"), part("xs").alias("xb"), every("ys").alias("yb"))
    y = rows.select("main", "class", "root", F.lit(False).alias("asks"), part("ys").alias("yb"), every("xs").alias("xb"))
    placed = materialise(x.unionByName(y), "blocks")
    whole = sets_by_class(cluster.select("class").distinct(), classes, docs, key, text)

    def compare(table):
        asks, cls, root = (table.column(c).to_numpy(zero_copy_only=False) for c in ("asks", "class", "root"))
        sets = [np.frombuffer(t.as_buffer(), np.uint64) for t in table.column("tokens")]
        there = np.flatnonzero(~asks)
        a, b = [], []
        if len(there) and asks.any():
            for i, near in _linked(sets, np.flatnonzero(asks), there):
                hit = near[root[near] != root[i]]
                a += [cls[i]] * len(hit)
                b += cls[hit].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return placed.join(whole, "class").groupBy("main", "xb", "yb").applyInArrow(compare, "a bigint, b bigint").distinct()


def count_links(placed: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """class, n_links of the classes whose component (``root``) has others.

    Two that are a component are linked. In larger ones all pairs are compared,
    block by block: a task holds about ``BLOCK`` classes of either side and
    returns a number a class, and each pair of blocks meets once.
    """
    counts = placed.groupBy("root").agg(F.count("*").alias("all")).filter("all > 1")
    members = placed.select("class", "root").join(counts, "root")
    more = materialise(members.filter("all > 2").withColumn("blocks", F.ceil(F.col("all") / BLOCK).cast("int")), "members")
    cells = more.withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select("class", "root", "own", F.least("own", "other").alias("xb"), F.greatest("own", "other").alias("yb"))
    whole = sets_by_class(more.select("class"), classes, docs, key, text)

    def compare(table):
        cls, own, xb, yb = (table.column(c).to_numpy() for c in ("class", "own", "xb", "yb"))
        sets = [np.frombuffer(t.as_buffer(), np.uint64) for t in table.column("tokens")]
        n = np.zeros(len(sets), np.int64)
        asks, there = np.flatnonzero(own == xb), np.flatnonzero(own == yb)
        if len(asks) and len(there):
            for i, near in _linked(sets, asks, there):
                if xb[i] == yb[i]:
                    n[i] = len(near) - 1  # all but itself
                else:
                    n[i] = len(near)
                    n[near] += 1
        return pa.table({"class": pa.array(cls), "n": pa.array(n)})

    many = cells.join(whole, "class").groupBy("root", "xb", "yb").applyInArrow(compare, "class bigint, n bigint").groupBy("class").agg(F.sum("n").alias("n_links"))
    return many.union(members.filter("all = 2").select("class", F.lit(1).cast("bigint")))


def verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """a, b of the pairs whose whole sets are alike enough. Where a class has many partners, it had better be ``a``."""
    whole = sets_by_class(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct(), classes, docs, key, text)
    both = pairs.join(whole.select(F.col("class").alias("a"), F.col("tokens").alias("x")), "a").join(whole.select(F.col("class").alias("b"), F.col("tokens").alias("y")), "b")

    def compare(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(t, s), len(t) - 1)
                common = int((t[at] == s).sum())
                ok.append(100 * common >= PERCENT * (len(s) + len(t) - common))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(tidy(compare), "a bigint, b bigint")


def _only_stars(links: DataFrame) -> bool:
    """Whether no node has two smaller neighbours, or one and larger ones too: then each links straight to its component's least."""
    ends = links.select(F.col("hi").alias("node"), F.lit(1).alias("smaller"), F.lit(0).alias("larger")).union(links.select("lo", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("smaller").alias("smaller"), F.max("larger").alias("larger")).filter("smaller > 0 and smaller + larger > 1").count() == 0


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node of each node's component, by alternating large and small stars until there are only stars."""
    now = materialise(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi <> lo").distinct(), "links")
    while not _only_stars(now):
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")).select("e.*")
        now = materialise(small.filter("hi <> lo").distinct(), "links")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(now.select("lo", "lo").distinct())


def class_components(docs: DataFrame, key: str, text: str, with_links: bool = True) -> tuple[DataFrame, DataFrame]:
    """Of each row: doc_id, n, class. Of each class: class, least_id, root (the component's least class), component_id, n_links (null unless asked for)."""
    seen = materialise(scan(docs, key, text), "scan")
    nodes = seen.filter("n is not null").select("doc_id", "n", "class", "check")
    same = F.when(F.min("check") == F.max("check"), F.max("n")).otherwise(F.raise_error(F.lit("two sets have the same 64-bit hash")))
    classes = materialise(nodes.filter("n > 0").groupBy("class").agg(F.min("doc_id").alias("least_id"), same.cast("bigint").alias("n")), "classes")
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(seen))

    shared = materialise(shared_only(index_rows(docs, frequent, key, text)), "signatures")
    frequent.destroy()
    # some class of the group must be the smaller one of a pair, by its short part
    useful = shared.groupBy("signature").agg(F.max("short").alias("any"), F.min(F.when(F.col("short"), F.col("n"))).alias("least"))
    useful = useful.filter("any").select("signature", "least")
    shared = materialise(shared.join(useful, "signature").filter(F.col("n") >= F.col("least")).drop("least"), "signatures")
    own = own_shingles(texts_of(shared.select("class").distinct(), classes, docs, key, text))
    rows = shared.join(own, "class", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    # a class that has too many shingles of its own for any partner leaves
    rows = materialise(rows.filter((F.col("n") - F.col("own")) * 100 >= F.col("n") * PERCENT), "groups")
    about = ["class", "n", "own", "short"]
    member = F.struct(*about).alias("y")

    # stars
    centre = rows.groupBy("signature").agg(F.min_by(F.struct(*about), F.struct((F.col("own") / F.col("n")).alias("own"), F.col("class").alias("c"))).alias("x"))
    stars = rows.select("signature", member).join(centre, "signature").filter("x.class <> y.class").filter(_possible("x", "y"))
    first = materialise(stars.select(F.col("x.class").alias("a"), F.col("y.class").alias("b")).distinct(), "pairs")
    links = materialise(verify(first, classes, docs, key, text), "verified")

    # what is still apart within a group
    root = components(links)
    placed = rows.join(root.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    placed = materialise(placed, "placed")
    sizes = placed.groupBy("signature", "root").agg(F.count("*").alias("size"))
    main = sizes.groupBy("signature").agg(F.count("*").alias("roots"), F.max_by("root", F.struct("size", "root")).alias("main")).filter("roots > 1").drop("roots")
    mixed = materialise(placed.join(main, "signature"), "mixed")
    links = materialise(links.union(verify_blocks(mixed, classes, docs, key, text)), "verified")

    root = components(links)
    placed = materialise(classes.join(root.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class")), "placed")
    names = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_class = placed.join(names, "root")
    if with_links:
        of_class = of_class.join(count_links(placed, classes, docs, key, text), "class", "left")
    links = F.coalesce("n_links", F.lit(0)) if with_links else F.lit(None).cast("bigint")
    of_class = materialise(of_class.select("class", "least_id", "root", "component_id", links.alias("n_links")), "components")
    return nodes.select("doc_id", "n", "class"), of_class


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, n_links (linked classes of the row's class) of each row."""
    nodes, of_class = class_components(docs, key, text)
    some = nodes.filter("n > 0").join(of_class, "class").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links")
    none = nodes.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("bigint").alias("n_links"))
    return some.union(none)


def with_class(docs: DataFrame, text: str, name: str) -> DataFrame:
    """``docs`` and the class of each text as column ``name``; null for an empty set."""

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                cls = [_class_of(s)[0] if len(s) else None for s in sets_of(batch.column(names.index(text)))]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cls, pa.int64())], names=[*names, name])

    names = docs.columns
    return docs.mapInArrow(tidy(run), StructType([*docs.schema.fields, StructField(name, LongType())]))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when one row of each component does, that of the least (id, class); all columns.

    Each row is judged by its own text, also when its id is null (null ids come last) or repeated. Of rows
    that repeat both, one stays. Texts with an empty set link with nothing, so all of their rows stay.
    Most texts are told by a part of their id that no removed id has, and needn't be shuffled. Columns
    that are added on the way take names that ``docs`` doesn't have.
    """
    taken = {c.lower() for c in docs.columns}

    def free(name: str) -> str:
        while name in taken:
            name += "_"
        return name

    c_key, c_part, c_word, c_bits, c_rows, c_touched, c_class, c_id, c_of = map(free, ("_key", "_part", "_word", "_bits", "_rows", "_touched", "_class", "_id", "_of"))
    own = [F.col(f"`{c}`") for c in docs.columns]
    nodes, of_class = class_components(docs, key, text, with_links=False)
    first = F.min(F.struct(F.col("least_id").isNull().alias("none"), F.col("least_id"), F.col("class"))).alias("k")
    keepers = materialise(of_class.groupBy("root").agg(first).select(F.col("k.least_id").alias(c_id), F.col("k.class").alias(c_of)), "keepers")
    stays = (F.col("n") == 0) | (F.col(c_of).isNotNull() & F.col("doc_id").eqNullSafe(F.col(c_id)))
    counts = nodes.join(keepers, F.col("class") == F.col(c_of), "left").groupBy("doc_id").agg(F.count("*").alias("rows"), F.min(stays).alias("stays"))
    touched = materialise(counts.filter("rows > 1 or not stays"), "touched")
    part = lambda c: F.pmod(F.xxhash64(c), F.lit(PICKED_PARTS)).alias(c_part)
    rows = docs.withColumn(c_key, F.col(key).cast("bigint")).withColumn(c_part, part(c_key))
    bits = F.broadcast(part_bits(touched.select(part("doc_id")), c_part).select(F.col("word").alias(c_word), F.col("bits").alias(c_bits)))
    rows = rows.join(bits, F.shiftright(c_part, 6) == F.col(c_word), "left")
    clear = rows.filter(~_has_bit(c_bits, c_part)).select(*own)
    near = rows.filter(_has_bit(c_bits, c_part))
    table = touched.select(F.col("doc_id").alias(c_touched), F.col("rows").alias(c_rows))
    near = near.join(table, F.col(c_key).eqNullSafe(F.col(c_touched)), "left")
    single = near.filter(F.col(c_rows).isNull()).select(*own)
    repeated = with_class(near.filter(F.col(c_rows) > 1).select(*own, c_key), text, c_class)
    empty = repeated.filter(F.col(c_class).isNull()).select(*own)
    chosen = repeated.join(keepers, F.col(c_key).eqNullSafe(F.col(c_id)) & (F.col(c_class) == F.col(c_of)), "left_semi")
    return clear.union(single).union(empty).union(chosen.dropDuplicates([c_key, c_class]).select(*own))
