"""Prefix trie of conversations, built from blocks of turns before single turns.

A conversation becomes an array of turn digests. Its blocks of ``BLOCK`` turns
(the last one may be shorter) get chained digests: that of a block covers all
turns up to the block's end. Conversations are first grouped by block digest,
so that copies and long common prefixes shrink to one row a block before any
turn is looked at. Under a digest with a single next block nothing diverges:
that block's turns are a chain with the block's own members. Only where
sibling blocks diverge are their turn boundaries refined, by grouping the
distinct blocks (not the conversations) by the turns they begin with.

What belongs to a subtree is a sum over member conversations, so no tree is
walked and no level waits for another. Each node is owned by its smallest
member; a conversation owns the nodes from some depth on. A first grouping
gives each node's owner, a second one adds, for each member, its turns' words
from the node's depth on, those of its own nodes among them, whether it ends in
an own childless node, and whether it owns a child of the node.

Sums, minima and maxima are combined before each shuffle, so copies of a
conversation, however many, are no hot group. Rows that meet a hot parent are
joined by broadcast: at most ``HOT_PARENTS`` parents can have more than one row
in so many. Texts are digested where they are read and not shuffled. One row is
a conversation's digests, bounded by its length.

Defined cases: rows without a conversation id are left out; null role or text
is empty, a null turn number comes first; turns of equal number are ordered by
role, then by digest; equal rows are turns of their own. Conversations of any
length are whole. An empty table gives an empty table (without a root). Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuescope.llm.common import let_workers_import, materialise

#: Turns of a block.
BLOCK = 4
#: A key that holds more than one row in so many is hot; there are fewer of them than this.
HOT_PARENTS = 1000
#: Conversation ids that are joined to one text before the ids of a node are put together.
ID_RANGE = 4096
#: Blocks that are handed on together.
BATCH_ROWS = 4096
#: Digest of the empty prefix.
ROOT = ""

_WORD = r"[^\x20\x09-\x0D]+"


def turn_digest(role: Column, text: Column) -> Column:
    """Digest of a turn; the role's length keeps (role, text) apart."""
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))


def conversations(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """conv_id and its ordered turns: array of (digest, words)."""
    rows = turns.filter(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("conv_id", F.struct("turn", "role", turn_digest(F.col("role"), F.col("text")).alias("digest"), F.regexp_count("text", F.lit(_WORD)).cast("bigint").alias("words")).alias("t"))
    ordered = F.sort_array(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns"))


def share_openings(convs: DataFrame, span: int = 20, choices: int = 4) -> DataFrame:
    """Each conversation c with the first h turns of conversation c - c % span in place of its own; h = crc32(c) % choices.

    An opening is short and goes to at most ``span`` conversations.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % choices).cast("int")
    own = convs.select("conv_id", (F.col("conv_id") - F.col("conv_id") % span).alias("_from"), h.alias("_h"), "turns")
    openings = convs.filter(F.col("conv_id") % span == 0).select(F.col("conv_id").alias("_from"), F.slice("turns", 1, choices - 1).alias("_opening"))
    none = F.array().cast(convs.schema["turns"].dataType)
    opening = F.slice(F.coalesce("_opening", none), F.lit(1), F.col("_h"))
    rest = F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns") - F.col("_h"), F.lit(0)))
    return own.join(openings, "_from", "left").select("conv_id", F.concat(opening, rest).alias("turns"))


def _blocks(convs: DataFrame) -> DataFrame:
    """One row a block: conv_id, n (turns of the conversation), above and key (digests up to the block's start and end),
    first (turns above), part (its turns), below (words from each of its turns to the conversation's end).

    A conversation without turns has one row, an empty block at the root.
    """
    let_workers_import(convs.sparkSession)

    def cut(batches):
        for batch in batches:
            rows = []
            for conv, turns in zip(batch.column("conv_id").to_pylist(), batch.column("turns").to_pylist()):
                after = list(accumulate((t["words"] for t in reversed(turns)), initial=0))[::-1]
                above = ROOT
                for first in range(0, len(turns), BLOCK) if turns else [0]:
                    part = turns[first : first + BLOCK]
                    key = hashlib.sha256(above.encode() + b"".join(t["digest"] for t in part)).hexdigest() if part else ROOT
                    rows.append({"conv_id": conv, "n": len(turns), "above": above, "key": key, "first": first, "part": part, "below": after[first : first + len(part)]})
                    above = key
                    if len(rows) == BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
            yield pa.RecordBatch.from_pylist(rows, schema)

    part = pa.list_(pa.struct([("digest", pa.binary()), ("words", pa.int64())]))
    schema = pa.schema([("conv_id", pa.int64()), ("n", pa.int64()), ("above", pa.string()), ("key", pa.string()), ("first", pa.int64()), ("part", part), ("below", pa.list_(pa.int64()))])
    return convs.select("conv_id", "turns").mapInArrow(cut, "conv_id bigint, n bigint, above string, key string, first bigint, part array<struct<digest: binary, words: bigint>>, below array<bigint>")


def _join_many_to_one(rows: DataFrame, one: DataFrame, key: str, sizes: DataFrame) -> DataFrame:
    """``rows`` left-joined with ``one`` (one row a key); keys with more than 1 / HOT_PARENTS of the rows are broadcast.

    ``sizes`` has key and n, the number of ``rows`` of each key.
    """
    total = sizes.agg(F.sum("n").alias("_total"))
    hot = sizes.join(F.broadcast(total)).filter(F.col("n") * HOT_PARENTS > F.col("_total")).select(key)
    hot = materialise(hot.join(one, key), "hot")  # fewer than HOT_PARENTS rows
    mark = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    value = [c for c in one.columns if c != key]
    met = rows.join(mark, key, "left")
    by_broadcast = met.filter("_hot").drop("_hot")
    by_shuffle = met.filter("_hot is null").drop("_hot", *value).join(one, key, "left")
    return by_broadcast.unionByName(by_shuffle)


def _divergence(blocks: DataFrame) -> DataFrame:
    """Distinct blocks: above, key, part, first, and diverges (whether ``above`` has another next block)."""
    distinct = materialise(blocks.groupBy("above", "key").agg(F.any_value("part").alias("part"), F.any_value("first").alias("first")), "blocks")
    siblings = distinct.groupBy("above").agg(F.count(F.lit(1)).alias("n"))
    marked = _join_many_to_one(distinct.select("above", "key", "part", "first"), siblings.select("above", F.col("n").alias("_n")), "above", siblings)
    return marked.select("above", "key", "part", "first", (F.col("_n") > 1).alias("diverges"))


def _turn_key(above: Column, part: Column, j: Column) -> Column:
    """Digest of the prefix that ends with turn ``j`` of a block; equal for all siblings that begin so."""
    return F.when(j == 0, above).otherwise(F.sha2(F.concat(above, F.lit("/"), F.array_join(F.transform(F.slice(part, F.lit(1), j), lambda t: F.hex(t["digest"])), "")).cast("binary"), 256))


def _by_node(blocks: DataFrame, distinct: DataFrame, measures: dict[str, tuple[str, Callable]]) -> DataFrame:
    """One row a node below the root: node (digest), above (its parent's), depth, words (of its last turn) and the measures.

    A measure is (sum, min or max, a function of the turn's place j in its block, 1 first). Blocks are grouped whole;
    where siblings diverge, the grouped blocks are grouped again by the turns they begin with.
    """
    ways = {"sum": F.sum, "min": F.min, "max": F.max}
    whole = blocks.groupBy("key").agg(*(ways[how](of(j)).alias(f"_{name}{j}") for name, (how, of) in measures.items() for j in range(1, BLOCK + 1)))
    rows = distinct.join(whole, "key")
    turns = F.filter(F.array(*(F.struct(F.lit(j).alias("j"), *(F.col(f"_{name}{j}").alias(name) for name in measures)) for j in range(1, BLOCK + 1))), lambda t: t["j"] <= F.size("part"))
    rows = rows.select("key", "above", "part", "first", "diverges", F.explode(turns).alias("t"))
    # a full block's end is known by the block's own digest, under which the next block stands
    node = F.when(F.col("t.j") == BLOCK, F.col("key")).otherwise(_turn_key(F.col("above"), F.col("part"), F.col("t.j")))
    parent = _turn_key(F.col("above"), F.col("part"), F.col("t.j") - 1)
    rows = rows.select(node.alias("node"), parent.alias("above"), (F.col("first") + F.col("t.j")).alias("depth"), F.get("part", F.col("t.j") - 1)["words"].alias("words"), "diverges", *(F.col(f"t.{name}").alias(name) for name in measures))
    refined = rows.filter("diverges").groupBy("node").agg(*(F.any_value(c).alias(c) for c in ("above", "depth", "words")), *(ways[how](name).alias(name) for name, (how, _) in measures.items()))
    return rows.filter(~F.col("diverges")).drop("diverges").unionByName(refined)


def _ends(last: DataFrame) -> DataFrame:
    """Nodes in which conversations end, and ends_sha256 of their ids; ``last`` has conv_id and end, a conversation's last node.

    Ids are joined by ranges of ``ID_RANGE``; a task then reads a node's ranges in order and keeps nothing but the hash.
    """
    let_workers_import(last.sparkSession)
    ranges = last.groupBy("end", F.floor(F.col("conv_id") / ID_RANGE).alias("range")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    ranges = ranges.repartition("end").sortWithinPartitions("end", "range")

    def digests(batches):
        node, hashed, out = None, None, []
        for batch in batches:
            for end, ids in zip(batch.column("end").to_pylist(), batch.column("ids").to_pylist()):
                if end != node:
                    if hashed:
                        out.append((node, hashed.hexdigest()))
                    node, hashed = end, hashlib.sha256(ids.encode())
                else:
                    hashed.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], ["node", "ends_sha256"])
                out = []
        if hashed:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.string()), pa.array([hashed.hexdigest()], pa.string())], ["node", "ends_sha256"])

    return ranges.select("end", "ids").mapInArrow(digests, "node string, ends_sha256 string")


def trie(convs: DataFrame) -> DataFrame:
    """Nodes of the trie over ``convs`` (conv_id, turns): conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    saved_tokens adds, over the node's subtree, (members - 1) times the words of each node's last turn.
    """
    blocks = materialise(_blocks(convs), "turn-blocks")
    real = blocks.filter("n > 0")
    distinct = materialise(_divergence(real), "distinct-blocks")
    owned = materialise(_by_node(real, distinct, {"owner": ("min", lambda j: F.col("conv_id")), "n_convs": ("sum", lambda j: F.lit(1)), "longest": ("max", lambda j: F.col("n"))}), "nodes")
    # from which depth on a conversation owns its nodes, their words, and whether it ends in an own childless one
    own = owned.groupBy(F.col("owner").alias("conv_id")).agg(F.min("depth").alias("own_from"), F.sum("words").alias("own_words"), F.max((F.col("longest") == F.col("depth")).cast("int")).alias("leaf"))
    members = blocks.join(own, "conv_id", "left")
    depth, late = lambda j: F.col("first") + j, F.col("own_from")
    below = lambda j: F.get("below", F.lit(j - 1))
    sums = {
        "below": ("sum", below),
        "own_below": ("sum", lambda j: F.when(late.isNull(), 0).when(late <= depth(j), below(j)).otherwise(F.col("own_words"))),
        "n_leaves": ("sum", lambda j: F.coalesce("leaf", F.lit(0))),
        "n_children": ("sum", lambda j: F.when((late <= depth(j) + 1) & (depth(j) < F.col("n")), 1).otherwise(0)),
    }
    summed = _by_node(members.filter("n > 0"), distinct, sums).select("node", *sums)
    none = F.lit(None).cast("string")
    root = members.filter("first = 0").agg(F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.coalesce(below(1), F.lit(0))).alias("below"), F.sum(F.coalesce("own_words", F.lit(0))).alias("own_below"), F.sum("leaf").alias("n_leaves"), F.sum(F.when(late == 1, 1).otherwise(0)).alias("n_children"))
    root = root.filter("n_convs > 0").withColumn("n_leaves", F.coalesce("n_leaves", F.lit(1)))  # a root without children is a leaf
    root = root.select(F.lit(ROOT).alias("node"), none.alias("above"), F.lit(0).cast("bigint").alias("depth"), *root.columns)
    nodes = materialise(owned.drop("longest", "words").join(summed, "node").select(*root.columns).unionByName(root), "summed-nodes")
    inner = nodes.filter("n_children > 0")
    parents = inner.select(F.col("node").alias("above"), F.col("owner").alias("parent_conv_id"))
    linked = _join_many_to_one(nodes.filter("depth > 0"), parents, "above", inner.select(F.col("node").alias("above"), F.col("n_children").alias("n")))
    linked = linked.unionByName(nodes.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint")))
    size = F.size("part")
    last = blocks.filter(F.col("first") + size == F.col("n")).select("conv_id", F.when((size == BLOCK) | (size == 0), F.col("key")).otherwise(_turn_key(F.col("above"), F.col("part"), size)).alias("end"))
    empty = hashlib.sha256().hexdigest()
    return linked.join(_ends(last), "node", "left").select(
        F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("below") - F.col("own_below")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256")
    )
