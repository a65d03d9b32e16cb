"""Training-order materialisation: every sequence gets a global slot, and slots become fixed-stride shards.

Texts become token ids of a byte vocabulary (ids 0-255 are bytes, 256 ends a
document, 257 pads) cut into sequences of ``length`` ids. Sequences are written
once with their place in the writing task; the counts of the tasks give each
one a dense index 0 .. n - 1. A keyed Feistel network permutes the power of four
at or above n, and walking its cycle from an index until a value below n turns
up is a permutation of 0 .. n - 1: the sequence's slot. Nothing is sorted
globally and no table of the permutation exists; ``index_of`` inverts it.

Slots are dealt by range: shard s is the range s * shard_slots .. of slots and
the partition of that number, one task and one file, ``part-<s>``. Its rows stand in
the order of their slots, one row a slot, each with the same number of token bytes
(uint16, little endian; the stride is a row): slot k stands at row
k mod shard_slots of its file, byte k mod shard_slots * 2 * length of its token
column. Shards are Parquet files written through Spark's committer: lost
executors only repeat their tasks. ``read_from`` continues at any slot: it opens
no shard before the slot's, and in that one Parquet's statistics of the sorted
slots skip what stands before it. ``read_shard`` reads one shard in order.

Defined cases: a null text is an empty document, which is one sequence with
only the end id; long texts give as many sequences as they need; repeated rows
get slots of their own; an empty table writes no shard and reads back empty;
other columns are ignored. The index follows the input's task order, so two
inputs of other file layout get other orders from the same key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuescope.llm.common import shared_path

END, PAD = 256, 257
#: 512 MiB of ids a shard.
LENGTH, SHARD_SLOTS, KEY, FEISTEL_ROUNDS = 1024, 1 << 18, 20240101, 6
#: Multipliers of the 64-bit finaliser that mixes a half with its round's key (fixed values).
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
#: Odd constant that tells the rounds' keys apart (fixed value).
GOLDEN = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[1])
    return x ^ (x >> np.uint64(31))


def _round_keys(key: int) -> list[np.uint64]:
    return [_mix(np.array([(key + (r + 1) * GOLDEN) % (1 << 64)], np.uint64))[0] for r in range(FEISTEL_ROUNDS)]


def _half_bits(n: int) -> int:
    return max(1, -(-max(1, (n - 1).bit_length()) // 2))


def _network(x: np.ndarray, half: int, keys: list[np.uint64], back: bool) -> np.ndarray:
    mask, bits = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = x >> bits, x & mask
    for k in reversed(keys) if back else keys:
        if back:
            left, right = right ^ (_mix(left ^ k) & mask), left
        else:
            left, right = right, left ^ (_mix(right ^ k) & mask)
    return left << bits | right


def _walk(x: np.ndarray, n: int, key: int, back: bool) -> np.ndarray:
    half, keys = _half_bits(n), _round_keys(key)
    with np.errstate(over="ignore"):
        out = _network(x.astype(np.uint64), half, keys, back)
        while len(far := np.nonzero(out >= n)[0]):
            out[far] = _network(out[far], half, keys, back)
    return out.astype(np.int64)


def slot_of(index: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """Slots of indices below ``n``."""
    return _walk(np.asarray(index), n, key, False)


def index_of(slot: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """Indices of slots below ``n``."""
    return _walk(np.asarray(slot), n, key, True)


def write_shards(docs: DataFrame, path: str, key_column: str = "doc_id", text: str = "text", length: int = LENGTH, shard_slots: int = SHARD_SLOTS, key: int = KEY) -> int:
    """Writes the shards of ``docs`` under ``path``; returns the number of sequences."""
    spark = docs.sparkSession

    def cut(batches):
        task, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = {"task": [], "k": [], "doc_id": [], "chunk": [], "data": [], "ends": []}
            held = 0

            def flush():
                kinds = {"task": pa.int32(), "k": pa.int64(), "doc_id": pa.int64(), "chunk": pa.int64(), "data": pa.binary(), "ends": pa.bool_()}
                out = pa.RecordBatch.from_pydict({c: pa.array(v, kinds[c]) for c, v in rows.items()})
                for v in rows.values():
                    v.clear()
                return out

            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = (t.as_py() or "").encode("utf-8")
                n = len(data) // length + 1
                for c in range(n):
                    part = data[c * length : (c + 1) * length]
                    for name, v in zip(rows, (task, k, doc, c, part, c == n - 1)):
                        rows[name].append(v)
                    k += 1
                    held += len(part)
                    if held > 8 << 20:
                        yield flush()
                        held = 0
            yield flush()

    base = docs.select(F.col(key_column).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    made = shared_path(spark, "sequences")
    schema = "task int, k bigint, doc_id bigint, chunk bigint, data binary, ends boolean"
    base.mapInArrow(cut, schema).write.option("compression", "zstd").parquet(made)
    sequences = spark.read.schema(schema).parquet(made)

    # one row a writing task
    sizes = sorted((r["task"], r["n"]) for r in sequences.groupBy("task").agg(F.count("*").alias("n")).collect())
    offset, total = {}, 0
    for task, n in sizes:
        offset[task] = total
        total += n
    sent = spark.sparkContext.broadcast((offset, total))

    def place(batches):
        offset, total = sent.value
        for batch in batches:
            task = batch.column("task").to_numpy()
            index = batch.column("k").to_numpy() + np.array([offset[t] for t in task.tolist()], np.int64)
            slot = slot_of(index, total, key)
            yield pa.RecordBatch.from_arrays([pa.array(slot // shard_slots), pa.array(slot), *(batch.column(c) for c in ("doc_id", "chunk", "data", "ends"))], names=["shard", "slot", "doc_id", "chunk", "data", "ends"])

    placed = sequences.mapInArrow(place, "shard bigint, slot bigint, doc_id bigint, chunk bigint, data binary, ends boolean")

    def ids(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                data, ends = batch.column("data").to_pylist(), batch.column("ends").to_pylist()
                out = np.full((len(data), length), PAD, "<u2")
                for row, d, e in zip(out, data, ends):
                    row[: len(d)] = np.frombuffer(d, np.uint8)
                    if e:
                        row[len(d)] = END
                n = [len(d) + e for d, e in zip(data, ends)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("shard", "slot", "doc_id", "chunk")), pa.array(n, pa.int32()), pa.array([r.tobytes() for r in out], pa.binary())], names=["shard", "slot", "doc_id", "chunk", "n_tokens", "tokens"])

    # a shard's number is its partition's; a partition without rows writes no file
    shards = max(1, -(-total // shard_slots))
    ordered = placed.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("slot")
    ordered.mapInArrow(ids, SHARD_SCHEMA).write.option("compression", "zstd").parquet(path)
    return total


SHARD_SCHEMA = "shard bigint, slot bigint, doc_id bigint, chunk bigint, n_tokens int, tokens binary"


def _part(shard: int) -> str:
    return f"part-{shard:05d}-*"


def read_from(spark: SparkSession, path: str, slot: int = 0, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """Rows from ``slot`` on, in the order of slots: range partitions over what is left, each sorted."""
    rows = spark.read.schema(SHARD_SCHEMA).parquet(path)
    if slot > 0:
        number = F.regexp_extract(F.col("_metadata.file_name"), "^part-([0-9]+)-", 1).cast("bigint")
        rows = rows.filter((number >= slot // shard_slots) & (F.col("slot") >= slot))
    return rows.orderBy("slot")


def read_shard(spark: SparkSession, path: str, shard: int, skip: int = 0) -> DataFrame:
    """Rows of one shard as they stand in its file, without the first ``skip`` (from whole row groups and pages on)."""
    rows = spark.read.schema(SHARD_SCHEMA).option("pathGlobFilter", _part(shard)).parquet(path)
    return rows.filter(F.col("_metadata.row_index") >= skip) if skip else rows
