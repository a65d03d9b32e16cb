"""op11 against a brute-force trie."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from valuescope.llm import conversation_trie as ct

SCHEMA = "conv_id long, turn long, role string, text string"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append((t is not None, t or 0, r or "", x or ""))
    for c in by:
        by[c].sort(key=lambda q: (q[0], q[1], q[2], hashlib.sha256(f"{len(q[2])}:{q[2]}{q[3]}".encode()).digest()))
    seqs = {}
    for c in by:
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = [(q[2], q[3]) for q in by.get(c - c % 20, [])[:h] + by[c][h:]]
    members, kids, done, out = defaultdict(list), defaultdict(list), {}, []
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    for node in sorted(members, key=len, reverse=True):
        m, k = members[node], kids[node]
        leaves = sum(done[x][0] for x in k) if k else 1
        saved = sum(done[x][1] for x in k) + ((len(m) - 1) * len(_WORD.findall(node[-1][1])) if node else 0)
        done[node] = (leaves, saved)
        ends = ",".join(map(str, sorted(c for c in m if len(seqs[c]) == len(node))))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(k), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def run(df):
    out = ct.trie(ct.share_openings(ct.conversations(df)))
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=lambda r: r[:2])


def _rows(seed, convs):
    rng, rows = random.Random(seed), []
    for c in range(convs):
        for k in range(rng.choice([0, 1, 1, 2, 3, 4, 5, 8, 9, 13])):
            rows.append((c, rng.choice([k, k, k, None]), rng.choice(["user", "assistant", None]), rng.choice(["a b", "a b", "c", None, ""])))
        if c % 7 == 0:
            rows += [(c, 1, "user", "a b")] * 2  # repeated rows are turns of their own
    return [r for r in rows if r[0] != 40] + [(None, 1, "user", "x")]  # 41 to 59 have no opening


def test_equals_brute_force(spark):
    rows = _rows(3, 120)
    got = run(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows)
    assert got[0][2] is None and got[0][1] == 0 and sum(r[1] == 0 for r in got) == 1


def test_copies_shared_openings_and_long_conversations(spark):
    rows = [(c, k, "user", f"t{k}") for c in range(400) for k in range(5)]  # copies of one conversation
    rows += [(1000 + c, k, "user", f"t{k}" if k < 6 else f"{c}") for c in range(60) for k in range(8)]  # diverge in a block
    rows += [(2000, k, "user", f"w w{k % 3}") for k in range(900)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_small_blocks_and_hot_parents(spark, monkeypatch):
    rows = _rows(5, 80)
    df, want = spark.createDataFrame(rows, SCHEMA), brute(rows)
    for block, hot, ids in ((1, 3, 7), (2, 1000, 4096), (7, 2, 1)):
        monkeypatch.setattr(ct, "BLOCK", block)
        monkeypatch.setattr(ct, "HOT_PARENTS", hot)
        monkeypatch.setattr(ct, "ID_RANGE", ids)
        assert run(df) == want


def test_odd_tables(spark):
    df = spark.createDataFrame(_rows(1, 9), SCHEMA)
    assert run(df.limit(0)) == []
    assert run(df.filter("conv_id is null")) == []
    # a conversation whose few turns are all replaced by an absent opening has none: the root is the only node
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 >= 1)
    assert run(spark.createDataFrame([(c, 0, "user", "x")], SCHEMA)) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    extra = df
    for name in ("node", "above", "key", "depth", "n", "words", "turns", "digest", "owner"):
        extra = extra.withColumn(name, F.lit(1))
    assert run(extra) == run(df)
