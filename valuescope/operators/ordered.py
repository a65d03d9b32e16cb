"""Distributed global order: row numbers, prefix sums, equal-count bins,
average ranks and exact quantiles without a single-task window.

``Window.orderBy(x)`` with no partitioning moves every row into one task.
Here the order key is cut into contiguous buckets instead:

1. count rows per group (one small aggregate, collected: #groups rows);
2. draw a bounded random sample of (key, tie) pairs per group and take
   evenly spaced sample points as bucket splits (collected once, then a
   literal table in the plan, so recomputation after executor loss gives
   the same buckets);
3. give each row the number of splits <= (key, tie) by binary search in a
   higher-order function (JVM-side, O(log B) per row);
4. where more than ``MAX_BUCKETS`` buckets are wanted, split each of these
   ranges again: a sample of every range is gathered and cut by the
   executors, range by range, and written before it is used;
5. aggregate count/sums per (group, bucket) -- a table of at most
   #groups x B rows, broadcast back -- and turn them into offsets;
6. number rows inside ``Window.partitionBy(group, bucket)`` and add offsets.

The splits are composite (key, tie), so one key value holding a third of
all rows is still spread over many buckets by the tie key.  Any splits
give an exact answer; the sample only balances the buckets.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuescope.functions import qbin
from valuescope.operators.common import attach_one_row

ROWS_PER_BUCKET = 2_000_000  # target rows per window task
MAX_BUCKETS = 4096  # of one level of splits
MAX_FINE_BUCKETS = 1 << 20  # of both levels: 2e12 rows at ROWS_PER_BUCKET; the splits' broadcast is bounded by it
MAX_GROUPS = 10_000  # groups are few by contract (segments, deciles, labels)
SAMPLE_PER_BUCKET = 64
SEED = 42


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _addend(c: Column, field: T.StructField) -> Column:
    """A decimal with room for one more digit, so that an addition keeps its scale."""
    t = field.dataType
    return c.cast(T.DecimalType(min(t.precision, 37), t.scale)) if isinstance(t, T.DecimalType) else c


def _splits_type(tie: T.DataType) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField("k", T.DoubleType()), T.StructField("t", tie)]))


def _splits(points: list[tuple], buckets: int) -> list[dict]:
    """Evenly spaced ones of the sampled (key, tie) points, without repeats, in order."""
    points = sorted(points)
    cuts = [points[(i * len(points)) // buckets] for i in range(1, buckets)] if points else []
    return [{"k": k, "t": t} for k, t in dict.fromkeys(cuts)]


def _bucket_of(splits: Column, longest: int) -> Column:
    """Number of ``splits`` (at most ``longest``) up to the row's (_k, _t), by binary search."""
    steps = max(1, math.ceil(math.log2(longest + 1)) + 1)

    def step(acc, _):
        mid = F.floor((acc["lo"] + acc["hi"] + 1) / 2).cast("int")
        s = F.try_element_at(splits, F.greatest(mid, F.lit(1)))
        le = (s["k"] < F.col("_k")) | ((s["k"] == F.col("_k")) & (s["t"] <= F.col("_t")))
        active = acc["lo"] < acc["hi"]
        le = F.coalesce(le, F.lit(False))
        return F.struct(
            F.when(active & le, mid).otherwise(acc["lo"]).alias("lo"),
            F.when(active & ~le, mid - 1).otherwise(acc["hi"]).alias("hi"),
        )

    init = F.struct(F.lit(0).alias("lo"), F.size(splits).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, step)["lo"]


def _sampled(d: DataFrame, fractions: dict) -> DataFrame:
    """(_g, _k, _t) of a random share of the rows of each group named; other groups have none."""
    share = F.lit(0.0)
    for g, f in fractions.items():
        share = F.when(F.col("_g").eqNullSafe(F.lit(g)), F.lit(f)).otherwise(share)
    return d.filter(F.rand(SEED) < share)


def _coarse_buckets(d: DataFrame, sizes: dict, buckets: dict) -> DataFrame:
    """Adds ``_b``: at most ``buckets[g]`` contiguous ranges of (_k, _t) in group g, cut at sampled points."""
    fractions = {g: min(1.0, SAMPLE_PER_BUCKET * b / sizes[g]) for g, b in buckets.items() if b > 1}
    if not fractions:
        return d.withColumn("_b", F.lit(0))
    by_g: dict = {}
    for r in _sampled(d, fractions).select("_g", "_k", "_t").collect():  # about SAMPLE_PER_BUCKET * buckets rows a group
        by_g.setdefault(r["_g"], []).append((r["_k"], r["_t"]))
    split_rows = [(g, _splits(points, buckets[g])) for g, points in by_g.items()]
    schema = T.StructType([T.StructField("_sg", d.schema["_g"].dataType), T.StructField("_splits", _splits_type(d.schema["_t"].dataType))])
    splits = d.sparkSession.createDataFrame(split_rows, schema)
    arr = F.coalesce(F.col("_splits"), F.array().cast(schema["_splits"].dataType))
    bucket = _bucket_of(arr, max((len(s) for _, s in split_rows), default=0))
    d = d.join(F.broadcast(splits), F.col("_g").eqNullSafe(F.col("_sg")), "left")
    return d.withColumn("_b", bucket).drop("_splits", "_sg")


def _fine_buckets(d: DataFrame, fractions: dict, parts: int) -> DataFrame:
    """Cuts each range ``_b`` of the groups named into at most ``parts``.

    Each range's sample is cut where it is gathered. The splits (fewer than
    ``MAX_FINE_BUCKETS`` a group) are checkpointed, so that a recomputed task meets the same
    ones, and broadcast.
    """
    from valuescope.session import checkpoint_dir

    checkpoint_dir(d.sparkSession)
    points = F.array_sort(F.collect_list(F.struct(F.col("_k").alias("k"), F.col("_t").alias("t"))))
    gathered = _sampled(d, fractions).groupBy("_g", "_b").agg(points.alias("_points"))
    at = F.sequence(F.lit(1), F.lit(parts - 1))
    cuts = F.array_distinct(F.transform(at, lambda i: F.get("_points", F.floor(i * F.size("_points") / parts).cast("int"))))
    splits = gathered.select(F.col("_g").alias("_sg"), F.col("_b").alias("_sb"), cuts.alias("_splits")).checkpoint(eager=True)
    d = d.join(F.broadcast(splits), F.col("_g").eqNullSafe(F.col("_sg")) & (F.col("_b") == F.col("_sb")), "left")
    arr = F.coalesce(F.col("_splits"), F.array().cast(_splits_type(d.schema["_t"].dataType)))
    return d.withColumn("_b", F.col("_b") * parts + _bucket_of(arr, parts - 1)).drop("_splits", "_sg", "_sb")


def _bucketed(df: DataFrame, key, tie, group, rows_per_bucket: int | None) -> DataFrame:
    """``df`` with _k (the key), _t (the tie), _g (the group) and _b, the row's bucket in the order (_k, _t) of its group."""
    rows_per_bucket = rows_per_bucket or ROWS_PER_BUCKET
    g = _col(group) if group is not None else F.lit(0)
    d = df.withColumn("_k", _col(key).cast("double")).withColumn("_t", _col(tie)).withColumn("_g", g)
    counts = d.groupBy("_g").agg(F.count(F.lit(1)).alias("_n")).limit(MAX_GROUPS + 1).collect()
    if len(counts) > MAX_GROUPS:
        raise ValueError(f"global_order: more than {MAX_GROUPS} groups; use a partitioned window instead")
    sizes = {r["_g"]: r["_n"] for r in counts}
    wanted = {g: max(1, min(MAX_FINE_BUCKETS, math.ceil(c / rows_per_bucket))) for g, c in sizes.items()}
    # more than MAX_BUCKETS: about the square root of them on either level
    coarse = {g: b if b <= MAX_BUCKETS else math.ceil(math.sqrt(b)) for g, b in wanted.items()}
    fine = max((math.ceil(wanted[g] / coarse[g]) for g in wanted), default=1)
    d = _coarse_buckets(d, sizes, coarse)
    if fine > 1:
        d = _fine_buckets(d, {g: min(1.0, SAMPLE_PER_BUCKET * wanted[g] / sizes[g]) for g in sizes if wanted[g] > coarse[g]}, fine)
    return d


def global_order(
    df: DataFrame,
    key,
    tie="customer_id",
    descending: bool = False,
    group=None,
    sums: dict | None = None,
    rn: str = "rn",
    n: str | None = "n",
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Append a 1-based row number ``rn`` in (key, tie) order within ``group``.

    ``key`` must be non-NULL numeric.  ``tie`` breaks ties (ascending, also
    when ``descending``).  ``sums`` maps output names to Columns whose
    inclusive running sums in that order are appended.  ``n`` (if given)
    receives the group's row count.  Rows of a NULL group form a group of their own.
    ``rows_per_bucket`` only sets how many rows a window task takes.
    """
    sums = sums or {}
    k = _col(key).cast("double")
    for name, c in sums.items():
        df = df.withColumn(f"_s_{name}", c)
    d = _bucketed(df, -k if descending else k, tie, group, rows_per_bucket)

    # per-(group, bucket) totals -> offsets; at most #groups x (buckets) rows
    aggs = [F.count(F.lit(1)).alias("_c")] + [F.sum(f"_s_{s}").alias(f"_bs_{s}") for s in sums]
    stats = d.groupBy("_g", "_b").agg(*aggs)
    wb = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    off_cols = [F.coalesce(F.sum("_c").over(wb), F.lit(0)).alias("_oc")]
    for s in sums:
        zero = F.lit(0).cast(stats.schema[f"_bs_{s}"].dataType)
        off_cols.append(F.coalesce(F.sum(f"_bs_{s}").over(wb), zero).alias(f"_os_{s}"))
    tot = Window.partitionBy("_g")
    offsets = stats.select(F.col("_g").alias("_og"), F.col("_b").alias("_ob"), *off_cols, F.sum("_c").over(tot).alias("_n"))
    d = d.join(F.broadcast(offsets), F.col("_g").eqNullSafe(F.col("_og")) & (F.col("_b") == F.col("_ob")), "inner")

    w = Window.partitionBy("_g", "_b").orderBy("_k", "_t")
    wr = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = d.withColumn(rn, (F.col("_oc") + F.row_number().over(w)).cast("bigint"))
    for s in sums:
        out = out.withColumn(s, _addend(F.col(f"_os_{s}"), stats.schema[f"_bs_{s}"]) + _addend(F.sum(f"_s_{s}").over(wr), stats.schema[f"_bs_{s}"]))
    if n:
        out = out.withColumn(n, F.col("_n").cast("bigint"))
    drop = ["_k", "_t", "_g", "_b", "_og", "_ob", "_oc", "_n"] + [f"_s_{s}" for s in sums] + [f"_os_{s}" for s in sums]
    return out.drop(*drop)


def quantile_cuts(df: DataFrame, keys: list, q: int, tie="customer_id", rows_per_bucket: int | None = None) -> DataFrame:
    """One row of (key, tie) structs ``_c{i}_{b}``: the row that ends bin b (1..q-1) in the order of the i-th key.

    Bin b of n rows ends at rank floor(b (n - 1) / q) + 1. Counts by bucket (at
    most #keys x MAX_BUCKETS numbers) tell which bucket holds that rank; only
    those buckets' rows are numbered. All keys go through one pass.
    """
    rows_per_bucket = rows_per_bucket or ROWS_PER_BUCKET
    names = [f"_k{i}" for i in range(len(keys))]
    d = df.select(_col(tie).alias("_t"), *[_col(k).cast("double").alias(n) for k, n in zip(keys, names)])
    n = d.count()
    buckets = max(1, min(MAX_BUCKETS, math.ceil(n / rows_per_bucket)))
    rows = d.select("_t", F.posexplode(F.array(*names)).alias("_i", "_k"))
    if buckets == 1:
        rows = rows.withColumn("_b", F.lit(0))
        counts = {i: {0: n} for i in range(len(keys))}
    else:
        sample = d.filter(F.rand(SEED) < min(1.0, SAMPLE_PER_BUCKET * buckets / n)).collect()  # about SAMPLE_PER_BUCKET * buckets
        split_rows = [(i, _splits([(r[c], r["_t"]) for r in sample], buckets)) for i, c in enumerate(names)]
        schema = T.StructType([T.StructField("_si", T.IntegerType()), T.StructField("_splits", _splits_type(d.schema["_t"].dataType))])
        splits = df.sparkSession.createDataFrame(split_rows, schema)  # one row a key
        rows = rows.join(F.broadcast(splits), F.col("_i") == F.col("_si"))
        rows = rows.select("_t", "_i", "_k", _bucket_of(F.col("_splits"), buckets).alias("_b"))
        counts = {i: {} for i in range(len(keys))}
        for r in rows.groupBy("_i", "_b").agg(F.count(F.lit(1)).alias("n")).collect():
            counts[r["_i"]][r["_b"]] = r["n"]

    places = {}  # (key, bin) -> (bucket, rank in the bucket)
    for i, by_bucket in counts.items():
        for b in range(1, q):
            rank = b * max(n - 1, 0) // q + 1
            for bucket in sorted(by_bucket):
                if rank <= by_bucket[bucket]:
                    places[i, b] = (bucket, rank)
                    break
                rank -= by_bucket[bucket]
    needed = sorted({(i, bucket) for (i, _), (bucket, _) in places.items()})
    holds = reduce(lambda a, b: a | b, [(F.col("_i") == i) & (F.col("_b") == b) for i, b in needed], F.lit(False))
    w = Window.partitionBy("_i", "_b").orderBy("_k", "_t")
    numbered = rows.filter(holds).withColumn("_r", F.row_number().over(w))

    def end(i: int, b: int) -> Column:
        bucket, rank = places.get((i, b), (-1, -1))
        here = (F.col("_i") == i) & (F.col("_b") == bucket) & (F.col("_r") == rank)
        return F.max(F.when(here, F.struct(F.col("_k").alias("k"), F.col("_t").alias("t")))).alias(f"_c{i}_{b}")

    return numbered.agg(*[end(i, b) for i in range(len(keys)) for b in range(1, q)])


def quantile_bins(df: DataFrame, keys: dict, q: int, tie="customer_id", **kw) -> DataFrame:
    """W1+W2 for several orders at once: ``keys`` maps new columns to the keys whose equal-count bin (1..q) they take.

    Same bins as ``quantile_bin``, but by comparing with q - 1 cut points a key, one
    broadcast row: ``df`` itself is not numbered or shuffled. Keys must not be NULL;
    ``tie`` tells rows apart.
    """
    cuts = quantile_cuts(df, list(keys.values()), q, tie, **kw)
    t = _col(tie)

    def bin_of(i: int, key) -> Column:
        k = _col(key).cast("double")
        ends = [F.col(f"_c{i}_{b}") for b in range(1, q)]
        past = [F.coalesce(((k > e["k"]) | ((k == e["k"]) & (t > e["t"]))).cast("int"), F.lit(0)) for e in ends]
        return reduce(lambda a, b: a + b, past, F.lit(1)).cast("int")

    binned = attach_one_row(df, cuts)  # a global aggregate: 1 row
    return binned.withColumns({out: bin_of(i, key) for i, (out, key) in enumerate(keys.items())}).drop(*cuts.columns)


def quantile_bin(
    df: DataFrame, key, q: int, out: str, tie="customer_id", descending=False, group=None, **kw
) -> DataFrame:
    """W1+W2: rank (ties by ``tie``) then equal-count bin 1..q (not ``ntile``)."""
    o = global_order(df, key, tie=tie, descending=descending, group=group, rn="_rn", n="_nn", **kw)
    return o.withColumn(out, qbin("_rn", "_nn", q)).drop("_rn", "_nn")


def average_rank(df: DataFrame, value: str, out: str, group=None, rows_per_bucket: int | None = None) -> DataFrame:
    """Rank with ties sharing the mean of their positions (1-based); rows of NULL ``value`` are left out.

    Values are compared as doubles. Rows are ordered by (value, row hash) over buckets. Inside a bucket a value's
    first position and count come from the bucket's own window; a value
    that goes on into the next bucket stands at the bucket's edge, and the
    few such values (fewer than buckets) get their first position and count from the
    buckets' counts, broadcast. Nothing is joined on the value, and a value of a
    third of all rows is spread over many buckets.
    """
    d = df.filter(F.col(value).isNotNull())
    d = _bucketed(d, value, F.xxhash64(*df.columns), group, rows_per_bucket)
    stats = d.groupBy("_g", "_b").agg(F.count(F.lit(1)).alias("_c"), F.min("_k").alias("_lo"), F.max("_k").alias("_hi"))
    wb = Window.partitionBy("_g").orderBy("_b")
    stats = stats.select("_g", "_b", "_lo", "_hi", F.coalesce(F.sum("_c").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_oc"),
                         F.lead("_lo").over(wb).alias("_next"))
    # values that cross an edge; their rows are counted by bucket
    crossing = stats.filter(F.col("_hi") == F.col("_next")).select(F.col("_g").alias("_eg"), F.col("_hi").alias("_ek")).distinct()
    same_value = F.col("_g").eqNullSafe(F.col("_eg")) & (F.col("_k") == F.col("_ek"))
    runs = d.join(F.broadcast(crossing), same_value).groupBy("_g", "_b", "_k").agg(F.count(F.lit(1)).alias("_c"))
    offsets = stats.select(F.col("_g").alias("_og"), F.col("_b").alias("_ob"), "_oc")
    same_bucket = F.col("_g").eqNullSafe(F.col("_og")) & (F.col("_b") == F.col("_ob"))
    # the run ends its first bucket, so it begins that many rows before the next bucket's offset
    ends = stats.select(F.col("_g").alias("_og"), F.col("_b").alias("_ob"), F.coalesce(F.lead("_oc").over(wb), F.lit(0)).alias("_end"))
    runs = runs.join(F.broadcast(ends), same_bucket).groupBy(F.col("_g").alias("_eg"), F.col("_k").alias("_ek")).agg(
        F.min_by(F.col("_end") - F.col("_c"), "_b").alias("_before"), F.sum("_c").alias("_run"))
    d = d.join(F.broadcast(offsets), same_bucket, "inner").join(F.broadcast(runs), same_value, "left")
    inside = Window.partitionBy("_g", "_b")
    before = F.coalesce("_before", F.col("_oc") + F.rank().over(inside.orderBy("_k")) - 1)
    run = F.coalesce("_run", F.count(F.lit(1)).over(Window.partitionBy("_g", "_b", "_k")))
    return d.select(*[F.col(f"`{c}`") for c in df.columns], (before + (run + 1) / 2.0).alias(out))


def exact_quantiles(df: DataFrame, value: str, probs: list[float], group: str | None = None,
                    prefix: str = "q", **kw) -> DataFrame:
    """Exact linear-interpolation quantiles (numpy's default rule) per group.

    Values are first collapsed to (value, count), so a value repeated in a
    third of all rows is one row; the distinct values are then ordered with
    ``global_order`` and each probability picks its two neighbouring order
    statistics from the running counts.  No group is gathered in one task.
    One row per group; columns named by ``_qname(prefix, p)``.
    """
    gcols = [group] if group else []
    src = df.filter(F.col(value).isNotNull())
    dv = src.groupBy(*gcols, value).agg(F.count(F.lit(1)).cast("bigint").alias("_cnt"))
    o = global_order(dv, value, tie=value, group=group, sums={"_cum": F.col("_cnt")},
                     rn="_rn", n=None, **kw)
    tot = dv.groupBy(*gcols).agg(F.sum("_cnt").alias("_nn"))  # #groups rows
    if group:
        tot = tot.withColumnRenamed(group, "_tg")
        o = o.join(F.broadcast(tot), F.col(group).eqNullSafe(F.col("_tg")), "inner").drop("_tg")
    else:
        o = o.join(F.broadcast(tot), how="inner")
    aggs = []
    first = F.col("_cum") - F.col("_cnt")  # rows before this value
    for p in probs:
        pos = F.lit(float(p)) * (F.col("_nn") - 1) + 1  # 1-based fractional position
        lo = F.floor(pos)
        hi = F.least(lo + 1, F.col("_nn"))
        at_lo = F.max(F.when((first < lo) & (lo <= F.col("_cum")), F.col(value)))
        at_hi = F.max(F.when((first < hi) & (hi <= F.col("_cum")), F.col(value)))
        fr = F.max(pos - lo)
        aggs.append((at_lo + (at_hi - at_lo) * fr).alias(_qname(prefix, p)))
    return o.groupBy(*gcols).agg(*aggs)


def _qname(prefix: str, p: float) -> str:
    s = f"{p * 100:g}".replace(".", "_")
    return f"{prefix}{s}"
