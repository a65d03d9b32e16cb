"""Quality rules with risk-controlled thresholds, in DataFrame operations only.

Each rule rejects a text whose measure exceeds a cutoff; which cutoffs are in
force is chosen per stratum (the recorded language) on labelled texts, equal
texts counting once:

- one half of them (by digest) orders the cells, pairs of a rule and a cutoff, by
  good texts lost for each bad one caught. Along that order the rules grow
  stricter step by step;
- the other half, the holdout, tests the steps in this order. A step is admitted
  while the hypothesis "what the rules reject up to here holds more than ``alpha``
  of the good texts" is refused by the exact binomial test: P(Bin(n, alpha) <= k)
  <= delta / strata, with k of the holdout's n good texts rejected (the same as an
  upper Clopper-Pearson bound of at most alpha). The first step that isn't
  refused ends the sequence. An order fixed beforehand costs nothing for its steps
  (fixed-sequence testing); strata are paid for by Bonferroni. So with probability
  1 - delta the rules of every stratum together reject at most ``alpha`` of its good
  texts.

A stratum whose holdout has too few good texts for any test is judged with all
others like it, as one pooled stratum, whose promise holds for the pool. Cells that
catch nothing bad aren't steps. Without labels no rule is in force.

Defined cases: a null text has no words (and fails the base rule); null
language is the stratum ``und``; labels of null, or without a document, aren't
used, and a document or text labelled twice counts once, with its highest
label; repeated documents each give their row; an empty table gives an empty
table; other columns are ignored. Hash collisions of 8-word windows within one
text (64 bits) are the only inexactness.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuescope.llm.common import materialise

WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 8, 20, 30
SYMBOLS, BLANKS = "#*$%&|<>", "\t\n\x0b\x0c\r"
#: Share of good texts that a stratum's rules may reject together, chance that any promise fails.
ALPHA, DELTA = 0.02, 0.05
#: rule -> (measure, cutoffs): a text is rejected if its measure is larger.
RULES: dict[str, tuple[str, tuple[int, ...]]] = {
    "symbols": ("n_symbols * 1000 div greatest(word_chars, 1)", (0, 5, 10, 20, 40, 80, 120, 160, 200, 300)),
    "repeats": ("n_repeat_words * 100 div greatest(n_words, 1)", (0, 2, 5, 10, 15, 20, 25)),
    "lines": ("n_dup_lines * 100 div greatest(n_lines, 1)", (0, 5, 10, 20, 30, 50, 70)),
    "long_words": ("word_chars * 10 div greatest(n_words, 1)", (70, 80, 90, 100, 120, 150, 200)),
}
#: Strata that are broadcast; more are joined by a shuffle.
MAX_BROADCAST_ROWS = 100_000


def text_measures(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` plus n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words of each whole text."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*keep, t.alias("_t"))
    lines = F.filter(F.split("_t", "\n"), lambda x: F.length(F.translate(x, " " + BLANKS, "")) > 0)
    rows = rows.select(
        *keep, F.array_remove(F.split(F.translate("_t", BLANKS, " " * len(BLANKS)), " "), "").alias("_w"), lines.alias("_l"),
        F.length(F.translate("_t", " " + BLANKS, "")).cast("bigint").alias("word_chars"), (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
    )
    base = [*keep, "word_chars", "n_symbols"]
    rows = rows.select(
        *base, F.size("_w").cast("bigint").alias("n_words"), F.size("_l").cast("bigint").alias("n_lines"), (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"),
        F.transform("_w", lambda x: F.xxhash64(x)).alias("_h"),
    )
    base += ["n_words", "n_lines", "n_dup_lines"]
    none = F.expr("cast(array() as array<bigint>)")
    window = lambda i: F.xxhash64(*[F.get("_h", i + k) for k in range(WINDOW)])
    rows = rows.select(*base, F.when(F.size("_h") >= WINDOW, F.transform(F.sequence(F.lit(0), F.size("_h") - WINDOW), window)).otherwise(none).alias("_v"))
    # windows in the order of their hashes, only where two are alike
    rows = rows.select(*base, F.when(F.size(F.array_distinct("_v")) < F.size("_v"), F.array_sort(F.transform("_v", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))).alias("_s"))
    alike = "_s[k].x <=> get(_s, k - 1).x or _s[k].x <=> get(_s, k + 1).x"
    rows = rows.select(*base, F.expr(f"if(_s is null, cast(array() as array<int>), array_sort(transform(filter(sequence(0, size(_s) - 1), k -> {alike}), k -> _s[k].i)))").alias("_p"))
    covered = F.expr(f"if(size(_p) = 0, 0, aggregate(sequence(0, size(_p) - 1), 0, (a, k) -> a + least({WINDOW}, coalesce(get(_p, k + 1) - _p[k], {WINDOW}))))")
    return rows.select(*base, covered.cast("bigint").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def stratum() -> Column:
    return F.coalesce(F.col("lang"), F.lit("und"))


def _log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1: Stirling's series at x + 8."""
    y = x + 8.0
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1.0 / (12.0 * y) - 1.0 / (360.0 * y * y * y) + 1.0 / (1260.0 * y * y * y * y * y)
    return series - reduce(lambda s, k: s + F.log(x + float(k)), range(1, 8), F.log(x))


def log_tail(n: Column, k: Column, a: float) -> Column:
    """ln P(Bin(n, a) <= k); 0 from the mean on, where it isn't small.

    Terms are added from k down, as far as they count: some twelve standard deviations, whatever n.
    """
    n, k = n.cast("double"), k.cast("double")
    top = _log_gamma(n + 1.0) - _log_gamma(k + 1.0) - _log_gamma(n - k + 1.0) + k * math.log(a) + (n - k) * math.log1p(-a)
    least = F.greatest(F.lit(1.0), k - F.ceil(40.0 + 12.0 * F.sqrt(n * a)))
    steps = F.when(k >= 1, F.sequence(k.cast("bigint"), least.cast("bigint"), F.lit(-1).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))

    def add(z, i):
        t = z["t"] * i * (1.0 - a) / ((n - i + 1.0) * a)
        return F.struct(t.alias("t"), (z["s"] + t).alias("s"))

    total = F.aggregate(steps, F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")), add)["s"]
    return F.when(k >= n * a, F.lit(0.0)).otherwise(top + F.log(total))


def _cells(rules) -> list[tuple[str, int, Column]]:
    return [(name, c, F.expr(f"({measure}) > {c}")) for name, (measure, cutoffs) in rules.items() for c in cutoffs]


def choose_cutoffs(labelled: DataFrame, rules=RULES, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """stratum, judged_with (the stratum or null for the pool), rule, cutoff, n, k from rows of measures, stratum, digest
    (of the text, in hex) and label (0 or 1): the strictest admitted cutoff of each rule, and of all its stratum's rules
    together the holdout's good texts and those of them that are rejected."""
    cells = _cells(rules)
    measured = [c for c in labelled.columns if c not in ("stratum", "digest", "label")]
    over = F.array(*[o for _, _, o in cells]).alias("over")
    texts = labelled.groupBy("stratum", "digest").agg(F.max("label").alias("label"), *[F.any_value(c).alias(c) for c in measured])
    texts = texts.select("stratum", "label", (F.substring("digest", 1, 1) >= "8").alias("holdout"), over)
    good, bad = F.col("label"), 1 - F.col("label")
    # per stratum and half: good texts, and for each cell the good and the bad ones that it rejects
    sums = [F.sum(F.when(F.get("over", F.lit(i)), v).otherwise(0)) for v in (good, bad) for i in range(len(cells))]
    halves = texts.groupBy("stratum", "holdout").agg(F.sum(good).alias("n"), F.array(*sums[: len(cells)]).alias("k"), F.array(*sums[len(cells) :]).alias("bad"))
    halves = materialise(halves, "cutoff-counts")
    strata = halves.groupBy("stratum").agg(F.coalesce(F.sum(F.when(F.col("holdout"), F.col("n"))), F.lit(0)).alias("n"))
    number = strata.count()
    alone = F.col("n") * math.log1p(-alpha) <= math.log(delta / max(number, 1))
    groups = materialise(strata.select("stratum", F.when(alone, F.col("stratum")).alias("judged_with")), "strata")
    tested = groups.select("judged_with").distinct().count()
    few = F.broadcast if number <= MAX_BROADCAST_ROWS else lambda df: df

    # the order of the cells, by the half that explores
    names = F.array(*[F.struct(F.lit(i).alias("cell"), F.lit(name).alias("rule"), F.lit(c).alias("cutoff")) for i, (name, c, _) in enumerate(cells)])
    explored = halves.filter(~F.col("holdout")).join(few(groups), "stratum").select("judged_with", F.explode(F.arrays_zip(names.alias("c"), "k", "bad")).alias("x"))
    explored = explored.select("judged_with", "x.c.*", "x.k", "x.bad").groupBy("judged_with", "cell", "rule", "cutoff").agg(F.sum("k").alias("k"), F.sum("bad").alias("bad")).filter("bad > 0")
    order = Window.partitionBy("judged_with").orderBy(F.col("k") / F.col("bad"), F.col("bad").desc(), "rule", F.col("cutoff").desc())  # a row a cell
    steps = materialise(explored.select("judged_with", "cell", "rule", "cutoff", F.row_number().over(order).alias("step")), "steps")
    # the holdout: each text falls at the first step whose cell rejects it
    places = steps.groupBy("judged_with").agg(F.map_from_entries(F.collect_list(F.struct("cell", "step"))).alias("places"))
    held = texts.filter("holdout").join(few(groups), "stratum")
    held = held.join(few(places), held["judged_with"].eqNullSafe(places["judged_with"])).select(held["judged_with"], "label", F.array_min(F.transform("over", lambda o, i: F.when(o, F.col("places")[i]))).alias("step"))
    fallen = held.groupBy("judged_with", "step").agg(F.count(F.when(good == 1, 1)).alias("good"))
    sizes = fallen.groupBy(F.col("judged_with").alias("_g")).agg(F.sum("good").alias("n"))
    fallen = fallen.filter("step is not null").select(F.col("judged_with").alias("_f"), F.col("step").alias("_s"), "good")
    rows = steps.join(fallen, F.col("judged_with").eqNullSafe(F.col("_f")) & (F.col("step") == F.col("_s")), "left").drop("_f", "_s")
    along = Window.partitionBy("judged_with").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("k", F.sum(F.coalesce("good", F.lit(0))).over(along))
    rows = rows.join(few(sizes), F.col("judged_with").eqNullSafe(F.col("_g")))
    # k only grows along the steps, so those that pass are the ones before the first that doesn't
    admitted = rows.filter(log_tail(F.col("n"), F.col("k"), alpha) <= math.log(delta / max(tested, 1)))
    best = admitted.groupBy(F.col("judged_with").alias("_g"), "rule").agg(F.min("cutoff").alias("cutoff"), F.max("n").alias("n"), F.max("k").alias("k"))
    return groups.join(best, F.col("judged_with").eqNullSafe(F.col("_g"))).select("stratum", "judged_with", "rule", "cutoff", "n", "k")


def judge(measures: DataFrame, cutoffs: DataFrame, rules=RULES) -> DataFrame:
    """``measures`` (with stratum) plus base_failed, kept and rejected_by."""
    table = cutoffs.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == name, F.col("cutoff"))).alias(f"_{name}") for name in rules])
    if table.count() <= MAX_BROADCAST_ROWS:
        table = F.broadcast(table)
    rows = measures.join(table, "stratum", "left")
    by = F.array_compact(F.array(*[F.when(F.expr(f"({measure}) > _{name}"), F.lit(name)) for name, (measure, _) in rules.items()]))
    rows = rows.withColumn("base_failed", base_failed()).withColumn("rejected_by", by)
    return rows.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)).drop(*[f"_{name}" for name in rules])


def controlled_filter(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the measures, base_failed, kept, rejected_by, stratum of each document."""
    base = docs.select("doc_id", "lang", "text", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"))
    measures = materialise(text_measures(base, ["doc_id", "lang", "digest"]).select("*", stratum().alias("stratum")).drop("lang"), "measures")
    one = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    cutoffs = materialise(choose_cutoffs(measures.join(one, "doc_id").drop("doc_id")), "cutoffs")
    return judge(measures.drop("digest"), cutoffs)
