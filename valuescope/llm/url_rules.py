"""URL filtering by association rules.

A URL becomes a set of tokens: its scheme, the suffixes and labels of its host,
its path segments (numbers as one class), file ending, query keys and whether a
fragment stands. Spark's FP-growth mines frequent sets of tokens together with
the label of the page; all rules "tokens -> block" are kept whose support and
confidence suffice, unless a rule of some of their tokens is at least as confident.
Tokens that occur in the same labelled pages are one item while sets are mined: sets
of them would all have its support, and be as many as two to their number. A rule
with that item then stands for each of its tokens.
Rules match through an inverted index: a rule stands under its rarest token,
and a URL that has that token is checked for the others.

Explicit rules (host, path prefix, verdict) come first: one fits its host and
all subdomains when the path starts with its path; the longest one wins.

Defined cases: a null url or one without "://" has empty host and path, and no
tokens but its lack of a scheme. No labelled pages, or none to block: no mined
rule, and every URL that no explicit rule fits is allowed. Repeated rows count
and are judged each. An empty table gives an empty table; other columns are
ignored. Among mined rules that match, the most confident is named, then the
one with the larger support, then by its text.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuescope.llm.common import materialise

#: Least share and least number of the labelled pages that a rule's tokens and label occur in, least confidence.
MIN_SUPPORT, MIN_PAGES, MIN_CONFIDENCE = 0.001, 10, 0.5
#: Up to so many rules the index is broadcast; more are joined by a shuffle.
BROADCAST_RULES = 10_000
BLOCK, ALLOW = "block", "allow"
_LABEL = "label="


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without "://"."""
    rest = F.when(F.locate("://", url) > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)?", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.coalesce(path, F.lit(""))


def explicit_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule of (host, path, verdict); nulls where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # the last that fits is the longest
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    n = F.size(labels)
    at = lambda k: F.get(labels, n - F.lit(k))
    clean = F.coalesce(url, F.lit(""))
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    query = F.regexp_extract(clean, r"(?s)\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("q="), F.regexp_extract(x, "(?s)^[^=]*", 0)))
    parts = F.transform(segments, lambda x: F.concat(F.lit("p="), F.when(F.regexp_like(x, F.lit(r"^[0-9]+$")), F.lit("#")).otherwise(F.regexp_replace(x, "[0-9]+", "#"))))
    return F.array_distinct(F.filter(F.concat(
        F.array(
            F.concat(F.lit("s="), F.regexp_extract(clean, r"(?s)^(.*?)://", 1)), F.concat(F.lit("t="), at(1)), F.concat(F.lit("d="), F.concat_ws(".", at(2), at(1))),
            F.when(F.locate("#", clean) > 0, F.lit("f=")), F.when(F.endswith(path, F.lit("/")), F.lit("e=/")),
        ),
        F.transform(F.slice(labels, 1, F.greatest(n - 2, F.lit(0))), lambda x: F.concat(F.lit("h="), x)), parts, keys,
    ), lambda x: x.isNotNull()))


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """rule_id, tokens, support, confidence from rows of (tokens, label of block or allow)."""
    spark = labelled.sparkSession
    empty = spark.createDataFrame([], "rule_id string, tokens array<string>, support double, confidence double")
    n = labelled.count()
    if not n:
        return empty
    least = min(1.0, max(min_support, MIN_PAGES / n))
    rows = materialise(labelled.select(F.monotonically_increasing_id().alias("row"), F.array_distinct(F.coalesce("tokens", F.array().cast("array<string>"))).alias("tokens"), "label"), "labelled")
    each = rows.select("row", F.explode("tokens").alias("token"))
    # tokens of the same pages: as many, and with equal sums of two hashes of the pages' rows
    pages = [F.sum(F.xxhash64("row", F.lit(k)).cast("decimal(38,0)")).alias(f"s{k}") for k in (1, 2)]
    often = each.groupBy("token").agg(F.count("*").alias("n"), *pages).filter(F.col("n") >= math.ceil(least * n))
    same = materialise(often.groupBy("n", "s1", "s2").agg(F.min("token").alias("item"), F.collect_list("token").alias("members")).select("item", "members"), "same-pages")
    # frequent tokens are at most as many as the tokens of 1 / ``least`` pages
    named = same.select("item", F.explode("members").alias("token"))
    found = each.join(F.broadcast(named), "token").groupBy("row").agg(F.collect_set("item").alias("found"))
    items = rows.join(found, "row", "left").select(F.array_append(F.coalesce("found", F.array().cast("array<string>")), F.concat(F.lit(_LABEL), F.col("label"))).alias("items"))
    sets = materialise(FPGrowth(itemsCol="items", minSupport=least, minConfidence=min_confidence).fit(items).freqItemsets, "item-sets")
    block = _LABEL + BLOCK
    marked = sets.filter(F.array_contains("items", block)).select(F.array_sort(F.array_remove("items", block)).alias("tokens"), F.col("freq").alias("hits")).filter(F.size("tokens") >= 1)
    plain = sets.filter(~F.exists("items", lambda x: F.startswith(x, F.lit(_LABEL)))).select(F.array_sort("items").alias("tokens"), "freq")
    scored = marked.join(plain, "tokens").select("tokens", F.size("tokens").alias("size"), (F.col("hits") / n).alias("support"), (F.col("hits") / F.col("freq")).alias("confidence"))
    scored = materialise(scored, "scored-sets")
    # size by size: ``below`` is the largest confidence of any proper subset, all of which are frequent too
    rules, smaller = empty, None
    for size in range(1, (scored.agg(F.max("size")).first()[0] or 0) + 1):
        level = scored.filter(F.col("size") == size)
        if smaller is None:
            level = level.withColumn("below", F.lit(0.0))
        else:
            parts = level.select("tokens", F.explode("tokens").alias("_out")).select("tokens", F.array_remove("tokens", F.col("_out")).alias("_part"))
            below = parts.join(smaller, "_part").groupBy("tokens").agg(F.max("most").alias("below"))
            level = level.join(below, "tokens")
        level = materialise(level, "rule-level")
        smaller = level.select(F.col("tokens").alias("_part"), F.greatest("confidence", "below").alias("most"))
        kept = level.filter((F.col("confidence") >= min_confidence) & (F.col("confidence") > F.col("below"))).select("tokens", "support", "confidence")
        for place in range(size):  # the item at this place gives way to each of its tokens
            kept = kept.withColumn("item", F.get("tokens", F.lit(place))).join(F.broadcast(same), "item").withColumn("_token", F.explode("members"))
            kept = kept.select(F.transform("tokens", lambda t, i: F.when(i == place, F.col("_token")).otherwise(t)).alias("tokens"), "support", "confidence")
        kept = kept.withColumn("tokens", F.array_sort("tokens"))
        rules = rules.union(kept.select(F.array_join("tokens", " ").alias("rule_id"), "tokens", "support", "confidence"))
    return materialise(rules, "rules")


def judge(urls: DataFrame, tokens: str, rules: DataFrame) -> DataFrame:
    """``urls`` without ``tokens``, plus rule_id, support, confidence of the best mined rule that matches (else null).

    The index of at most ``BROADCAST_RULES`` rules is broadcast; a larger one and the urls' tokens are shuffled by token.
    """
    keep = [c for c in urls.columns if c != tokens]
    found = F.struct(F.col("_i.confidence").alias("confidence"), F.col("_i.support").alias("support"), F.col("_i.rule_id").alias("rule_id"))
    number = rules.count()
    if not number:
        return urls.select(*keep, F.lit(None).cast("string").alias("rule_id"), F.lit(None).cast("double").alias("support"), F.lit(None).cast("double").alias("confidence"))
    # the index: each rule under the token that the fewest rules have
    each = rules.select("rule_id", F.explode("tokens").alias("_token"))
    rarest = each.join(each.groupBy("_token").agg(F.count("*").alias("_n")), "_token").groupBy("rule_id").agg(F.min(F.struct("_n", "_token"))["_token"].alias("_token"))
    index = rules.join(rarest, "rule_id").select("_token", F.struct(F.col("tokens").alias("needed"), "rule_id", "support", "confidence").alias("_i"))
    posted = urls.withColumn("_row", F.monotonically_increasing_id()).withColumn("_token", F.explode_outer(tokens))
    hits = posted.join(F.broadcast(index) if number <= BROADCAST_RULES else index, "_token", "left")
    match = F.when(F.size(F.array_except("_i.needed", tokens)) == 0, found)
    best = hits.groupBy("_row", *keep).agg(F.max(match).alias("_b"))
    return best.select(*keep, "_b.rule_id", "_b.support", "_b.confidence")
