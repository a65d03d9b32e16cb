"""Transaction sources.

``read_raw_transactions`` is the production path: untyped sheets/CSV/Parquet
with the workbook header names, unioned with a provenance tag and then
parsed by ``standardize`` (invalid values become NULL, never truncated, and
``rejects`` tells each with a reason).

``transactions_from_orders`` adapts the supplied TPC-H-like tables to the
same canonical schema (see FIXTURES.md section 3).  ``dirty_transactions``
adds rule-violating rows so every cleaning rule has something to remove.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuescope.schemas import RAW_TO_CANONICAL, TXN_COLUMNS, require_columns

# nation is a fixed 25-row dimension: broadcasting it is size-bounded.
NATION_ROWS_BOUND = 25


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Quantities and prices beyond these are no amounts of a retail line; their product still fits the exact money type.
MAX_QUANTITY, MAX_PRICE = 10**9, 1e9

#: Month/day/year forms of spreadsheet exports; two-digit years are 1969 to 2068.
SHEET_FORMS = ["M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy"]
SHORT_YEAR_FORMS = ["M/d/yy H:mm", "M/d/yy H:mm:ss", "M/d/yy"]

#: Columns that are parsed, and the reasons for which a text gives NULL.
PARSED = ["quantity", "invoice_dt", "unit_price", "customer_id"]
REASONS = ["not_a_number", "not_finite", "not_whole", "out_of_range", "not_a_time"]


def _text(x: Column) -> Column:
    """The trimmed text; a blank one is a missing value, not an invalid one."""
    return F.nullif(F.trim(x.cast("string")), F.lit(""))


def _parsed(text: Column, value: Column, reason: Column) -> Column:
    """Struct of value and reason; a reason stands for each text without a value."""
    return F.struct(value.alias("value"), F.when(text.isNotNull() & value.isNull(), reason).alias("reason"))


def parse_whole(x: Column, limit: int | None = None) -> Column:
    """Text/number to BIGINT, exactly (P3): ``17850.0`` is whole, ``1.5`` isn't; ``limit`` bounds its size."""
    t = _text(x)
    d, double = t.try_cast("decimal(38,10)"), t.try_cast("double")
    whole = F.floor(d).try_cast("bigint")
    within = F.lit(True) if limit is None else F.abs(whole) <= limit
    reason = (F.when(double.isNull(), "not_a_number").when(F.isnan(double) | (F.abs(double) == float("inf")), "not_finite")
              .when(d != F.floor(d), "not_whole").otherwise("out_of_range"))
    return _parsed(t, F.when((d == F.floor(d)) & within, whole), reason)


def parse_price(x: Column, limit: float = MAX_PRICE) -> Column:
    """Text/number to DOUBLE (P3), finite and of at most ``limit``."""
    t = _text(x)
    d = t.try_cast("double")
    finite = ~F.isnan(d) & (F.abs(d) != float("inf"))
    reason = F.when(d.isNull(), "not_a_number").when(~finite, "not_finite").otherwise("out_of_range")
    return _parsed(t, F.when(finite & (F.abs(d) <= limit), d), reason)


def parse_time(x: Column) -> Column:
    """Text to a zone-less timestamp.

    ISO texts; those with an offset or Z become the UTC time of that moment. Else the month/day/year
    forms above, with or without seconds or time.
    """
    t = _text(x)
    moment = F.convert_timezone(F.current_timezone(), F.lit("UTC"), t.try_cast("timestamp").cast("timestamp_ntz"))
    iso = F.when(t.rlike(r"[0-9]:[0-9]{2}.*(Z|z|[+-][0-9]{2}:?[0-9]{2})$"), moment).otherwise(t.try_cast("timestamp_ntz"))
    sheet = F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in SHEET_FORMS]).cast("timestamp_ntz")
    short = F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in SHORT_YEAR_FORMS]).cast("timestamp_ntz")
    short = F.when(F.year(short) >= 2069, F.timestamp_add("YEAR", F.lit(-100), short)).otherwise(short)
    return _parsed(t, F.coalesce(iso, sheet, short), F.lit("not_a_time"))


def parsed_columns(raw: DataFrame, source_tag: str | None = None) -> DataFrame:
    """Canonical columns from workbook headers (P1, P2), where the parsed ones are structs of value and reason."""
    require_columns(raw, list(RAW_TO_CANONICAL), source_tag or "raw_input")
    r = {canon: F.col(f"`{src}`") for src, canon in RAW_TO_CANONICAL.items()}
    tag = F.lit(source_tag) if source_tag is not None else F.col("source_sheet")
    parse = {"quantity": lambda c: parse_whole(c, MAX_QUANTITY), "invoice_dt": parse_time, "unit_price": parse_price, "customer_id": parse_whole}
    made = [(parse[c](r[c]) if c in parse else r[c].cast("string")).alias(c) for c in RAW_TO_CANONICAL.values()]
    texts = [r[c].cast("string").alias(f"{c}_text") for c in PARSED]
    return raw.select(*made, tag.cast("string").alias("source_sheet"), *texts)


def standardize(raw: DataFrame, source_tag: str | None = None) -> DataFrame:
    """Rename workbook headers to canonical names and coerce types.

    Invalid numbers/timestamps become NULL; ``rejects`` lists them with reasons.
    """
    parsed = parsed_columns(raw, source_tag)
    return parsed.select(*[(F.col(f"{c}.value") if c in PARSED else F.col(c)).alias(c) for c in TXN_COLUMNS])


def rejects(raw: DataFrame, source_tag: str | None = None) -> DataFrame:
    """One row per text that ``standardize`` turns into NULL: source_sheet, invoice, column, text, reason."""
    found = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}_text").alias("text"), F.col(f"{c}.reason").alias("reason")) for c in PARSED])
    rows = parsed_columns(raw, source_tag).select("source_sheet", "invoice", F.explode(F.filter(found, lambda f: f["reason"].isNotNull())).alias("f"))
    return rows.select("source_sheet", "invoice", "f.*")


def read_raw_transactions(
    spark: SparkSession, sources: dict[str, str], fmt: str = "csv"
) -> DataFrame:
    """Read several untyped sources, tag each with its name, UNION ALL."""
    frames = {}
    for tag, path in sources.items():
        if fmt == "csv":
            # all columns as text, told by the header's names
            frames[tag] = spark.read.option("header", True).csv(path)
        else:
            frames[tag] = spark.read.format(fmt).load(path)
    return ingest(frames)


def ingest(sources: dict[str, DataFrame]) -> DataFrame:
    """Standardise raw frames by column name, tag each with its source's name, UNION ALL."""
    return union_sources([standardize(raw, tag) for tag, raw in sources.items()])


def ingest_rejects(sources: dict[str, DataFrame]) -> DataFrame:
    """Rejects of several raw frames, each tagged with its source's name."""
    return union_sources([rejects(raw, tag) for tag, raw in sources.items()])


def union_sources(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _orders_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"
    )
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # Both sides grow with the data: a shuffle join on the order key.
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner")


def _canonical_with_keys(spark: SparkSession, sf_dir: str, descriptive: bool) -> DataFrame:
    t = _orders_lines(spark, sf_dir)
    if descriptive:
        part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
        cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        cust = cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey, "left")
        t = t.join(part, t.l_partkey == part.p_partkey, "left").join(
            cust, t.o_custkey == cust.c_custkey, "left"
        )
        desc, country = F.col("p_name"), F.col("n_name")
    else:
        desc = country = F.lit(None).cast("string")
    return t.select(
        F.concat(F.when(F.col("l_returnflag") == "R", "C").otherwise(""),
                 F.col("o_orderkey").cast("string")).alias("invoice"),
        F.col("l_partkey").cast("string").alias("stock_code"),
        desc.alias("description"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("o_orderdate").alias("invoice_dt"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("o_custkey").alias("customer_id"),
        country.alias("country"),
        F.concat(F.lit("Year "), F.year("o_orderdate").cast("string")).alias("source_sheet"),
        "l_orderkey",
        "l_linenumber",
    )


def transactions_from_orders(
    spark: SparkSession, sf_dir: str, descriptive: bool = True, as_raw_text: bool = False, keys: tuple = ()
) -> DataFrame:
    """Canonical ``transactions_raw`` from lineitem/orders (FIXTURES.md section 3).

    ``descriptive=False`` leaves description/country NULL and skips the
    part/customer/nation joins: both are functionally dependent on
    stock_code/customer_id, so every downstream result (including exact
    duplicate removal) is unchanged while two large shuffles disappear.

    ``as_raw_text=True`` routes the rows through the untyped workbook form
    and ``standardize`` (the production ingestion path).

    ``keys``: columns of the line item's key (l_orderkey, l_linenumber) to keep.
    """
    out = _canonical_with_keys(spark, sf_dir, descriptive)
    if as_raw_text:
        raw = out.select(
            *[F.col(canon).cast("string").alias(src) for src, canon in RAW_TO_CANONICAL.items()],
            "source_sheet",
        )
        return standardize(raw)
    return out.select(*TXN_COLUMNS, *keys)


def dirty_transactions(spark: SparkSession, sf_dir: str, descriptive: bool = True) -> DataFrame:
    """Transactions with injected rule violations (FIXTURES.md section 3).

    Fixed values: key k = l_orderkey*7 + l_linenumber; k % 97 -> quantity
    negated; k % 89 -> unit_price 0; k % 83 -> customer_id NULL; k % 79 ->
    invoice_dt NULL; lines with l_orderkey % 101 = 0 appear twice.
    """
    t = _canonical_with_keys(spark, sf_dir, descriptive)
    k = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    dirty = t.select(
        "invoice",
        "stock_code",
        "description",
        F.when(k % 97 == 0, -F.col("quantity")).otherwise(F.col("quantity")).alias("quantity"),
        F.when(k % 79 == 0, F.lit(None)).otherwise(F.col("invoice_dt")).alias("invoice_dt"),
        F.when(k % 89 == 0, F.lit(0.0)).otherwise(F.col("unit_price")).alias("unit_price"),
        F.when(k % 83 == 0, F.lit(None)).otherwise(F.col("customer_id")).alias("customer_id"),
        "country",
        "source_sheet",
        "l_orderkey",
    )
    dup = dirty.filter(F.col("l_orderkey") % 101 == 0)
    return dirty.unionByName(dup).select(*TXN_COLUMNS)


def transactions_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second fixture: purchase events with time of day (FIXTURES.md section 5)."""
    ev = read_table(spark, sf_dir, "events").filter(
        (F.col("event_type") == "purchase") & (F.col("value") > 0)
    )
    return ev.select(
        F.col("event_id").cast("string").alias("invoice"),
        F.lit(None).cast("string").alias("stock_code"),
        F.lit(None).cast("string").alias("description"),
        F.lit(1).cast("bigint").alias("quantity"),
        F.col("ts").alias("invoice_dt"),
        F.col("value").alias("unit_price"),
        F.col("user_id").alias("customer_id"),
        F.lit(None).cast("string").alias("country"),
        F.lit("events").alias("source_sheet"),
    )
