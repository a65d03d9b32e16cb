"""Sinks (S5-S8): Parquet datasets, small CSV reports, model persistence."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valuescope.session import checkpoint_dir

# Report tables are bounded by construction (deciles, budgets, segments,
# cohorts); larger outputs must go through write_parquet.
REPORT_ROW_LIMIT = 100_000


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_report_csv(df: DataFrame, path: str) -> None:
    """One CSV file with header for a small, fixed-size result table.

    The table is computed once, up to one row above the limit, and checked before anything
    is written; ``repartition(1)`` leaves the computation itself in parallel tasks.
    """
    checkpoint_dir(df.sparkSession)
    table = df.limit(REPORT_ROW_LIMIT + 1).checkpoint(eager=True)
    if table.count() > REPORT_ROW_LIMIT:
        raise ValueError(f"report table for {path} has more than {REPORT_ROW_LIMIT} rows; use Parquet")
    table.repartition(1).write.mode("overwrite").option("header", True).csv(path)


def write_ordered(df: DataFrame, path: str, keys: list[str], max_file_rows: int = 0) -> None:
    """O1, O2: rows in the order of ``keys`` (NULLs first) over files whose numbers follow that order.

    ``orderBy`` deals rows to range partitions, each sorted, and a task writes its partition to
    files of its own number; ``max_file_rows`` cuts large ones.
    """
    df.orderBy(*keys).write.mode("overwrite").option("maxRecordsPerFile", max_file_rows).parquet(path)


def _located(spark: SparkSession, path: str) -> DataFrame:
    """Rows as written, with _part, _file (numbers in the file's name) and _row (place in the file)."""
    name = F.col("_metadata.file_name")
    number = lambda pattern: F.regexp_extract(name, pattern, 1).cast("bigint")
    return spark.read.parquet(path).select("*", number(r"^part-([0-9]+)-").alias("_part"), number(r"[.-]c([0-9]+)[.]").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_ordered`` wrote, with ``position``, the row's 1-based place in the whole order.

    Only the files' row counts are ordered (one row a file); rows aren't sorted or shuffled again.
    """
    rows = _located(spark, path)
    files = rows.groupBy("_part", "_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part", "_file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    offsets = files.select("_part", "_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = rows.join(F.broadcast(offsets), ["_part", "_file"])
    return placed.withColumn("position", F.col("_before") + F.col("_row") + 1).drop("_part", "_file", "_row", "_before")


def order_violations(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """One row: rows, files, and violations, the neighbours that stand in the wrong order, inside files and from file to file."""
    rows = _located(spark, path).select("_part", "_file", "_row", F.struct(*keys).alias("_key"))
    previous = F.lag("_key").over(Window.partitionBy("_part", "_file").orderBy("_row"))
    checked = rows.withColumn("_bad", F.coalesce((previous > F.col("_key")).cast("int"), F.lit(0)))
    files = checked.groupBy("_part", "_file").agg(F.count(F.lit(1)).alias("_n"), F.sum("_bad").alias("_bad"), F.min_by("_key", "_row").alias("_first"), F.max_by("_key", "_row").alias("_last"))
    behind = F.lag("_last").over(Window.orderBy("_part", "_file"))  # one row a file
    files = files.withColumn("_edge", F.coalesce((behind > F.col("_first")).cast("int"), F.lit(0)))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return files.agg(total("_n").alias("rows"), F.count(F.lit(1)).alias("files"), total(F.col("_bad") + F.col("_edge")).alias("violations"))


def save_model(model: PipelineModel, path: str) -> None:
    """A whole fitted model: preprocessing stages and classifier."""
    if not isinstance(model, PipelineModel):
        raise TypeError("save the whole pipeline model: a bare classifier can't score raw features")
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
