"""File ingest and export.

CSV is read with a declared schema bound by position (``enforceSchema``), never inferred, with
multi-line quoted fields allowed for free text. Parquet is the format between stages; writes go
through ``mode("overwrite")`` so a re-run replaces a table, and ``materialize`` writes a frame and
reads it back, which both checkpoints the lineage and survives executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from .dimensions import bounded_broadcast

CSV_OPTIONS = {
    "header": "true",
    "enforceSchema": "true",
    "escape": '"',
    "quote": '"',
    "mode": "FAILFAST",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
}


def read_csv(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    """CSV with a header line whose names are ignored: columns bind to ``schema`` by position. Only
    tables with free text (comments) are read as multi-line, which makes a file one task.
    Floating-point NaN is turned into NULL (in Spark ``NaN >= 1`` is true, so a NaN would pass
    threshold flags that a missing value must fail)."""
    free_text = any("comment" in f.name for f in schema.fields)  # such a file can't be split: quoted line ends
    opts = {**CSV_OPTIONS, "multiLine": str(free_text).lower(), **{k: str(v) for k, v in options.items()}}
    return nan_to_null(spark.read.options(**opts).schema(schema).csv(path))


def nan_to_null(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV with a header, no index column; one file per partition."""
    df.write.mode(mode).option("header", "true").option("escape", '"') \
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet under ``path`` (a shared folder on a cluster) and return the re-read
    table: the create-table-as-select step, and a lineage cut that outlives executors."""
    write_parquet(df, path)
    return df.sparkSession.read.parquet(path)


def use_namespace(spark: SparkSession, name: str) -> str:
    """CREATE DATABASE IF NOT EXISTS + USE (the schema the tables live in)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    spark.catalog.setCurrentDatabase(name)
    return name


def save_table(df: DataFrame, name: str, namespace: str | None = None, partition_by=None) -> str:
    """Create-or-replace a catalog table from ``df`` (CREATE TABLE AS SELECT, drop-and-recreate)."""
    full = f"`{namespace}`.`{name}`" if namespace else f"`{name}`"
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(full)
    return full


def with_file_position(df: DataFrame, out_col: str = "file_row") -> DataFrame:
    """Adds the 1-based place of each row over the Parquet files that ``df`` reads, in the order of their
    names. Offsets are a running sum over one row per file."""
    name, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    placed = df.select("*", name.alias("_file"), row.alias("_row"))
    sizes = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (placed.join(bounded_broadcast(offsets), "_file").withColumn(out_col, F.col("_off") + F.col("_row") + 1)
            .select(*df.columns, out_col))
