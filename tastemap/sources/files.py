"""CSV and parquet readers and writers, schema and count reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemap.params import RATINGS_SCHEMA  # the rating file layout: ids, a rating, epoch seconds


def read_csv_table(spark: SparkSession, path: str, schema: str | T.StructType = RATINGS_SCHEMA,
                   header: bool = True, sep: str = ",", **options) -> DataFrame:
    """CSV scan with a fixed schema, never inferred.

    Without ``header`` the header line is parsed as data and, under a typed
    schema, becomes an all-null row; it is on by default here.
    """
    reader = spark.read.schema(schema).option("header", header).option("sep", sep)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.csv(path)


def read_parquet_table(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Parquet scan.  ``recursive`` reads every file below ``path`` and turns
    off partition discovery, as ``recursiveFileLookup`` does."""
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet below the checkpoint folder and scan it back.

    Cuts the lineage of a derived input (a join, say) that several passes
    read, so each pass is a pruned file scan instead of a recomputation, and
    a lost executor costs a re-read, not a re-join.  Its shuffle files go then.
    """
    from tastemap.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    write_spent(df, path)
    return df.sparkSession.read.parquet(path)


def write_spent(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``df``, and remove its shuffle files."""
    from tastemap.session import spent_shuffles_removed

    with spent_shuffles_removed(df.sparkSession):
        df.select("*").write.mode(mode).parquet(path)     # a query of its own, under that setting


def write_parquet_table(df: DataFrame, path: str, mode: str = "overwrite",
                        partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, asked of the file system that holds it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def write_single_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",",
                     mode: str = "overwrite") -> None:
    """One CSV part file, for plans bounded by construction (a limit, a grid report)."""
    df.coalesce(1).write.option("header", header).option("sep", sep).mode(mode).csv(path)


def write_single_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One parquet file, likewise for bounded plans only."""
    df.coalesce(1).write.mode(mode).parquet(path)


def write_csv_parts(df: DataFrame, path: str, header: bool = False, mode: str = "errorifexists") -> None:
    """Multi-part CSV, one file per partition; fails if ``path`` exists by default."""
    df.write.option("header", header).mode(mode).csv(path)


def repartition_layout(df: DataFrame, num_partitions: int, cols: list[str] | None = None) -> DataFrame:
    """Round-robin (no ``cols``) or hash layout into ``num_partitions`` files."""
    return df.repartition(num_partitions, *cols) if cols else df.repartition(num_partitions)


def register_views(frames: dict[str, DataFrame]) -> None:
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def schema_report(df: DataFrame) -> DataFrame:
    """(position, column, type) rows taken from the schema, not from the data."""
    spark = df.sparkSession
    rows = [(i, name, dtype) for i, (name, dtype) in enumerate(df.dtypes)]
    return spark.createDataFrame(rows, "position INT, column STRING, type STRING")


def table_schemas(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(table, position, column, type): a parquet table's columns from the
    footers of all its files.  Spark merges the footers in tasks; files of one
    table whose types of a column can't be reconciled are an error that names
    the column."""
    out = None
    for name, path in paths.items():
        report = schema_report(spark.read.option("mergeSchema", "true").parquet(path))
        report = report.select(F.lit(name).alias("table"), "position", "column", "type")
        out = report if out is None else out.unionByName(report)
    return out


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, sort: list[str] | None = None) -> DataFrame:
    """``df`` as the catalog table ``name`` below ``path``, in ``buckets``
    buckets of ``key`` with sorted files, read back.

    Joins and aggregations on the key with another table of as many buckets
    need no exchange.  Rows are exchanged by the key first, so a bucket is one
    file; a key of a large share of all rows makes its bucket large, so this
    layout is for keys without such values (or for tables grouped by the key).
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    (df.repartition(buckets, key).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, key).sortBy(*(sort or [key])).saveAsTable(name))
    return spark.table(name)


def row_count(frames: dict[str, DataFrame]) -> DataFrame:
    """One (name, n_rows) line per frame, as a single union of global counts."""
    parts = [f.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
             for name, f in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
