"""Running popularity scores over interaction files arriving in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tastemap.session import delete_path

KEPT_SNAPSHOTS = 2  # readers of the one before the latest can finish


def popularity_stream(spark: SparkSession, source_dir: str, schema: str, checkpoint: str,
                      output_path: str | None = None, sink: str = "snapshot",
                      query_name: str = "popularity_scores", item: str = "item_id", user: str = "user_id",
                      max_files_per_trigger: int = 100) -> StreamingQuery:
    """Start a query keeping (item, score) current as parquet files arrive.

    The state is one count per item (bounded by the catalogue, not by the
    stream); the aggregation is partial per micro-batch task before its
    shuffle, and the checkpoint folder makes it restartable after failure.

    ``sink="snapshot"`` (the default) writes the full score table after every
    micro-batch to a folder of its own below ``output_path``, read by
    ``latest_snapshot``: a batch that fails half way leaves the one before;
    ``sink="memory"`` keeps it in an in-memory table named ``query_name`` (for
    tests: that table lives in the driver).
    """
    events: DataFrame = (spark.readStream.schema(schema)
                         .option("maxFilesPerTrigger", max_files_per_trigger)
                         .parquet(source_dir))
    scores = events.groupBy(item).agg(F.count(user).alias("score"))
    writer = (scores.writeStream.outputMode("complete").queryName(query_name)
              .option("checkpointLocation", checkpoint))
    if sink == "memory":
        return writer.format("memory").start()
    if sink != "snapshot" or not output_path:
        raise ValueError("use sink='snapshot' with an output_path, or sink='memory'")

    def write_snapshot(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output_path}/{epoch:012d}")
        for folder in _snapshots(spark, output_path)[:-KEPT_SNAPSHOTS]:
            delete_path(spark, folder)

    return writer.foreachBatch(write_snapshot).start()


def _snapshots(spark: SparkSession, output_path: str) -> list[str]:
    """The folders of complete snapshots, oldest first."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{output_path}/*/_SUCCESS")
    found = done.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(done)
    return sorted(f.getPath().getParent().toString() for f in found or [])


def latest_snapshot(spark: SparkSession, output_path: str) -> DataFrame:
    """(item, score) of the last complete micro-batch."""
    folders = _snapshots(spark, output_path)
    if not folders:
        raise FileNotFoundError(f"no complete snapshot below {output_path}")
    return spark.read.parquet(folders[-1])
