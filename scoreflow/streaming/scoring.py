"""Structured Streaming scoring of JSON request lines.

Source: a directory of text files, one JSON request per line
(``{"request_id": ..., "passengers": [...]}``).  The plan is stateless --
parse, explode records (index = position), conform, normalise, validate,
featurise, score -- so no watermark or state store is needed.  One query
reads every line once: a micro-batch is parsed and judged, kept while both
sinks are written, and dropped.  Accepted records go to the predictions sink,
rejected ones (with their violation codes) to the reject sink.  Both sinks are
parquet folders with one partition per micro-batch (column ``batch``).  A batch
that is run again after a failure holds the same files (they are in the
checkpoint) and replaces its own partitions, so no row is lost or doubled.
The checkpoint lies under the cluster's checkpoint directory; ``availableNow``
processes everything present and stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreflow.operators import quality as Q


def request_records(lines: DataFrame) -> DataFrame:
    """Text lines -> validated records (request_id, subject_id=index, ...)."""
    req = lines.select(F.coalesce(
        F.get_json_object("value", "$.request_id").try_cast("long"),
        # a line that was cut off still tells whose it is
        F.regexp_extract("value", r'^\s*\{\s*"request_id"\s*:\s*(\d{1,18})', 1).try_cast("long")).alias("request_id"),
                       F.col("value").alias("body"))
    return Q.validate_requests(Q.explode_requests(req))


def write_batch(records: DataFrame, batch: int, score: Callable[[DataFrame], DataFrame], out_dir: str, reject_dir: str) -> None:
    """The accepted, scored and the rejected records of a micro-batch, into its partition of either sink."""
    kept = records.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rejected = Q.rejected(kept).select("request_id", "passenger_index", "subject_id", "violations")
        for rows, path in ((score(Q.accepted(kept)), out_dir), (rejected, reject_dir)):
            rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")
    finally:
        kept.unpersist()


def start_scoring(spark: SparkSession, source_dir: str, score: Callable[[DataFrame], DataFrame],
                  out_dir: str, reject_dir: str, checkpoint_dir: str,
                  available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the query that fills the accepted and the rejected sink; returns the streaming queries."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    w = (request_records(reader.load(source_dir)).writeStream
         .foreachBatch(lambda records, batch: write_batch(records, batch, score, out_dir, reject_dir))
         .option("checkpointLocation", f"{checkpoint_dir}/requests"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return (w.start(),)


def run_to_completion(queries) -> None:
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
