"""Incremental runs: new text files are extracted as they arrive and appended to the results.

Which files are done is in the query's checkpoint and which batches are written is in the output, see
``tamarack.sources.runs``, so a restart goes on where it stopped and each file's row is written once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tamarack.operators.flatten import flatten
from tamarack.plans.extraction import extract_documents
from tamarack.sources.files import file_name, stem
from tamarack.sources.runs import Output


def text_stream(spark: SparkSession, path: str, glob: str = "*.txt", per_batch: int = 10_000) -> DataFrame:
    """``text``, ``source_file`` and ``filename`` of files as they arrive in ``path``."""
    rows = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", glob).option("maxFilesPerTrigger", per_batch).load(path)
    return rows.select(F.col("value").alias("text"), file_name().alias("source_file")).withColumn("filename", stem(F.col("source_file")))


def extract_stream(rows: DataFrame, as_of: Column | None = None) -> DataFrame:
    return flatten(extract_documents(rows, as_of=as_of), extra=("source_file",))


def run_incremental(spark: SparkSession, source: str, target: str, checkpoint: str, as_of: Column | None = None, fmt: str = "csv", wait: bool = True) -> StreamingQuery:
    """Extract all files of ``source`` that ``checkpoint`` doesn't know into ``target``, then stop.

    Each micro-batch is a batch of the output, committed under the query's id and the batch's number, so one that is run
    again after a crash adds nothing twice.
    """

    def each(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        out = Output(own, target, fmt)
        out.recover()
        query = own.sparkContext.getLocalProperty("sql.streaming.queryId")
        out.commit(extract_documents(batch, as_of=as_of), f"{query}-{number:08}")

    query = text_stream(spark, source).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if wait:
        query.awaitTermination()
    return query
