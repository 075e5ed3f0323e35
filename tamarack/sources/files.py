"""Sources: texts, PDFs, results of earlier runs, known answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.functions.regex import sub


def file_name() -> Column:
    """The name of a row's file, as it is: Spark's own has characters escaped as in addresses."""
    last = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return F.url_decode(F.replace(last, F.lit("+"), F.lit("%2B")))


def _named(df: DataFrame) -> DataFrame:
    name = file_name()
    return df.withColumns({"source_file": name, "filename": stem(name)})


def stem(name: Column) -> Column:
    """A file's name without its last extension."""
    return sub(name, r"(?<!\A)\.[^.]*\z")


def read_texts(spark: SparkSession, path: str | list[str], glob: str = "*.txt") -> DataFrame:
    """A row for each text file: ``text``, ``source_file`` and ``filename`` (its stem).  Folders aren't searched deeper."""
    reader = spark.read.option("wholetext", True)
    return _named((reader.option("pathGlobFilter", glob) if glob else reader).text(path)).withColumnRenamed("value", "text")


def read_pdfs(spark: SparkSession, path: str | list[str], glob: str = "*.pdf") -> DataFrame:
    """A row for each PDF: ``content`` (binary), ``source_file`` and ``filename``."""
    return _named(spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)).select("content", "source_file", "filename")


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Wide rows that an earlier run wrote as CSV."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def skip_done(files: DataFrame, done: DataFrame) -> DataFrame:
    """``files`` whose ``source_file`` isn't in ``done``."""
    return files.join(done.select("source_file"), "source_file", "left_anti")


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """Known answers from a JSON array of ``{filename, expected: {field: value}}``: ``filename``, ``field``, ``expected``."""
    rows = spark.read.option("multiLine", True).option("primitivesAsString", True).schema("filename string, text_file string, expected map<string,string>").json(path)
    return rows.select("filename", F.explode("expected").alias("field", "expected"))
