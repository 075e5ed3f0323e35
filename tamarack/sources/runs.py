"""Runs over folders: files are listed without being read, taken in batches, and each batch is committed once.

An output folder holds part files of rows, and in ``_batches``, which readers of the folder don't see, a folder and a
manifest for each batch.  A batch's rows are extracted in one pass and staged there, with the names of its files and what
went wrong with them; its manifest, put in place by one rename, is the commit; then the staged parts are moved among the
rows.  After a crash :meth:`Output.recover` moves what a manifest names and drops what none does, so each file's row is
there once whenever the crash was.  Only files whose rows are missing are read by the next run: names are compared first,
from the file system's listing and the names of committed batches.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tamarack.operators.flatten import flatten
from tamarack.tables import _located, discard, exists, materialize

PER_BATCH = 20_000
NAMES = "source_file string, error string"
#: Options of the writers and readers of rows.
CSV = {"header": "true", "escape": '"'}
JSON = {"ignoreNullFields": "false"}


def listed(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(``path``, ``source_file``, ``length``) of the files of a folder, from its listing: no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("source_file"), "length")


def left(files: DataFrame, done: DataFrame) -> DataFrame:
    """``files`` whose ``source_file`` is not in ``done``."""
    return files.join(done.select("source_file"), "source_file", "left_anti").select("path", "source_file", "length")


def batches(files: DataFrame, per_batch: int = PER_BATCH) -> Iterator[list[str]]:
    """Paths of ``files``, by name, ``per_batch`` at a time; the driver holds no more than one range of names."""
    ordered = materialize(files.select("source_file", "path").orderBy("source_file", "path"))
    held: list[str] = []
    for r in ordered.orderBy("source_file", "path").select("path").toLocalIterator():
        held.append(re.sub(r"([*?\[\]{}\\])", r"\\\1", r.path))  # names, not patterns
        if len(held) == per_batch:
            yield held
            held = []
    if held:
        yield held
    discard(ordered)


class Output:
    """A folder of wide rows that grows by whole batches; ``kind`` is ``csv`` or ``json``."""

    def __init__(self, spark: SparkSession, path: str, kind: str = "csv") -> None:
        self.spark, self.path, self.kind = spark, path.rstrip("/"), kind
        self.top = f"{self.path}/_batches"

    def _names(self, folder: str) -> list[str]:
        p, fs = _located(self.spark, folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _move(self, old: str, new: str) -> None:
        (a, fs), (b, _) = _located(self.spark, old), _located(self.spark, new)
        if fs.exists(a):
            if fs.exists(b):
                fs.delete(b, False)  # half of an interrupted copy, where the store moves by copying
            if not fs.rename(a, b):
                raise OSError(f"{old} could not be moved to {new}")

    def manifest(self, batch: str) -> dict | None:
        """What a batch's commit says, or None."""
        where = f"{self.top}/{batch}.json"
        return json.loads(self.spark.read.text(where, wholetext=True).first()[0]) if exists(self.spark, where) else None

    def committed(self) -> list[str]:
        return [n[:-5] for n in self._names(self.top) if n.endswith(".json") and not n.startswith("_")]

    def publish(self, batch: str, parts: list[str]) -> None:
        for k, part in enumerate(parts):
            self._move(f"{self.top}/{batch}/rows/{part}", f"{self.path}/part-{batch}-{k:05}.{self.kind}")

    def recover(self) -> None:
        """Finish what was committed, drop what was not."""
        known = self.committed()
        for batch in known:
            self.publish(batch, self.manifest(batch)["parts"])
        for name in self._names(self.top):
            if name.removesuffix(".json") not in known:
                p, fs = _located(self.spark, f"{self.top}/{name}")
                fs.delete(p, True)

    def done(self) -> DataFrame:
        """(``source_file``) of files whose rows are there, those of runs before there were batches among them."""
        known = self.committed()
        out = self.spark.read.schema(NAMES).parquet(*[f"{self.top}/{b}/names" for b in known]) if known else self.spark.createDataFrame([], NAMES)
        out = out.where("error is null").select("source_file")
        own = tuple(f"part-{b}-" for b in known)
        older = [f"{self.path}/{n}" for n in self._names(self.path) if not n.startswith((*own, "_", "."))]
        if older:
            reader = self.spark.read.options(**CSV).option("multiLine", True) if self.kind == "csv" else self.spark.read
            out = out.unionByName(getattr(reader, self.kind)(older).select("source_file"))
        return out

    def failed(self, known: list[str]) -> DataFrame:
        """(``file``, ``error``) of batches."""
        rows = self.spark.read.schema(NAMES).parquet(*[f"{self.top}/{b}/names" for b in known]) if known else self.spark.createDataFrame([], NAMES)
        return rows.where("error is not null").select(F.col("source_file").alias("file"), "error")

    def commit(self, records: DataFrame, batch: str | None = None) -> dict:
        """Add the rows of ``records`` (with ``source_file``, and ``error`` where a file failed); once, however often a named
        batch is handed in.  Returns the manifest: ``ok``, ``failed`` and ``parts``."""
        batch = batch or f"{len(self.committed()):06}-{uuid.uuid4().hex[:8]}"
        found = self.manifest(batch)
        if found is None:
            stage = f"{self.top}/{batch}"
            p, fs = _located(self.spark, stage)
            fs.delete(p, True)
            if "error" not in records.columns:
                records = records.withColumn("error", F.lit(None).cast("string"))
            counts = Observation()
            bad = F.col("error").isNotNull()
            # the only pass over the records; counters come with it
            seen = flatten(records, extra=("source_file", "error")).observe(counts, F.count_if(~bad).alias("ok"), F.count_if(bad).alias("failed"))
            rows = materialize(seen)
            rows.select("source_file", "error").write.parquet(f"{stage}/names")
            good = rows.where("error is null").drop("error").orderBy("source_file")
            getattr(good.write.options(**(CSV if self.kind == "csv" else JSON)), self.kind)(f"{stage}/rows")
            discard(rows)
            parts = [n for n in self._names(f"{stage}/rows") if n.startswith("part-")]
            found = {k: int(counts.get[k]) for k in ("ok", "failed")} | {"parts": parts}
            self._sign(batch, found)
        self.publish(batch, found["parts"])
        return found

    def _sign(self, batch: str, manifest: dict) -> None:
        """The commit: the manifest is there or it is not."""
        p, fs = _located(self.spark, f"{self.top}/_{batch}.json")
        out = fs.create(p, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        self._move(f"{self.top}/_{batch}.json", f"{self.top}/{batch}.json")


def run(spark: SparkSession, source: str, glob: str, out: Output, read: Callable[[list[str]], DataFrame], extract: Callable[[DataFrame], DataFrame], resume: bool = False, per_batch: int = PER_BATCH) -> dict:
    """Extract the files of a folder that ``out`` has no row of, batch by batch; ``ok``, ``failed``, ``skipped``, ``total``.

    ``read`` gets paths and ``extract`` its rows.  What failed is written beside the output, for this run alone.
    """
    if not resume and exists(spark, out.path):
        raise FileExistsError(f"{out.path} exists; resume it or name another")
    out.recover()
    files = listed(spark, source, glob)
    todo = left(files, out.done()) if resume else files
    told = {"ok": 0, "failed": 0}
    before = set(out.committed())
    for paths in batches(todo, per_batch):
        made = out.commit(extract(read(paths)))
        told = {k: told[k] + made[k] for k in told}
    own = [b for b in out.committed() if b not in before]
    out.failed(own).coalesce(1).write.mode("overwrite").json(out.path + ".errors")
    total = files.count()
    return told | {"skipped": total - told["ok"] - told["failed"], "total": total}
