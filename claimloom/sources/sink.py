"""Records as JSON lines that a run adds once, however often it is tried, and counts on the way.

The driver makes the folder ``<path>/staged/<run>``, into which tasks write files of their own; a task that outlives its failed run finds no
folder and makes none, where the store does not make folders by itself. When all are done the driver writes the run's manifest, which names the files
that count; it is put in place whole, by one rename. Whoever reads, reads what manifests name. A run that fails leaves no manifest and
takes its files away; one that was committed before adds nothing; files of lost or repeated tasks, and folders left empty, go.

Paths are URIs of any store that Arrow knows, for the driver and for executors. Defined cases: a run without records commits an empty
manifest; a task without records writes no file; null parts of a record are left out of its line.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from claimloom.sources.feed import store


@dataclass
class Written(WriterCommitMessage):
    file: str
    n: int


def _manifest(root: str, run: str) -> str:
    return f"{root}/manifests/{run}.json"


def _there(at: fs.FileSystem, path: str) -> bool:
    return at.get_file_info(path).type != fs.FileType.NotFound


def _pruned(at: fs.FileSystem, folder: str, keep: set[str]) -> None:
    """Drop the files of a folder that are not to be kept, and the folder if it is empty then."""
    left = 0
    for info in at.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
        if info.base_name in keep:
            left += 1
        else:
            at.delete_file(info.path)
    if not left and _there(at, folder):
        at.delete_dir(folder)


class RecordWriter(DataSourceArrowWriter):
    """Writes the one string column ``value`` as lines."""

    def __init__(self, path: str, run: str):
        self.path, self.run = path, run

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        at, root = store(self.path)
        folder, name, n, out = f"{root}/staged/{self.run}", f"{uuid.uuid4().hex}.jsonl", 0, None
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if out is None:
                    out = at.open_output_stream(f"{folder}/{name}")
                lines = batch.column(0).to_pylist()
                out.write(("\n".join(lines) + "\n").encode("utf-8"))
                n += len(lines)
        finally:
            if out is not None:
                out.close()
        return Written(name if out is not None else "", n)

    def commit(self, messages: list[Written | None]) -> None:
        at, root = store(self.path)
        target = _manifest(root, self.run)
        if not _there(at, target):
            files = [{"file": m.file, "n": m.n} for m in messages if m is not None and m.file]
            part = f"{root}/manifests/.{self.run}-{uuid.uuid4().hex}"
            at.create_dir(f"{root}/manifests", recursive=True)
            with at.open_output_stream(part) as f:
                f.write(json.dumps({"run": self.run, "files": files}).encode("utf-8"))
            at.move(part, target)
        _pruned(at, f"{root}/staged/{self.run}", {f["file"] for f in _named(at, target)})

    def abort(self, messages: list[Written | None]) -> None:
        at, root = store(self.path)
        if not _there(at, _manifest(root, self.run)):
            _pruned(at, f"{root}/staged/{self.run}", set())


class RecordSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "claim_records"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> RecordWriter:
        if overwrite or not {"path", "run"} <= set(self.options):
            raise ValueError("records are appended, to a path and by a run's name")
        at, root = store(self.options["path"])
        at.create_dir(f"{root}/staged/{self.options['run']}", recursive=True)
        return RecordWriter(self.options["path"], self.options["run"])


def _named(at: fs.FileSystem, manifest: str) -> list[dict]:
    with at.open_input_stream(manifest) as f:
        return json.loads(f.read())["files"]


def observed(records: DataFrame, column: str = "record") -> tuple[DataFrame, Observation]:
    """``records`` that count themselves (all, with media, with errors) while whatever job reads them runs."""
    seen, r = Observation(f"saved-{uuid.uuid4().hex}"), F.col(column)
    some = F.size(r["media"]["images"]) + F.size(r["media"]["videos"]) > 0
    return records.observe(seen, F.count(F.lit(1)).alias("n_records"), F.count_if(some).alias("n_with_media"), F.count_if(r["errors"].isNotNull()).alias("n_with_errors")), seen


def save(records: DataFrame, path: str, run: str, column: str = "record") -> dict[str, int]:
    """Append the records of ``run`` and return the counts of ``observed``, taken by the job that writes them."""
    spark = records.sparkSession
    spark.dataSource.register(RecordSink)
    counted, seen = observed(records, column)
    try:
        counted.select(F.to_json(column).alias("value")).write.format(RecordSink.name()).option("path", path).option("run", run).mode("append").save()
    except Exception:
        RecordWriter(path, run).abort([])  # Spark aborts only writes whose tasks had started
        raise
    return dict(seen.get)


def committed(spark: SparkSession, path: str) -> DataFrame:
    """(run, value): the lines of all runs that were committed."""
    at, root = store(path)
    runs = [i for i in at.get_file_info(fs.FileSelector(f"{root}/manifests", allow_not_found=True)) if i.base_name.endswith(".json")]
    files = [f"{path.rstrip('/')}/staged/{i.base_name[:-5]}/{f['file']}" for i in sorted(runs, key=lambda i: i.base_name) for f in _named(at, i.path)]
    if not files:
        return spark.createDataFrame([], "run string, value string")
    return spark.read.text(files).select(F.regexp_extract(F.col("_metadata.file_path"), "/staged/([^/]*)/[^/]*$", 1).alias("run"), "value")
