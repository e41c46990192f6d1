"""Loose cover files: written aside by tasks, committed as a whole, then moved into place and listed in a manifest.

Below the folder of the ``{id}.jpg`` files

* ``_exports/<name>/<task>/`` holds the files of one task, and ``ids`` what it has written;
* ``_exports/<name>/committed`` names the tasks whose files count. Until it is there, the folder holds no file
  of the export; once it is, the export can only be carried to its end, by whoever comes next;
* ``_manifest`` is a table of ``id, length`` of the files in place. It is what a run that goes on reads, so the
  folder, which may hold very many files, is listed once in its life.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FILES = "id string, length long"
# Schemes of Spark's connectors and what Arrow calls the same store.
_ARROW_SCHEME = {"s3a": "s3", "s3n": "s3"}


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme: one without stands, as everywhere in Spark, for the default file system."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.makeQualified(folder).toString().rstrip("/")


def _open(uri: str):
    """Arrow's file system for an address, and the path in it."""
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    return fs.FileSystem.from_uri(f"{_ARROW_SCHEME.get(scheme, scheme)}:{rest}" if scheme != "file" else f"file://{rest.removeprefix('//')}")


def _write(files, path: str, content) -> None:
    with files.open_output_stream(path) as out:
        out.write(content)


def _read_lines(files, path: str) -> list:
    with files.open_input_stream(path) as source:
        return [json.loads(line) for line in source.read().decode().splitlines()]


def _exists(files, path: str) -> bool:
    return files.get_file_info(path).type.name != "NotFound"


@dataclass
class Written(WriterCommitMessage):
    task: str
    files: int


class _AsideWriter(DataSourceArrowWriter):
    def __init__(self, folder: str):
        self.folder = folder

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, base = _open(self.folder)
        context = TaskContext.get()
        task = f"{context.partitionId()}-{context.taskAttemptId()}"
        files.create_dir(posixpath.join(base, task))
        written = []
        for batch in iterator:
            for book_id, content in zip(batch.column("id").to_pylist(), batch.column("content")):
                if book_id is None or "/" in book_id or not book_id.strip("."):
                    raise ValueError(f"id {book_id!r} cannot name a file")
                if content.as_py() is None:
                    continue
                _write(files, posixpath.join(base, task, f"{book_id}.jpg"), content.as_buffer())
                written.append(json.dumps([book_id, content.as_buffer().size]))
        _write(files, posixpath.join(base, task, "ids"), "\n".join(written).encode())
        return Written(task, len(written))

    def commit(self, messages: list[Written | None]) -> None:
        files, base = _open(self.folder)
        tasks = [json.dumps(m.task) for m in messages if m is not None and m.files]
        part = posixpath.join(base, "committing")
        _write(files, part, "\n".join(tasks).encode())
        files.move(part, posixpath.join(base, "committed"))

    def abort(self, messages: list[Written | None]) -> None:
        files, base = _open(self.folder)
        if _exists(files, base):
            files.delete_dir(base)


class AsideFiles(DataSource):
    """Sink of ``id, content`` rows that writes a file a row below ``path`` and commits them together."""

    @classmethod
    def name(cls) -> str:
        return "folio_aside_files"

    def writer(self, schema: StructType, overwrite: bool) -> _AsideWriter:
        return _AsideWriter(self.options["path"])


def _move_into_place(directory: str, export: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open(directory)
        for batch in batches:
            for task in batch.column(0).to_pylist():
                aside = posixpath.join(base, "_exports", export, task)
                ids = _read_lines(files, posixpath.join(aside, "ids"))
                for name, _ in ids:
                    source, target = posixpath.join(aside, f"{name}.jpg"), posixpath.join(base, f"{name}.jpg")
                    if _exists(files, source):  # else an earlier try has moved it
                        files.move(source, target)
                columns = [pa.array([x[k] for x in ids], t) for k, t in enumerate((pa.string(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "length"])

    return run


def read_manifest(spark: SparkSession, directory: str) -> DataFrame | None:
    """``id, length`` of the files in place, or None where no export has kept a manifest."""
    try:
        return spark.read.schema(FILES).parquet(f"{qualified(spark, directory)}/_manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _listed(spark: SparkSession, directory: str) -> DataFrame:
    """``id, length`` of the files in a folder, by listing it; none where there is no folder yet."""
    try:
        listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg").load(directory)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILES)
    return listing.select(F.regexp_extract("path", r"([^/]+)\.jpg$", 1).alias("id"), "length")


def finish_exports(spark: SparkSession, directory: str) -> int:
    """Carry committed exports to their end and drop those that broke off before; returns how many files were put in place.

    Tasks move the files of a task each. Moving again what a lost executor had moved changes nothing, and the
    manifest names a file once all of its export are in place.
    """
    directory = qualified(spark, directory)
    files, base = _open(directory)
    exports, done = posixpath.join(base, "_exports"), 0
    if not _exists(files, exports):
        return 0
    from pyarrow import fs

    for info in files.get_file_info(fs.FileSelector(exports)):
        if _exists(files, posixpath.join(info.path, "committed")):
            tasks = _read_lines(files, posixpath.join(info.path, "committed"))
            if tasks:
                rows = spark.createDataFrame([(task,) for task in tasks], "task string").repartition(len(tasks))
                moved = rows.mapInArrow(_move_into_place(directory, info.base_name), FILES)
                # Under the export's name, so that a second try replaces what the first had listed.
                listed = f"{directory}/_manifest/export={info.base_name}"
                moved.write.mode("overwrite").parquet(listed)
                done += spark.read.schema(FILES).parquet(listed).count()
        files.delete_dir(info.path)
    return done


def export_cover_files(covers: DataFrame, directory: str) -> int:
    """Write ``{id}.jpg`` files for rows of ``id, content`` below a folder all executors reach; returns how many.

    All or none: a job that fails leaves the folder as it was. Rows without content give no file; an id that cannot
    name a file is an error.
    """
    spark = covers.sparkSession
    directory = qualified(spark, directory)
    finish_exports(spark, directory)
    files, base = _open(directory)
    if _exists(files, base) and read_manifest(spark, directory) is None:  # files that were there before
        _listed(spark, directory).write.parquet(f"{directory}/_manifest/export=before")
    files.create_dir(base)
    spark.dataSource.register(AsideFiles)
    aside = f"{directory}/_exports/{uuid.uuid4().hex}"
    covers.select("id", "content").write.format(AsideFiles.name()).mode("append").save(aside)
    return finish_exports(spark, directory)


def existing_ids_in_files(spark: SparkSession, directory: str) -> DataFrame:
    """Ids that have a file: by the manifest, or by a listing of a folder that has none. Contents are not read."""
    manifest = read_manifest(spark, directory)
    return (_listed(spark, directory) if manifest is None else manifest).select("id").distinct()
