"""Writing a format that Spark has no writer for: part files by Python tasks.

Spark partitions the rows; each task streams its own part files into a hidden
staging folder on the target's file system and returns their names. Once all
tasks have succeeded, a second job moves the named files into place. A task that
is lost or runs twice leaves only staged files that nobody names, and a write
that fails leaves no trace.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from quayside.sources import storage

# Ship this code with the tasks: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def file_system(uri: str):
    """Arrow file system and plain path of a qualified path."""
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def _by_folder(batch: pa.RecordBatch, by: str | None) -> Iterator[tuple[str, pa.RecordBatch]]:
    """The rows of each sub-folder, named after the values of a column."""
    if by is None:
        yield "", batch
        return
    values, rest = batch.column(by), batch.drop_columns([by])
    for value in pc.unique(values).to_pylist():
        yield f"{by}={quote(str(value), safe=' .')}/", rest.filter(pc.equal(values, value))


def task_writer(stage: str, suffix: str, rows_per_file: int, by: str | None, open_part: Callable) -> Callable:
    """Function from batches of rows to batches of the names of the part files that hold them.

    ``open_part(stream)`` gives an object with ``write(batch)`` and ``close()``.
    Rows come sorted by their folder, so one part file is open at a time.
    """

    def write(batches):
        fs, root = file_system(stage)
        names: list[str] = []
        part, stream, at, size = None, None, None, 0

        def close() -> None:
            if part is not None:
                part.close()
                stream.close()

        for batch in batches:
            for folder, rows in _by_folder(batch, by):
                done = 0
                while done < rows.num_rows:
                    if part is None or folder != at or size == rows_per_file:
                        close()
                        names.append(f"{folder}part-{uuid.uuid4().hex}{suffix}")
                        fs.create_dir(f"{root}/{folder}", recursive=True)
                        stream = fs.open_output_stream(f"{root}/{names[-1]}", compression=None)
                        part, at, size = open_part(stream), folder, 0
                    take = min(rows_per_file - size, rows.num_rows - done)
                    part.write(rows.slice(done, take))
                    size += take
                    done += take
        close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["name"])

    return write


def task_mover(stage: str, target: str) -> Callable:
    """Function that moves named files into place; one that is there already was moved by a lost task."""

    def move(batches):
        fs, source = file_system(stage)
        _, root = file_system(target)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                if fs.get_file_info(f"{source}/{name}").type == pafs.FileType.NotFound:
                    if fs.get_file_info(f"{root}/{name}").type != pafs.FileType.NotFound:
                        continue
                fs.create_dir(f"{root}/{name}".rpartition("/")[0], recursive=True)
                fs.move(f"{source}/{name}", f"{root}/{name}")
            yield batch

    return move


def write_part_files(
    frame: DataFrame, path: str, overwrite: bool, suffix: str, rows_per_file: int, by: str | None, open_part: Callable
) -> None:
    """Write the rows as part files; only the names of the files reach the driver.

    With ``by``, an overwrite replaces the sub-folders that get rows and leaves the rest.
    """
    spark = frame.sparkSession
    root = storage.qualified(spark, path)
    was_there = storage.exists(spark, root)
    if by is not None:
        frame = frame.sortWithinPartitions(by)
    stage = f"{root}/_staging-{uuid.uuid4().hex}"
    try:
        task = task_writer(stage, suffix, rows_per_file, by, open_part)
        names = [row["name"] for row in frame.mapInArrow(task, "name string").collect()]
        storage.make_folder(spark, root)
        if overwrite and by is None:
            storage.delete_visible(spark, root)
        elif overwrite:
            for folder in {name.rpartition("/")[0] for name in names}:
                storage.delete(spark, f"{root}/{folder}")
        if names:
            listed = spark.createDataFrame(pa.table({"name": pa.array(names, pa.string())}))
            moved = listed.repartition(min(len(names), 200)).mapInArrow(task_mover(stage, root), "name string")
            moved.write.format("noop").mode("overwrite").save()
        was_there = True
    finally:
        storage.delete(spark, stage)
        if not was_there:
            storage.delete(spark, root)
