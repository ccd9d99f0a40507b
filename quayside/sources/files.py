"""Reading and writing folders of files in the seven formats."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, NumericType, StringType, StructField, StructType

from quayside.endpoints import Avro, Csv, File, FileFormat, Json, Orc, Parquet, Xlsx, Xml
from quayside.functions.messages import CORRUPT
from quayside.sources import storage, xlsx

# Spark ships its Avro file format, only the short name is in another package.
AVRO_SOURCE = "org.apache.spark.sql.avro.AvroFileFormat"

# Spark reads an XML file in one task, so a task that writes many rows writes several files.
XML_ROWS = 50_000
MOST_ROWS = "spark.sql.files.maxRecordsPerFile"

# Text formats cut timestamps to milliseconds unless told otherwise.
MICROS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}


def source_name(fmt: FileFormat) -> str:
    """Name of the Spark data source of a format."""
    return AVRO_SOURCE if isinstance(fmt, Avro) else type(fmt).__name__.lower()


def _csv_options(fmt: Csv) -> dict:
    return {
        "sep": fmt.separator,
        "header": fmt.header,
        "quote": '"',
        "escape": '"',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        **MICROS,
    }


def read_options(fmt: FileFormat, schema: StructType | None) -> dict:
    if isinstance(fmt, (Parquet, Orc)):
        # Without a schema, one file's columns need not be all.
        return {"mergeSchema": schema is None}
    if not isinstance(fmt, (Csv, Json, Xml)):
        return {}
    options = dict(MICROS)
    if schema is not None and CORRUPT not in schema.names:
        # Without a column for them, malformed records must not turn into NULLs.
        options["mode"] = "FAILFAST"
    if isinstance(fmt, Csv):
        # An empty value is NULL, a quoted empty value is the empty string.
        options |= _csv_options(fmt) | {"nullValue": "\0", "multiLine": fmt.multiline}
        options |= {"inferSchema": fmt.infer_schema and schema is None, "enforceSchema": not fmt.header}
    if isinstance(fmt, Xml):
        options |= {"rowTag": fmt.row_tag, "ignoreSurroundingSpaces": schema is None}
    return options


def write_options(fmt: FileFormat) -> dict:
    if isinstance(fmt, Csv):
        return _csv_options(fmt)
    if isinstance(fmt, Xml):
        return {"rootTag": fmt.root_tag, "rowTag": fmt.row_tag} | MICROS
    if isinstance(fmt, Json):
        return dict(MICROS)
    if isinstance(fmt, (Parquet, Orc)):
        return {"compression": fmt.compression or "none"}
    return {}


def load(spark: SparkSession, endpoint: File, stream: bool = False) -> DataFrame:
    """One scan over all files below the path, as a batch or as a stream of new files."""
    fmt, schema = endpoint.format, endpoint.schema
    reader = (spark.readStream if stream else spark.read).option("recursiveFileLookup", True)
    if stream and endpoint.files_per_batch:
        reader = reader.option("maxFilesPerTrigger", endpoint.files_per_batch)
    if stream and endpoint.archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", endpoint.archive)
    if isinstance(fmt, Xlsx):
        files = reader.format("binaryFile").schema(xlsx.BINARY_FILE).option("pathGlobFilter", "*.xlsx")
        rows = xlsx.read_workbooks(files.load(endpoint.path), schema)
        file_path = F.col(xlsx.FILE_COLUMN)
    else:
        reader = reader.format(source_name(fmt)).options(**read_options(fmt, schema))
        groups = files_by_header(spark, endpoint) if isinstance(fmt, Csv) and fmt.header and not stream else []
        if len(groups) > 1:
            return _united([_of_group(spark, endpoint, paths) for paths in groups], schema)
        rows = (reader if schema is None else reader.schema(schema)).load(endpoint.path)
        file_path = _decoded(F.col("_metadata.file_path"))
    if endpoint.datasets:
        root = storage.qualified(spark, endpoint.path)
        rows = rows.withColumn("dataset", dataset_of(file_path, root, per_file=isinstance(fmt, Xlsx)))
    return rows.drop(xlsx.FILE_COLUMN)


def files_by_header(spark: SparkSession, endpoint: File) -> list[list[str]]:
    """The files of a CSV folder, those with the same first line together; empty ones are left out.

    Only first lines are read, by threads of the driver, which has listed the files anyway.
    """
    found = spark.read.option("recursiveFileLookup", True).text(endpoint.path).inputFiles()
    paths = sorted(unquote(path) for path in found)
    if len(paths) < 2:
        return [paths]
    with ThreadPoolExecutor(min(32, len(paths))) as threads:
        headers = list(threads.map(lambda path: storage.first_line(spark, path), paths))
    groups: dict[bytes, list[str]] = {}
    for path, header in zip(paths, headers, strict=True):
        header = header.removeprefix(b"\xef\xbb\xbf").rstrip(b"\r")
        if header:
            groups.setdefault(header, []).append(path)
    return list(groups.values())


def _of_group(spark: SparkSession, endpoint: File, paths: list[str]) -> DataFrame:
    """Files with the same columns, in one scan; columns that a schema does not have are left out."""
    fmt, schema = endpoint.format, endpoint.schema
    escaped = [re.sub(r"([\[\]{}*?\\])", r"\\\1", path) for path in paths]  # names are no patterns
    reader = spark.read.format("csv").options(**read_options(fmt, schema))
    if schema is None and fmt.infer_schema:
        rows = reader.load(escaped)
    else:
        header = read_options(fmt, None) | {"inferSchema": False, "multiLine": False}
        names = spark.read.format("csv").options(**header).load(escaped).columns
        known = {} if schema is None else {field.name: field for field in schema.fields}
        wanted = [known.get(name, StructField(name, StringType())) for name in names]
        corrupt = [known[CORRUPT]] if CORRUPT in known else []
        rows = reader.schema(StructType(wanted + corrupt)).load(escaped)
    if schema is not None:
        rows = rows.select(*[f"`{n}`" for n in rows.columns if n in schema.names], *(["_metadata"] if endpoint.datasets else []))
    if not endpoint.datasets:
        return rows
    root = storage.qualified(spark, endpoint.path)
    return rows.withColumn("dataset", dataset_of(_decoded(F.col("_metadata.file_path")), root)).drop("_metadata")


def _united(groups: list[DataFrame], schema: StructType | None) -> DataFrame:
    """All rows with all columns, NULL where a file does not have one; strings where files differ in more than the size of numbers."""
    kinds: dict[str, list] = {}
    for group in groups:
        for field in group.schema.fields:
            kinds.setdefault(field.name, []).append(field.dataType)
    mixed = {n for n, k in kinds.items() if len({*k}) > 1 and not all(isinstance(x, NumericType) for x in k)}
    groups = [g.withColumns({n: F.col(f"`{n}`").cast("string") for n in mixed if n in g.columns}) if mixed else g for g in groups]
    rows = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), groups)
    if schema is None:
        return rows
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in rows.columns}
    rows = rows.withColumns(missing) if missing else rows
    return rows.select(*[f"`{n}`" for n in schema.names], *(["dataset"] if "dataset" in rows.columns and "dataset" not in schema.names else []))


def _decoded(text: Column) -> Column:
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def dataset_of(path: Column, root: str, per_file: bool = False) -> Column:
    """Folder of a file relative to the root, ``.`` for the root itself.

    The bare name of the file is added where each file is a dataset. A folder
    written per dataset (``dataset=name``), by a stream also per batch
    (``batch-…``), gives that name back.
    """
    below_root = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:/+", "/")
    base = root.partition(":")[2] if ":" in root else root
    start = len("/" + base.strip("/")) + 2
    relative = F.regexp_replace(F.substr(below_root, F.lit(start)), r"^batch-[^/]*/", "")
    folder = F.regexp_replace(relative, r"/?[^/]*$", "")
    written = F.regexp_extract(folder, "^dataset=(.*)$", 1)
    name = F.regexp_replace(relative, r"\.[^./]*$", "") if per_file else folder
    return F.when(written != "", _decoded(written)).when(name == "", F.lit(".")).otherwise(name)


def _check_flat(frame: DataFrame, fmt: FileFormat) -> None:
    nested = [f.name for f in frame.schema.fields if isinstance(f.dataType, (ArrayType, MapType, StructType))]
    if nested and isinstance(fmt, (Csv, Xlsx)):
        raise TypeError(f"{type(fmt).__name__} cannot hold nested columns: {', '.join(nested)}")


def _existing_datasets(spark: SparkSession, path: str) -> list[str]:
    if not storage.exists(spark, path):
        return []
    return [unquote(n.removeprefix("dataset=")) for n in storage.sub_folders(spark, path) if n.startswith("dataset=")]


def _new_datasets(frame: DataFrame, endpoint: File, mode: str) -> tuple[DataFrame, str]:
    """Each dataset is saved on its own: the rows to write and the mode that is left to Spark."""
    existing = _existing_datasets(frame.sparkSession, endpoint.path)
    if mode in ("overwrite", "append"):
        return frame, mode
    exists = F.col("dataset").isin(existing)
    if mode == "ignore":
        return frame.where(~exists), "append"
    refusal = F.raise_error(F.concat(F.lit("dataset already exists: "), "dataset")).cast("string")
    return frame.withColumn("dataset", F.when(exists, refusal).otherwise(F.col("dataset"))), "append"


def write(frame: DataFrame, endpoint: File, mode: str) -> None:
    """Write the rows as files; with datasets the save mode holds for each of them."""
    fmt = endpoint.format
    _check_flat(frame, fmt)
    if endpoint.single_file:
        frame = frame.coalesce(1)
    elif endpoint.rebalance:
        frame = frame.hint("rebalance", *(["dataset"] if endpoint.datasets else []))
    if endpoint.datasets:
        frame, mode = _new_datasets(frame, endpoint, mode)
    if isinstance(fmt, Xlsx):
        _write_workbooks(frame, endpoint, mode)
        return
    writer = frame.write.format(source_name(fmt)).options(**write_options(fmt))
    if isinstance(fmt, Xml) and not endpoint.single_file and int(frame.sparkSession.conf.get(MOST_ROWS)) <= 0:
        writer = writer.option("maxRecordsPerFile", XML_ROWS)
    if endpoint.datasets:
        writer = writer.partitionBy("dataset").option("partitionOverwriteMode", "dynamic")
    writer.mode(mode).save(endpoint.path)


def _write_workbooks(frame: DataFrame, endpoint: File, mode: str) -> None:
    if not endpoint.datasets and storage.has_visible(frame.sparkSession, endpoint.path):
        if mode == "ignore":
            return
        if mode == "errorifexists":
            raise FileExistsError(f"path {endpoint.path} already exists")
    by = "dataset" if endpoint.datasets else None
    fmt = endpoint.format
    xlsx.write_workbooks(frame, endpoint.path, mode == "overwrite", fmt.sheet, fmt.rows_per_workbook, by)
