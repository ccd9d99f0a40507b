"""What a route can read from and write to.

Every endpoint that normally lives in a service (a database, a wide-column
store, a message broker, a search cluster) can also be given as a ``folder``:
the same data kept as Parquet on any Hadoop file system. Exactly one of the
two must be set.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql.types import StructType

SAVE_MODES = ("overwrite", "append", "errorifexists", "ignore")


# --- file formats ----------------------------------------------------------


@dataclass(frozen=True)
class Json:
    """JSON Lines."""


@dataclass(frozen=True)
class Csv:
    """Delimited text.

    Spark splits large files. ``multiline`` keeps line breaks inside quoted
    values whole, at the price of one task per file.
    """

    separator: str = ","
    header: bool = True
    infer_schema: bool = False
    multiline: bool = False


@dataclass(frozen=True)
class Parquet:
    compression: str | None = None


@dataclass(frozen=True)
class Orc:
    compression: str | None = None


@dataclass(frozen=True)
class Avro:
    """Object container files."""


@dataclass(frozen=True)
class Xml:
    root_tag: str = "ROWS"
    row_tag: str = "ROW"


@dataclass(frozen=True)
class Xlsx:
    """Workbooks with a header row; one workbook per writing task and row cap."""

    sheet: str = "rows"
    rows_per_workbook: int = 1_000_000


FileFormat = Json | Csv | Parquet | Orc | Avro | Xml | Xlsx


# --- how a topic is consumed -----------------------------------------------


@dataclass(frozen=True)
class Batch:
    """Read the whole topic once."""


@dataclass(frozen=True)
class Timed:
    """Poll the topic every ``seconds``."""

    seconds: float = 5


@dataclass(frozen=True)
class Continuous:
    """Process messages as soon as they arrive."""


@dataclass(frozen=True)
class AvailableNow:
    """Read everything not read before (per checkpoint), then stop."""


ConsumerMode = Batch | Timed | Continuous | AvailableNow


# --- endpoints -------------------------------------------------------------


@dataclass(frozen=True)
class End:
    """One end of a route: the kind of endpoint, where it is, what is read or written there, and how."""

    kind: str
    place: str
    name: str
    detail: str = ""


def _one_backend(**backends: str | None) -> None:
    if sum(value is not None for value in backends.values()) != 1:
        raise ValueError(f"set exactly one of {', '.join(backends)}")


@dataclass(frozen=True)
class File:
    """A folder of files, sub-folders included.

    ``schema`` spares the inference pass and keeps types exact. With
    ``datasets`` the relative sub-folder of every file (and the file's bare name,
    for workbooks) is carried in a ``dataset`` column and written back as one
    sub-folder per dataset.
    ``checkpoint`` makes the read process-once: each file is read by one run
    only, and moved to ``archive`` afterwards when that is set;
    ``files_per_batch`` splits a large run into batches that commit one by one.
    """

    format: FileFormat
    path: str
    schema: StructType | None = field(default=None, compare=False)
    datasets: bool = False
    single_file: bool = False
    rebalance: bool = False
    checkpoint: str | None = None
    archive: str | None = None
    files_per_batch: int | None = None

    def end(self) -> End:
        return End("file", self.path, self.path.rstrip("/").rpartition("/")[2], type(self.format).__name__.lower())


@dataclass(frozen=True)
class RelationalTable:
    """A relational table over JDBC (``url``) or kept in a ``folder``.

    ``partition_column`` splits a JDBC read into ``num_partitions`` ranges, and a
    write uses at most as many connections. ``properties`` are further connector
    options (user, driver, truncate, ...). ``bounds`` are the ends of the ranges;
    unset, the database is asked for them.
    """

    table: str
    url: str | None = None
    folder: str | None = None
    properties: Mapping[str, str] = field(default_factory=dict, compare=False)
    partition_column: str | None = None
    bounds: tuple | None = None
    num_partitions: int = 8
    batch_size: int = 10_000

    def __post_init__(self):
        _one_backend(url=self.url, folder=self.folder)

    def end(self) -> End:
        return End("relational", self.url or self.folder, self.table)


@dataclass(frozen=True)
class KeyedTable:
    """A table in which a write to an existing key replaces the row.

    ``hosts`` names the wide-column store. With ``folder`` the primary ``keys``
    must be given; ``order_by`` decides which of several rows with one key in
    the same write wins (the greatest).
    """

    keyspace: str
    table: str
    hosts: str | None = None
    folder: str | None = None
    keys: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()

    def __post_init__(self):
        _one_backend(hosts=self.hosts, folder=self.folder)
        if self.folder is not None and not self.keys:
            raise ValueError("a keyed table in a folder needs its keys")

    def end(self) -> End:
        return End("keyed", self.hosts or self.folder, self.table, self.keyspace)


@dataclass(frozen=True)
class Index:
    """A document index: every row carries its ``_id``.

    ``id_column`` takes the ids from the data on write (random otherwise);
    ``bulk_size`` is the number of documents per request (1 = one by one).
    """

    name: str
    nodes: str | None = None
    folder: str | None = None
    id_column: str | None = None
    bulk_size: int = 1000

    def __post_init__(self):
        _one_backend(nodes=self.nodes, folder=self.folder)

    def end(self) -> End:
        return End("index", self.nodes or self.folder, self.name)


@dataclass(frozen=True)
class Topic:
    """A message topic; keys and values are bytes, values usually JSON rows.

    Reading: ``mode`` and ``offset`` say how and from where, ``schema`` types
    the JSON values (inferred in batch when unset), ``malformed`` is ``fail``,
    ``keep`` (a ``_corrupt_record`` column) or a folder for the bad messages.
    Writing: ``key`` is None, ``uuid`` or the name of a column. ``checkpoint``
    holds the progress of a streaming read. A mirrored topic keeps its keys
    unless ``keep_key`` is off. ``options`` go to the broker's source and sink.
    """

    name: str
    brokers: str | None = None
    folder: str | None = None
    mode: ConsumerMode = Batch()
    offset: str = "earliest"
    schema: StructType | None = field(default=None, compare=False)
    malformed: str = "fail"
    key: str | None = None
    keep_key: bool = True
    checkpoint: str | None = None
    options: Mapping[str, str] = field(default_factory=dict, compare=False)

    def __post_init__(self):
        _one_backend(brokers=self.brokers, folder=self.folder)
        if self.offset not in ("earliest", "latest"):
            raise ValueError("offset must be 'earliest' or 'latest'")

    @property
    def streaming(self) -> bool:
        return not isinstance(self.mode, Batch)

    def end(self) -> End:
        return End("topic", self.brokers or self.folder, self.name, type(self.mode).__name__.lower())


Endpoint = File | RelationalTable | KeyedTable | Index | Topic
