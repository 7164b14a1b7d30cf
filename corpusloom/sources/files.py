"""Text files as DataFrames, read on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BOOKS_SCHEMA = "file_name STRING, text STRING"

# Stands for itself plus "0" and for U+FFFD plus "1" while bad bytes are removed.
_ESCAPE = "\x1a"
_REPLACEMENT = "\ufffd"


def lines(spark: SparkSession, path: str | list[str], split_bytes: int | None = None) -> DataFrame:
    """One row per line, ended by LF, CR or CRLF; files split at any line.

    ``split_bytes`` bounds the input of one task. It belongs to this read alone:
    the frame comes from a session of its own with the caller's settings.
    """
    if split_bytes is not None:
        spark = session_with(
            spark,
            {
                "spark.sql.files.maxPartitionBytes": str(split_bytes),
                "spark.sql.files.openCostInBytes": "0",
                "spark.sql.files.minPartitionNum": "1",
            },
        )
    return spark.read.schema("value STRING").text(path)


def session_with(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    session = spark.newSession()
    for key, value in {**spark.conf.getAll, **settings}.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    return session


def books(
    spark: SparkSession,
    path: str,
    suffix: str = ".txt",
    skip_unreadable: bool = False,
) -> DataFrame:
    """One row per file directly under ``path`` whose name ends in ``suffix``.

    A file of no bytes is a book with the text ''. Bytes that are not UTF-8 are
    dropped and all line ends become LF. No file gives no rows, with the same
    schema. A file that cannot be read stops the job, as does a name that starts
    with '.' or '_', which Spark does not read. With ``skip_unreadable`` they are
    left out; :func:`unreadable_books` names those.
    """
    reader = (
        spark.read.schema("value STRING")
        .option("ignoreCorruptFiles", skip_unreadable)
        .option("ignoreMissingFiles", skip_unreadable)
    )
    names = f"*{suffix}"
    raw = reader.text(path, wholetext=True, pathGlobFilter=names)
    if raw.columns != ["value"]:
        # folders named key=value below would be read in place of the files here
        raw = reader.text(f"{path}/{names}", wholetext=True)
    text = unix_newlines(valid_text(F.col("value")))
    found = raw.select(file_name().alias("file_name"), text.alias("text"))
    hidden, empty = _passed_over(spark, path, suffix)
    if hidden and not skip_unreadable:
        raise ValueError(f"Spark reads no file whose name starts with '.' or '_': {hidden}")
    if empty:
        found = found.unionByName(_rows(spark, [(name, "") for name in empty], BOOKS_SCHEMA))
    return found


def _passed_over(spark: SparkSession, path: str, suffix: str) -> tuple[list[str], list[str]]:
    """Names of the files Spark passes over: hidden ones, and others of no bytes.

    Only these names reach Python; Spark lists the whole folder on the driver too.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    hidden, empty = [], []
    for status in system.listStatus(folder, hadoop.GlobFilter(f"*{suffix}")):
        if status.isFile():
            name = status.getPath().getName()
            if name.startswith((".", "_")):
                hidden.append(name)
            elif not status.getLen():
                empty.append(name)
    return sorted(hidden), sorted(empty)


def _rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def unreadable_books(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    """Names of the files that :func:`books` leaves out with ``skip_unreadable``."""
    listed = (
        spark.read.format("binaryFile")
        .load(f"{path}/*{suffix}")
        .select(file_name().alias("file_name"))
    )
    loaded = books(spark, path, suffix, skip_unreadable=True).select("file_name")
    hidden, _ = _passed_over(spark, path, suffix)
    unread = listed.join(loaded, "file_name", "left_anti")
    return unread.unionByName(_rows(spark, [(name,) for name in hidden], "file_name STRING"))


def file_name() -> Column:
    """Name of the file a row was read from; Spark hands it out URL-encoded."""
    encoded = F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))
    return F.url_decode(encoded)


def valid_text(value: Column) -> Column:
    """Drop the bytes that are not UTF-8 and keep all others.

    Spark marks bad bytes with U+FFFD. A U+FFFD that was there before is
    escaped meanwhile, so that only the marks go.
    """
    escaped = F.replace(value, F.lit(_ESCAPE), F.lit(_ESCAPE + "0"))
    escaped = F.replace(escaped, F.lit(_REPLACEMENT), F.lit(_ESCAPE + "1"))
    marked = F.make_valid_utf8(escaped)
    kept = F.replace(marked, F.lit(_REPLACEMENT), F.lit(""))
    kept = F.replace(kept, F.lit(_ESCAPE + "1"), F.lit(_REPLACEMENT))
    kept = F.replace(kept, F.lit(_ESCAPE + "0"), F.lit(_ESCAPE))
    return F.when(F.is_valid_utf8(value), value).otherwise(kept)


def unix_newlines(text: Column) -> Column:
    one_char = F.replace(text, F.lit("\r\n"), F.lit("\n"))
    return F.replace(one_char, F.lit("\r"), F.lit("\n"))
