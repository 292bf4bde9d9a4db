"""Listings of source documents and the facts their paths carry."""

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Tasks of a listing for each task that can run at once.
LISTING_TASKS = 8
_LISTING_PARALLELISM = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: Bytes that opening a file counts for when small files are dealt to tasks. Spark's four megabytes make a task of every few files.
OPEN_BYTES = 1 << 18
_OPEN_COST = "spark.sql.files.openCostInBytes"


def lower_listing_tasks(spark: SparkSession) -> str:
    """Many folders are listed by a few tasks from now on; returns the setting before, and a lower one stays. By itself Spark starts a task a
    folder, up to ten thousand, and starting them takes many times longer than listing."""
    given = spark.conf.get(_LISTING_PARALLELISM)
    spark.conf.set(_LISTING_PARALLELISM, str(min(int(given), LISTING_TASKS * spark.sparkContext.defaultParallelism)))
    return given


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Readers made in here list by a few tasks; the session's setting is put back."""
    given = lower_listing_tasks(spark)
    try:
        yield
    finally:
        spark.conf.set(_LISTING_PARALLELISM, given)


def _bytes(size: str) -> int:
    """A size as settings give it, such as ``4MB``."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)i?b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


@contextmanager
def few_scan_tasks(spark: SparkSession) -> Iterator[None]:
    """Scans that run in here take many small files a task: starting tasks, and the files each of them writes, cost far more than opening
    small files, and the driver keeps a record of each. The session's setting is put back, and a lower one stays."""
    given = spark.conf.get(_OPEN_COST)
    spark.conf.set(_OPEN_COST, str(min(_bytes(given), OPEN_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(_OPEN_COST, given)


# These are worked out for each row of a scan, so they are plain cuts of the text: patterns took most of a scan's time.

def file_path() -> Column:
    """Path of the scanned file of a row, as listings spell it: Spark's own column has blanks and signs encoded as in an address."""
    address = F.col("_metadata.file_path")
    return F.when(F.contains(address, F.lit("%")), F.url_decode(F.replace(address, F.lit("+"), F.lit("%2B")))).otherwise(address)


def document_path(path: Column) -> Column:
    """Path of the document a scanned file belongs to.

    A CSV that Spark wrote is a folder ``name.csv`` of part files; its name is the folder's. Elsewhere ``part-`` is just a name.
    """
    folder = F.substring(path, F.lit(1), F.length(path) - F.length(F.substring_index(path, "/", -1)) - 1)
    part = F.startswith(F.substring_index(path, "/", -1), F.lit("part-")) & F.endswith(folder, F.lit(".csv"))
    return F.when(part, folder).otherwise(path)


def _last_name(path: Column) -> Column:
    return F.substring_index(F.substring_index(path, "/", -1), "=", -1)


def document_name(path: Column) -> Column:
    """Base name of a document, without a ``column=`` prefix of a partition folder."""
    return _last_name(F.rtrim(document_path(path), F.lit("/")))


def stem(name: Column, suffix: str = ".csv") -> Column:
    """Name without its suffix, as used for the table or output made from a file."""
    return F.replace(name, F.lit(suffix), F.lit(""))


def report_year(path: Column) -> Column:
    """First run of four digits in a document's base name; NULL when there is none."""
    return F.regexp_extract(_last_name(path), r"(\d{4})", 1).try_cast("int")


def ticker_of_uri(path: Column) -> Column:
    """First folder below the bucket of ``scheme://bucket/...``."""
    return F.nullif(F.regexp_extract(path, r"^[A-Za-z0-9+.-]+://[^/]*/([^/]+)", 1), F.lit(""))


def _listing(spark: SparkSession, paths: str | list[str], pattern: str, **options: str) -> DataFrame:
    # Only path and length are kept, so file contents are never read.
    with few_listing_tasks(spark):
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", pattern)
            .options(**options)
            .load(paths)
        )
    return files.select("path", "length", "modificationTime")


def list_pdfs(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All ``.pdf`` files below ``paths``, any letter case."""
    return _listing(spark, paths, "*.[pP][dD][fF]").select("path", "length")


def csv_files(spark: SparkSession, paths: str | list[str], **options: str) -> DataFrame:
    """All CSV files below ``paths``, part files one by one: ``path, length, modificationTime``."""
    return _listing(spark, paths, "*.csv", **options)


def list_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All files below ``paths``: ``path, length``."""
    return _listing(spark, paths, "*").select("path", "length")


def literal_path(path: str) -> str:
    """A listed path as readers take it: signs of patterns stand for themselves."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def modified_since(files: DataFrame) -> dict[str, str]:
    """Reader option that leaves older files than all of ``files`` out of a listing; runs one aggregate of ``modificationTime``."""
    before = F.min("modificationTime") - F.expr("INTERVAL 1 SECOND")
    found = files.agg(F.date_format(before, "yyyy-MM-dd'T'HH:mm:ss").alias("since")).first().since
    return {"modifiedAfter": found} if found else {}


def list_csvs(spark: SparkSession, paths: str | list[str], **options: str) -> DataFrame:
    """All CSV documents below ``paths``, one row each. Spark leaves files of no bytes out of listings."""
    return (
        csv_files(spark, paths, **options)
        .groupBy(document_path(F.col("path")).alias("path"))
        .agg(F.sum("length").alias("length"))
    )


def not_yet_done(listing: DataFrame, done: DataFrame, done_name: str = "name") -> DataFrame:
    """Documents whose base name (without extension) has no output yet."""
    todo = listing.withColumn("name", F.regexp_replace(document_name(F.col("path")), r"\.[^.]*$", ""))
    names = done.select(F.col(done_name).alias("name")).distinct()
    return todo.join(names, "name", "left_anti")
