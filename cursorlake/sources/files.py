"""Table and file inspection (S7 scan_parquet_file, S9 latest_file,
S10 table_files, S11 list_tables, F2 file_name_filter).

The reference's explorer lists an object-store prefix on one machine and
opens the newest file there. Here listings are Spark jobs too: the
``binaryFile`` source lists (and, since ``content`` is never selected, does
not read) the files, and the hidden ``_metadata`` column names the data file
behind each row of a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The explorer's name rules for the file kinds it shows.
FILE_RULES = {
    "metadata": lambda p: p.endswith(".metadata.json"),
    "manifest_list": lambda p: p.contains("snap-") & p.endswith(".avro"),
    "manifest": lambda p: p.endswith("-m0.avro"),
    "data": lambda p: p.endswith(".parquet"),
}


def file_name_filter(path: Column, kind: str) -> Column:
    """the explorer's name predicate for ``kind`` of file."""
    return FILE_RULES[kind](path)


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Every file under ``root`` (recursive): path, length, modificationTime.
    Hidden folders (``_spark_metadata``) and checksum files are skipped."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select("path", "length", "modificationTime")


def latest_file(spark: SparkSession, root: str, kind: str = "data", glob: str | None = None) -> DataFrame:
    """The newest file under ``root`` that matches ``kind``'s rule; no
    row when none does. One aggregate over the listing."""
    files = list_files(spark, root, glob).where(file_name_filter(F.col("path"), kind))
    return (files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path"),
                      F.max("modificationTime").alias("modificationTime"))
                 .where(F.col("path").isNotNull()))


def table_files(table: DataFrame) -> DataFrame:
    """The data files behind a table, with size, time and row count."""
    m = F.col("_metadata")
    return (table.select(m.file_path.alias("file_path"), m.file_size.alias("file_size"),
                         m.file_modification_time.alias("modified"))
                 .groupBy("file_path", "file_size", "modified")
                 .agg(F.count(F.lit(1)).alias("rows")))


def scan_parquet_file(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows of one data file."""
    return spark.read.parquet(path).limit(n)


def list_tables(spark: SparkSession, namespace: str | None = None) -> DataFrame:
    """Namespaces and their (non-temporary) tables, as a DataFrame."""
    dbs = [namespace] if namespace else [d.name for d in spark.catalog.listDatabases()]
    rows = [(db, t.name) for db in dbs for t in spark.catalog.listTables(db) if not t.isTemporary]
    return spark.createDataFrame(rows, "namespace string, table string")
