"""Scans and sinks (Parquet, CSV, JSON), view registration, manifests."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscope.session import cut_lineage, options
from ledgerscope.sources.schemas import RAW


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def is_folder(spark: SparkSession, path: str) -> bool:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath) and fs.getFileStatus(jpath).isDirectory()


def safe_read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan with an explicit schema; a missing path gives an empty table
    that keeps the schema (so downstream plans still resolve)."""
    if not _exists(spark, path):
        if schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return safe_read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", RAW.get(name))


def safe_write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_json_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON source that accepts a top-level array of records or a single object."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Register each given DataFrame as a temp view; return the names registered."""
    names = []
    for name, df in tables.items():
        if df is None:
            continue
        df.createOrReplaceTempView(name)
        names.append(name)
    return names


def assert_required_columns(df: DataFrame, required: list[str], name: str = "dataframe") -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{name} is missing required columns: {missing}")


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Order-free fingerprint of a table: row count and sum of row hashes (a sum,
    since equal rows would cancel out in an XOR).

    Computed with one partial aggregate per partition; independent of file
    order and of the partitioning."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias("fingerprint"),
    )


def file_below(path: Column, table: str) -> Column:
    """``table`` itself, or table/part-file, from a full path."""
    at = re.escape(table)
    return F.regexp_extract(path, rf"/({at}(?:/[^/]+)*)$", 1)


#: One task for each file, in its order: no split, and nothing packed beside it.
WHOLE_FILES = {"spark.sql.files.maxPartitionBytes": str(1 << 42), "spark.sql.files.openCostInBytes": str(1 << 42)}


def _digests(batches):
    """Pieces between line feeds (path, size of the file, piece), file by file and in order
    -> SHA-256 of each file. The last piece has no line feed after it unless the file has."""
    import hashlib

    import pyarrow as pa

    names = ["_p", "sha256"]
    done, here, size, digest, seen = [], None, 0, None, 0

    def leave():
        nonlocal seen
        if here is not None:
            if seen < size:  # the line feed that ends the file
                digest.update(b"\n")
            if size - seen > 1:  # a byte order mark is skipped; no Parquet file begins with one
                raise ValueError(f"{seen} of {size} bytes read: {here}")
            done.append((here, digest.hexdigest()))

    for b in batches:
        paths = b.column(0).dictionary_encode()
        codes, known = paths.indices.to_numpy(), paths.dictionary.to_pylist()
        sizes, pieces, at = b.column(1), b.column(2).to_pylist(), 0
        while at < len(pieces):
            path = known[codes[at]]
            others = (codes[at:] != codes[at]).nonzero()[0]
            to = at + int(others[0]) if len(others) else len(pieces)
            text = b"\n".join(pieces[at:to])
            if path == here:
                text = b"\n" + text
            else:
                leave()
                here, size, digest, seen = path, sizes[at].as_py(), hashlib.sha256(), 0
            digest.update(text)
            seen, at = seen + len(text), to
    leave()
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=names)


def file_manifest(spark: SparkSession, directory: str, glob: str = "*.parquet") -> DataFrame:
    """SHA-256 and size per file, hashed on the executors, also of part files in table
    folders. A file of any size streams through its task in pieces between line feeds (the
    text source keeps their bytes); whole contents as one value end at 2 GB and need as
    much memory."""
    listed = lambda source: spark.read.format(source).option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    place = F.col("_metadata.file_path")
    files = listed("binaryFile").load(directory).select("path", "length", place.alias("_p"))
    text = listed("text").option("lineSep", "\n").load(directory)
    pieces = text.select(place.alias("path"), F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary"))
    with options(spark, WHOLE_FILES):
        digests = cut_lineage(pieces.mapInArrow(_digests, "_p string, sha256 string"))
    files = files.join(digests, "_p", "left")
    root = rf"/{re.escape(directory.rstrip('/').rpartition('/')[2])}/([^/]+\.parquet(?:/[^/]+)*)$"
    name = F.regexp_extract("path", root, 1)
    return files.select(
        name.alias("file"),
        F.split_part(name, F.lit("/"), F.lit(1)).alias("table"),
        F.col("length").alias("bytes"),
        "sha256",
    )
