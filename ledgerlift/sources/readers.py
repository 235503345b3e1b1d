"""CSV and Parquet input."""

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlift.schemas import BRONZE, SILVER, check_schema

#: Files whose first lines are read at the same time.
_AT_ONCE = 16


def read_csv(
    spark: SparkSession, path: str, schema: StructType, by_file: bool = True, **options
) -> DataFrame:
    """CSV with a header: columns by header name, values that do not fit their type become null.

    Files of one folder may have different headers: those with the same one are read by one scan, and
    the scans are put together by column name. A file whose header lacks a column of the schema
    raises an error with its name before anything is read. To know the headers, the first line of
    each file is read by the driver. With ``by_file=False`` none is; then the header of the first file
    must be that of all, and one that differs raises an error when it is read.
    """
    groups = _by_header(spark, path, options) if by_file else [path]
    parts = [_read_one_header(spark, files, schema, options) for files in groups]
    return reduce(DataFrame.unionByName, parts)


def _read_one_header(
    spark: SparkSession, files: str | list[str], schema: StructType, options: dict
) -> DataFrame:
    raw = spark.read.options(header=True, enforceSchema=False, **options).csv(files)
    missing = [name for name in schema.names if name not in raw.columns]
    if missing:
        where = files if isinstance(files, str) else files[0]
        raise ValueError(f"{where}: no column {', '.join(missing)} among {raw.columns}")
    return raw.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema))


def _by_header(spark: SparkSession, path: str, options: dict) -> list[str | list[str]]:
    """The files under a path, those with the same first line together; the path if all have it."""
    files = spark.read.text(path).inputFiles()
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        encoding = options.get("encoding", "UTF-8")
        lines = list(pool.map(lambda file: _first_line(spark, file, encoding), files))
    groups: dict[str, list[str]] = {}
    for file, line in sorted(zip(files, lines, strict=True)):
        if line is not None:  # a file without lines has no rows either
            groups.setdefault(line, []).append(_plain_path(spark, file))
    return list(groups.values()) if len(groups) > 1 else [path]


def _plain_path(spark: SparkSession, uri: str) -> str:
    """A listed file's address as the readers take it, which would find patterns in some names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()
    return re.sub(r"([\\{}\[\]*?,])", r"\\\1", path)


def _first_line(spark: SparkSession, uri: str, encoding: str) -> str | None:
    """The first line of a file that is not blank, unpacked if it is compressed."""
    java, hadoop = spark._jvm.java, spark._jvm.org.apache.hadoop
    conf = spark._jsc.hadoopConfiguration()
    path = hadoop.fs.Path(java.net.URI(uri))
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        content = codec.createInputStream(stream) if codec else stream
        lines = java.io.BufferedReader(java.io.InputStreamReader(content, encoding))
        line = lines.readLine()
        while line is not None and not line.strip():
            line = lines.readLine()
        return line
    finally:
        stream.close()


def read_bronze(spark: SparkSession, path: str, by_file: bool = True) -> DataFrame:
    """Raw transactions, all text; the files' headers may differ, as in ``read_csv``."""
    return read_csv(spark, path, BRONZE, by_file)


def read_silver(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Silver as ``write_table`` wrote it. In CSV an empty category comes back as null."""
    if fmt == "csv":
        return read_csv(spark, path, SILVER, by_file=False, escape='"')
    return check_schema(spark.read.format(fmt).load(path), SILVER)
