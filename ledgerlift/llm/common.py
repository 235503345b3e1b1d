"""Helpers that several operators share."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.sources import delete_folder, scratch_path

#: Where each table of :func:`written` is.
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table to the shared scratch folder and read again.

    This cuts the lineage: what follows survives the loss of any executor without recomputing
    what came before, and reads the same rows each time.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[found] = path
    return found


def discard(*tables: DataFrame) -> None:
    """Deletes tables of :func:`written` whose last reader has been written itself."""
    for found in tables:
        delete_folder(found.sparkSession, _paths.pop(found))


def text_or_empty(column: str = "text") -> Column:
    """The text; null is an empty one."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


#: ASCII white space, as words are split at.
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def words_by_slice(text: bytes, size: int) -> Iterator[list[bytes]]:
    """A text's words with A-Z lower-cased, those of about ``size`` bytes at a time."""
    start = 0
    while start < len(text):
        end = start + size
        found = _SPACE.search(text, end) if end < len(text) else None
        end = found.start() if found else len(text)
        yield text[start:end].lower().split()
        start = end


def parts_for(amount: float, each: float) -> int:
    """How many parts of about ``each`` an ``amount`` needs; one at least."""
    return max(1, math.ceil(amount / each))


def crc_mod(column: str, n: int) -> Column:
    """crc32 of a column as text, modulo ``n``. Null counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % n


def join_by_frequency(rows: DataFrame, facts: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` inner-joined with ``facts``, which has each ``key`` once and how many rows have it.

    Keys with over a thousandth of the rows would fill one task each. There are fewer than a
    thousand of them, so their facts are broadcast, whatever the size of the tables; the others are
    shuffled. ``facts`` should be a written table, as it is read three times. ``count`` is dropped.
    """
    total = facts.agg(F.sum(count)).first()[0] or 0
    frequent = F.col(count) * 1000 > total
    hot = F.broadcast(facts.where(frequent).drop(count))
    cold = facts.where(~frequent).drop(count)
    of_hot = rows.join(hot, key)
    of_cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return of_hot.unionByName(of_cold)
