"""Documents that share word n-grams: a similarity self-join by Jaccard index, and its components.

Documents with the same set of n-grams are one class, found by a hash of the set; all that follows
is between classes. Each class has its n-grams in one order, rare ones first by a counting sketch
over all documents, and only a prefix is joined on: two sets above the threshold have a common
n-gram in their prefixes. Length and positional filters drop pairs in the join, then those go that
share too little of their whole prefixes, a suffix filter comes before the sets are compared, and
each pair is compared once.

Near copies of one text share their whole prefix, so a pair for each two of them would be a square.
Instead, the classes that share an n-gram are first compared with one of them, the pivot; links
make components; and only n-grams that still hold several components are looked at again, at the
end with every pair across components. So each pair within the filters is compared, unless its
two classes are known to be connected already: the components are exact. :func:`ngram_join`
compares every pair within the filters, for the number of links of each document.

Defined cases: words are split at ASCII white space with A-Z lower-cased; a text of fewer than
``n`` words is one n-gram of all its words; a null or empty text, or one of white space, has no
n-grams, links with nothing and is its own component; repeated rows, and rows that share an id with
different texts, are documents of their own; a null id takes the least id of its component, if
there is one; an empty table gives no rows; very long texts are cut into words whole, and their
prefix is a share of their n-grams; other columns are ignored, whatever their names. N-grams are compared by
64-bit hashes, and sets and texts by one of these.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import discard, text_or_empty, written
from ledgerlift.llm.components import connected_components

#: Counters of the sketch of how many documents have an n-gram. A fixed size, whatever the input.
SKETCH_BITS = 18
#: Buckets of text hashes of which those with a wanted text are broadcast.
TEXT_BUCKETS = 1 << 20
#: How often classes that share an n-gram are compared with one of them before all are.
PIVOT_ROUNDS = 1

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_FINISH = np.uint64(0xD6E8FEB86659FD93)


class WordHashes(dict):
    """64-bit hashes of words; starts again when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


@lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    return WordHashes()


def shingles(text: bytes, n: int) -> np.ndarray:
    """Ascending distinct hashes of a text's n-grams."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(word_hashes().__getitem__, words), np.uint64, len(words))
    width = min(n, len(words))
    found = np.full(len(words) - width + 1, np.uint64(width))
    for k in range(width):
        found = found * _MULTIPLY + hashes[k : len(hashes) - width + 1 + k]
    found ^= found >> np.uint64(29)
    found *= _FINISH
    found ^= found >> np.uint64(32)
    return np.unique(found)


def class_of(grams: np.ndarray) -> int:
    """Hash of a set of n-grams, as a signed 64-bit integer."""
    return int.from_bytes(blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


def least_overlap(size: Column, other: Column, percent: int) -> Column:
    """Condition factor: the overlap times ``100 + percent`` has to reach this."""
    return percent * (size + other)


def probe_prefix(size: int, percent: int) -> int:
    """Places of a set that has to be found by smaller ones."""
    return size - -(-percent * size // 100) + 1


def index_places(size: Column, percent: int) -> Column:
    """Places of a set that larger ones look into: shorter, since the overlap must be longer."""
    needed = F.ceil(F.lit(2 * percent) * size / (100 + percent))
    return size - needed + 1


def _text_hash() -> Column:
    """Tells texts with one id apart."""
    return F.xxhash64(text_or_empty().cast("binary"))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().cast("binary").alias("text")
    )


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """A row per document with its class and size; and per task rows with its sketch."""
    schema = "doc_id bigint, text_hash bigint, class bigint, size int, bucket int, n bigint"
    names = ["doc_id", "text_hash", "class", "size", "bucket", "n"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
    shift = np.uint64(64 - SKETCH_BITS)

    def rows(*columns) -> pa.RecordBatch:
        size = next(len(c) for c in columns if c is not None)
        arrays = [
            pa.nulls(size, t) if c is None else c if isinstance(c, pa.Array) else pa.array(c, t)
            for c, t in zip(columns, types, strict=True)
        ]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            classes, sizes = [], []
            for text in batch.column("text"):
                grams = shingles(text.as_py(), n)
                classes.append(class_of(grams) if len(grams) else None)
                sizes.append(len(grams))
                np.add.at(sketch, (grams >> shift).astype(np.int64), 1)
            ids, hashes = (batch.column(c) for c in ("doc_id", "text_hash"))
            yield rows(ids, hashes, classes, sizes, None, None)
        used = np.flatnonzero(sketch)
        if len(used):
            yield rows(None, None, None, None, used, sketch[used])

    hashed = _texts(docs).withColumn("text_hash", _text_hash())
    return hashed.mapInArrow(measure, schema)


def _prefixes(docs: DataFrame, n: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """The n-grams of each document's prefix with their places, rare ones first."""
    shift = np.uint64(64 - SKETCH_BITS)
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            found = []
            for text in batch.column("text"):
                grams = shingles(text.as_py(), n)
                if not len(grams):
                    continue
                own = class_of(grams)
                order = np.lexsort((grams, counts[(grams >> shift).astype(np.int64)]))
                prefix = grams[order[: probe_prefix(len(grams), percent)]]
                size = len(prefix)
                found.append(
                    (
                        prefix.view(np.int64),
                        np.full(size, own),
                        np.full(size, len(grams), np.int32),
                        np.arange(size, dtype=np.int32),
                    )
                )
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)],
                    names=["gram", "class", "size", "place"],
                )

    return _texts(docs).mapInArrow(cut, "gram bigint, class bigint, size int, place int")


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """One text of each class in ``wanted`` (``class``, ``text_hash`` of one of its texts).

    The wanted hashes fall into a fixed number of buckets, which is all that is broadcast; texts
    outside them are not shuffled, and copies of one text meet as one per task.
    """
    bucket = F.pmod(F.col("text_hash"), F.lit(TEXT_BUCKETS)).cast("int")
    buckets = wanted.select(bucket.alias("_bucket")).distinct()
    texts = _texts(docs).select("text", _text_hash().alias("text_hash"))
    few = texts.withColumn("_bucket", bucket).join(F.broadcast(buckets), "_bucket", "left_semi")
    return few.dropDuplicates(["text_hash"]).join(wanted, "text_hash").select("class", "text")


def overlap(x: np.ndarray, y: np.ndarray, least: int) -> int:
    """Size of the intersection of two ascending sets; -1 if the suffix filter shows that it
    stays under ``least``."""
    most_apart = len(x) + len(y) - 2 * least

    def apart(x: np.ndarray, y: np.ndarray, levels: int) -> int:
        """Elements that only one side has, at least."""
        if not levels or not len(x) or not len(y):
            return abs(len(x) - len(y))
        cut = x[len(x) // 2]
        i, j = len(x) // 2, int(np.searchsorted(y, cut))
        return apart(x[:i], y[:j], levels - 1) + apart(x[i:], y[j:], levels - 1)

    if apart(x, y, 3) > most_apart:
        return -1
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    return int((large[at] == small).sum())


def _verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose sets reach the threshold, with ``common`` and ``total``.

    Texts are shuffled, not sets: they are smaller.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b, x, y in zip(*batch.columns, strict=True):
                a, b, x, y = a.as_py(), b.as_py(), shingles(x.as_py(), n), shingles(y.as_py(), n)
                least = -(-percent * (len(x) + len(y)) // (100 + percent))
                common = overlap(x, y, least)
                if common >= least:
                    out.append((a, b, common, len(x) + len(y) - common))
            columns = zip(*out, strict=True) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["a", "b", "common", "total"]
            )

    left = texts.select(F.col("class").alias("a"), F.col("text").alias("x"))
    right = texts.select(F.col("class").alias("b"), F.col("text").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return both.mapInArrow(compare, "a bigint, b bigint, common bigint, total bigint")


def _pairs(small: str, large: str, percent: int) -> Column:
    """Roles, length and place of two rows that share an n-gram: the smaller set, or of equal ones
    the smaller class, has it in its shorter prefix; and what follows can still be enough."""
    s, t = (F.struct(F.col(f"{x}.size"), F.col(f"{x}.class")) for x in (small, large))
    size, other = F.col(f"{small}.size"), F.col(f"{large}.size")
    rest = F.least(size - F.col(f"{small}.place"), other - F.col(f"{large}.place"))
    return (
        (s < t)
        & (F.col(f"{small}.place") < index_places(size, percent))
        & (100 * size >= percent * other)
        & ((100 + percent) * rest >= least_overlap(size, other, percent))
    )


def _competitive(pairs: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """The pairs that share enough n-grams of their prefixes to reach the threshold still.

    Of two prefixes one ends first in the common order. All that the sets share up to there is in
    both prefixes; beyond there that set has no more than what its prefix leaves.
    """
    left = held.select(F.col("class").alias("a"), F.col("grams").alias("x"), F.col("size").alias("s"))
    right = held.select(F.col("class").alias("b"), F.col("grams").alias("y"), F.col("size").alias("t"))
    rest = F.ceil(F.greatest("s", "t") * percent / 100) - 1
    most = F.size(F.array_intersect("x", "y")) + rest
    enough = (100 + percent) * most >= least_overlap(F.col("s"), F.col("t"), percent)
    return pairs.join(left, "a").join(right, "b").where(enough).select("a", "b")


def _named(a: str, b: str) -> list[Column]:
    return [F.col(f"{a}.class").alias("a"), F.col(f"{b}.class").alias("b")]


def _with_component(rows: DataFrame, components: DataFrame) -> DataFrame:
    """Rows with the component of their class; one alone is its own."""
    named = components.select(F.col("node").alias("class"), "root")
    return rows.join(named, "class", "left").withColumn("root", F.coalesce("root", "class"))


def _unresolved(rows: DataFrame) -> DataFrame:
    """Rows whose n-gram holds more than one component."""
    mixed = rows.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return rows.join(mixed.where("low < high").select("gram"), "gram", "left_semi")


def ngram_links(
    docs: DataFrame, n: int = 4, percent: int = 85, complete: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes, links and components of ``docs`` (``doc_id``, ``text``).

    Classes: a row per document with ``doc_id``, ``text_hash``, ``class`` (null: no n-grams) and
    ``size``. Links: ``a``, ``b``, ``common`` and ``total`` of pairs of classes that reach the
    threshold; all of them if ``complete``, else those that were compared, which make the same
    components. Components: ``node`` and ``root`` of each linked class. All are written tables.
    """
    measured = written(_sets(docs, n), "sets")
    classes = measured.where(F.col("size").isNotNull()).drop("bucket", "n")
    # One number per counter of the sketch goes to the driver, and the sketch to the tasks.
    sketch = np.zeros(1 << SKETCH_BITS, np.int64)
    used = measured.where(F.col("bucket").isNotNull()).groupBy("bucket").agg(F.sum("n").alias("n"))
    counted = used.toArrow()
    sketch[counted.column("bucket").to_numpy()] = counted.column("n").to_numpy()

    prefixes = written(_prefixes(docs, n, percent, sketch), "prefixes")
    several = prefixes.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = prefixes.join(several.select("gram"), "gram", "left_semi")
    rows = written(shared.dropDuplicates(["gram", "class"]), "shared-grams")
    discard(prefixes)
    # What each class shares of its prefix: at most the prefix of one document.
    of_prefix = rows.groupBy("class").agg(
        F.collect_list("gram").alias("grams"), F.first("size").alias("size")
    )
    held = written(of_prefix, "held-grams")
    # One text of each class stands for it.
    of_class = classes.where(F.col("class").isNotNull()).groupBy("class")
    first = written(of_class.agg(F.min("text_hash").alias("text_hash")), "classes")

    spark = docs.sparkSession
    if complete:
        pairs = written(_competitive(_every(rows, percent).distinct(), held, percent), "pairs")
        links = _compared(docs, pairs, first, n, percent)
        return classes, links, written(connected_components(links), "components")

    links = spark.createDataFrame([], "a bigint, b bigint, common bigint, total bigint")
    tested = spark.createDataFrame([], "a bigint, b bigint")
    components = spark.createDataFrame([], "node bigint, root bigint")
    open_rows = rows.withColumn("root", F.col("class"))
    for round_ in range(PIVOT_ROUNDS + 1):
        if round_ == PIVOT_ROUNDS:
            found = _across(open_rows, percent)
        else:
            found = _with_pivots(open_rows, percent)
        untested = found.distinct().join(tested, ["a", "b"], "left_anti")
        pairs = written(_competitive(untested, held, percent), "pairs")
        if pairs.isEmpty() and round_ == PIVOT_ROUNDS:
            break
        new = _compared(docs, pairs, first, n, percent)
        links, tested = links.unionByName(new), tested.unionByName(pairs)
        components = written(connected_components(links), "components")
        if round_ < PIVOT_ROUNDS:
            joined = _with_component(rows, components)
            open_rows = written(_unresolved(joined), "open-grams")
    return classes, links, components


def _compared(
    docs: DataFrame, pairs: DataFrame, first: DataFrame, n: int, percent: int
) -> DataFrame:
    """The links among ``pairs`` of classes, as a written table; each pair is compared once."""
    compared = pairs.select(F.col("a").alias("class")).unionByName(
        pairs.select(F.col("b").alias("class"))
    )
    wanted = written(first.join(compared.distinct(), "class", "left_semi"), "wanted")
    texts = written(_texts_of(docs, wanted), "compared-texts")
    links = written(_verified(pairs, texts, n, percent), "links")
    discard(wanted, texts)
    return links


def _every(rows: DataFrame, percent: int) -> DataFrame:
    """Every pair of an n-gram's classes within the length and positional filters.

    A class meets only larger ones, in the n-gram's rows by size, so each pair comes once a gram; a
    gram of very many classes is a skewed key, which adaptive execution splits.
    """
    met = rows.alias("x").join(rows.alias("y"), "gram").where(_pairs("x", "y", percent))
    return met.select(*_named("x", "y"))


def _with_pivots(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of each n-gram's classes with one of them, the pivot.

    An edited copy has rare n-grams of its own, so what it shares stands later in its prefix than
    in the text it was made from: the pivot is the class where the n-gram stands first. Where that
    one is already linked, it is the first outside its component.
    """
    one = F.struct("place", "size", "class", "root")
    first = rows.groupBy("gram").agg(F.min(one).alias("first"))
    outside = rows.join(first, "gram").where(F.col("root") != F.col("first.root"))
    linked = rows.groupBy("gram").agg(F.max(F.col("root") != F.col("class")).alias("linked"))
    second = outside.groupBy("gram").agg(F.min(one).alias("second")).join(linked, "gram")
    pivots = first.join(second, "gram").select(
        "gram", F.when(F.col("linked"), F.col("second")).otherwise(F.col("first")).alias("p")
    )
    pairs = rows.alias("r").join(pivots, "gram").where(F.col("r.root") != F.col("p.root"))
    smaller = pairs.where(_pairs("p", "r", percent)).select(*_named("p", "r"))
    larger = pairs.where(_pairs("r", "p", percent)).select(*_named("r", "p"))
    return smaller.unionByName(larger)


def _across(rows: DataFrame, percent: int) -> DataFrame:
    """Every pair of an n-gram's classes in different components.

    In each, the rows outside the largest component meet all rows, so that one large component
    with a few strangers makes no square.
    """
    sizes = rows.groupBy("gram", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("gram").agg(F.max_by("root", F.struct("n", "root")).alias("largest"))
    others = rows.join(largest, "gram").where(F.col("root") != F.col("largest"))
    met = others.alias("x").join(rows.alias("y"), "gram").where(F.col("x.root") != F.col("y.root"))
    smaller = met.where(_pairs("x", "y", percent)).select(*_named("x", "y"))
    larger = met.where(_pairs("y", "x", percent)).select(*_named("y", "x"))
    return smaller.unionByName(larger)


def _labels(classes: DataFrame, components: DataFrame) -> DataFrame:
    """``class``, ``root`` and ``component_id`` of each class."""
    own = classes.where(F.col("class").isNotNull()).groupBy("class")
    rooted = _with_component(own.agg(F.min("doc_id").alias("least")), components)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return written(rooted.join(least, "root").select("class", "root", "component_id"), "labels")


def ngram_components(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``class_id`` of each document.

    ``component_id`` is the smallest ``doc_id`` reachable by links, the document's own included.
    """
    classes, _, components = ngram_links(docs, n, percent)
    return _labelled(classes, _labels(classes, components))


def _labelled(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per document with its label and those of its class."""
    return classes.join(labels, "class", "left").select(
        "doc_id",
        F.col("size").cast("bigint").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("doc_id"))
        .otherwise(F.col("component_id"))
        .alias("component_id"),
        F.col("class").alias("class_id"),
        *(c for c in labels.columns if c not in ("class", "root", "component_id")),
    )


def ngram_join(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """The columns of :func:`ngram_components` with ``n_links``, the documents that each links with.

    Every pair of different texts within the filters is compared, so a group of near copies costs the
    square of its texts, as many as it has links. Copies of a text count as links of each other, and
    each as a link of what the text links with, without being compared.
    """
    classes, links, components = ngram_links(docs, n, percent, complete=True)
    sizes = classes.where(F.col("class").isNotNull()).groupBy("class")
    sizes = written(sizes.agg(F.count(F.lit(1)).alias("n_copies")), "copies")
    ends = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = sizes.select(F.col("class").alias("b"), "n_copies")
    linked = ends.join(others, "b").groupBy(F.col("a").alias("class"))
    counts = sizes.join(linked.agg(F.sum("n_copies").alias("others")), "class", "left").select(
        "class", (F.col("n_copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    )
    labels = _labels(classes, components).join(counts, "class")
    return _labelled(classes, labels).withColumn("n_links", F.coalesce("n_links", F.lit(0)))


def keep_one(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` of which each stands for its component: that of the smallest id.

    Rows without n-grams stay; rows that repeat both id and text become one.
    """
    classes, _, components = ngram_links(docs, n, percent)
    roots = _labels(classes, components).select("class", "root")
    named = classes.join(roots, "class", "left")
    with_grams = named.where(F.col("class").isNotNull()).groupBy("root")
    one = with_grams.agg(
        F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash"))).alias("m")
    ).select(F.col("m.doc_id").alias("_id"), F.col("m.text_hash").alias("_text_hash"))
    empty = named.where(F.col("class").isNull()).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_text_hash")
    )
    kept = one.unionByName(empty.distinct())
    # Beside the row, so that no column of the documents can clash.
    rows = docs.select(F.struct("*").alias("row"), "doc_id", _text_hash().alias("own_hash"))
    same = rows["doc_id"].eqNullSafe(kept["_id"]) & (rows["own_hash"] == kept["_text_hash"])
    return (
        rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", "own_hash"]).select("row.*")
    )
