"""A quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text has a lookup table over its bins, and a few pairs of features have tables
over both. Boosting goes round the features, each round adding one shallow tree on one feature's
histogram to its table; when these are done, the pairs that explain most of what is left get
theirs, tree by tree. A score is the sum of the looked-up values through the logistic function.

The model is fitted on the driver with at most ``max_rows`` labelled documents, a documented bound
that no input exceeds; scoring is one pass over all documents in Arrow batches.

Defined cases: a null or empty text has the features of an empty one and a score like any other;
labels that are null or of unknown documents are left out, repeated labels are examples each;
without labels every score is 0.5, with labels of one class the score leans to that class;
repeated rows and null ids are scored each; a very long text is split into words whole, one text at a
time; an empty table gives no rows; other columns pass whatever their names, but for one named
``score``, which is replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import combinations
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.llm.common import text_or_empty

#: Labelled documents that a model is fitted on, at most. The choice is by a hash of the id.
MAX_ROWS = 20_000

_ASCII = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "symbol": b"#*$%&|<>",
    "stop": b".,;:",
    "shout": b"!?",
    "space": b" \t\n\x0b\x0c\r",
    "beyond": bytes(range(128, 256)),
}

FEATURES = [
    "log_bytes",
    "log_words",
    "word_bytes",
    "log_longest_word",
    *(f"{name}_share" for name in _ASCII),
    "distinct_word_share",
    "top_word_share",
    "same_as_previous_share",
    "log_lines",
    "distinct_line_share",
]


def text_features(text: bytes) -> list[float]:
    """One number for each of ``FEATURES``, from the whole text."""
    words, lines = text.split(), text.split(b"\n")
    size, n = max(1, len(text)), max(1, len(words))
    counts = Counter(words)
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        sum(map(len, words)) / n,
        np.log1p(max(map(len, words), default=0)),
        *((len(text) - len(text.translate(None, kind))) / size for kind in _ASCII.values()),
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(map(eq, words, words[1:])) / n,
        np.log1p(len(lines)),
        len(set(lines)) / len(lines),
    ]


class Settings(NamedTuple):
    """How a model is fitted."""

    bins: int = 32
    rounds: int = 120
    rate: float = 0.15
    depth: int = 2
    pairs: int = 4
    pair_bins: int = 8
    pair_rounds: int = 40
    ridge: float = 2.0


def _tree(grad: np.ndarray, hess: np.ndarray, depth: int, ridge: float) -> np.ndarray:
    """Values of a tree of some depth over the bins of one histogram, in their order."""
    out = np.empty(len(grad))

    def gain(g: np.ndarray | float, h: np.ndarray | float) -> np.ndarray | float:
        return g * g / (h + ridge)

    def grow(low: int, high: int, levels: int) -> None:
        g, h = grad[low:high].sum(), hess[low:high].sum()
        if levels and high - low > 1:
            left_g, left_h = np.cumsum(grad[low : high - 1]), np.cumsum(hess[low : high - 1])
            gains = gain(left_g, left_h) + gain(g - left_g, h - left_h)
            best = int(np.argmax(gains))
            if gains[best] > gain(g, h) + 1e-9:
                grow(low, low + best + 1, levels - 1)
                grow(low + best + 1, high, levels - 1)
                return
        out[low:high] = g / (h + ridge)

    grow(0, len(grad), depth)
    return out


def _pair_tree(grad: np.ndarray, hess: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """Values of the best tree over two features: one cut of the first, then one of the second on
    either side; and its gain."""
    best, values = -1.0, np.zeros_like(grad)
    for cut in range(1, len(grad)):
        table, total = np.empty_like(grad), 0.0
        for rows in (slice(0, cut), slice(cut, None)):
            own = _tree(grad[rows].sum(axis=0), hess[rows].sum(axis=0), 1, ridge)
            table[rows] = own
            total += float((own * grad[rows].sum(axis=0)).sum())
        if total > best:
            best, values = total, table
    return values, best


class Model(NamedTuple):
    """Edges of the bins, the tables, and the pairs with theirs."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def score(self, features: np.ndarray) -> np.ndarray:
        """Scores of rows of features: bins are found and their values added up, all at once."""
        total = np.full(len(features), self.intercept)
        for k, (edges, values) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += values[np.searchsorted(edges, features[:, k], side="right")]
        if self.pairs:
            coarse = [
                np.searchsorted(edges, features[:, k], side="right")
                for k, edges in enumerate(self.pair_edges)
            ]
            for (i, j), values in zip(self.pairs, self.pair_tables, strict=True):
                total += values[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between bins of about equal size; fewer where values are the same."""
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))


def fit(features: np.ndarray, labels: np.ndarray, settings: Settings = Settings()) -> Model:
    """Fit on rows of features and labels of 0 and 1."""
    n, width = features.shape
    edges = [_edges(features[:, k], settings.bins) if n else np.empty(0) for k in range(width)]
    bins = [np.searchsorted(e, features[:, k], side="right") for k, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    share = (labels.sum() + 0.5) / (n + 1)
    intercept = float(np.log(share / (1 - share)))
    total = np.full(n, intercept)

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(settings.rounds if n else 0):
        for k in range(width):
            grad, hess = gradients()
            size = len(tables[k])
            sums = [np.bincount(bins[k], x, size) for x in (grad, hess)]
            step = settings.rate * _tree(*sums, settings.depth, settings.ridge)
            tables[k] += step
            total += step[bins[k]]

    pair_edges = [_edges(features[:, k], settings.pair_bins) if n else np.empty(0) for k in range(width)]
    coarse = [np.searchsorted(e, features[:, k], side="right") for k, e in enumerate(pair_edges)]

    def pair_step(i: int, j: int) -> tuple[np.ndarray, float]:
        shape = (len(pair_edges[i]) + 1, len(pair_edges[j]) + 1)
        flat = coarse[i] * shape[1] + coarse[j]
        grad, hess = gradients()
        sums = [np.bincount(flat, x, shape[0] * shape[1]).reshape(shape) for x in (grad, hess)]
        return _pair_tree(*sums, settings.ridge)

    pairs: list[tuple[int, int]] = []
    if n:
        ranked = sorted(combinations(range(width), 2), key=lambda ij: -pair_step(*ij)[1])
        pairs = ranked[: settings.pairs]
    pair_tables = [np.zeros((len(pair_edges[i]) + 1, len(pair_edges[j]) + 1)) for i, j in pairs]
    for _ in range(settings.pair_rounds):
        for (i, j), values in zip(pairs, pair_tables, strict=True):
            step = settings.rate * pair_step(i, j)[0]
            values += step
            total += step[coarse[i], coarse[j]]
    return Model(intercept, edges, tables, pairs, pair_edges, pair_tables)


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[bytes]:
    """A batch's texts one at a time; null is an empty one."""
    return (text.as_py() or b"" for text in batch.column(name).cast(pa.binary()))


def _feature_rows(texts: Iterable[bytes]) -> np.ndarray:
    return np.array([text_features(t) for t in texts], np.float64).reshape(-1, len(FEATURES))


def labelled_features(
    docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS
) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels (``doc_id``, ``label``) of at most ``max_rows`` labelled documents.

    Only ids are joined to find which labels have documents; the bounded choice is then broadcast
    to the texts, so that no text is shuffled.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull()).join(
        docs.select("doc_id").where(F.col("doc_id").isNotNull()), "doc_id", "left_semi"
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows)
    rows = docs.select("doc_id", text_or_empty().cast("binary").alias("_text")).join(
        F.broadcast(chosen.select("doc_id", F.col("label").cast("double").alias("_label"))),
        "doc_id",
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _feature_rows(_texts(batch, "_text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_label"), pa.array(found.tolist(), pa.list_(pa.float64()))],
                names=["doc_id", "label", "features"],
            )

    id_type = docs.schema["doc_id"].dataType
    schema = (
        T.StructType()
        .add("doc_id", id_type)
        .add("label", "double")
        .add("features", T.ArrayType(T.DoubleType()))
    )
    measured = rows.mapInArrow(measure, schema)
    # Rows that share an id may be more than the chosen labels: the bound holds for them too.
    first = measured.orderBy(F.xxhash64("doc_id"), "doc_id", "label", "features").limit(max_rows)
    collected = first.collect()
    features = np.array([r.features for r in collected], np.float64).reshape(-1, len(FEATURES))
    return features, np.array([r.label for r in collected], np.float64)


def fit_model(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = MAX_ROWS,
    settings: Settings = Settings(),
) -> Model:
    """A model of ``labels`` (``doc_id``, ``label`` 0 or 1) from the texts of ``docs``."""
    return fit(*labelled_features(docs, labels, max_rows), settings)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with the ``score`` of each text."""
    kept = [c for c in docs.columns if c != "score"]
    schema = T.StructType([docs.schema[c] for c in kept]).add("score", "double")
    # Texts go to the workers once; under a new name only where they are no column to return.
    name = "text" if "text" in kept and docs.schema["text"].dataType == T.StringType() else "_text"
    while name != "text" and name in kept:
        name = f"_{name}"
    texts = [] if name == "text" else [text_or_empty().alias(name)]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(_feature_rows(_texts(batch, name)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(scores)], names=[*kept, "score"]
            )

    return docs.select(*kept, *texts).mapInArrow(score, schema)


def predicted(threshold: float = 0.3) -> Column:
    """1 where the score reaches the threshold, else 0."""
    return (F.col("score") >= threshold).cast("int")
