"""An n-gram language model of the corpus as a weighted backoff automaton, and texts scored by it.

The n-grams of the training texts are counted over all of them. Smoothing interpolates each order
with the next shorter one by a Dirichlet prior of ``prior`` tokens, down to words with one count
added; so every state's probabilities sum to one. A state is a context that training texts have;
its arcs are the tokens seen after it, with their smoothed log-probabilities, and its failure arc
leads to the state of the context without its first token, with the weight of what was not seen.
A text is scored in one traversal from left to right that carries the state.

Texts are traversed in lockstep, a token of each at a time, in stretches of equal length: whatever the
state before them, ``order - 1`` tokens lead to the same one, the longest context learned of them, so a
stretch begins with these and leaves out their probabilities. At a position, only its own n-grams can
be arcs; each is looked up once by its number, and those not learned are no arcs.

The model is as large as the corpus makes it and is never in one place. Texts are cut into chunks,
very long ones into several, each after the first with the tokens before it; each chunk asks for the counts of its own distinct n-grams, the counts are
added up by buckets of n-grams, and each chunk gets those it asked for, which is all of the
automaton that its texts can reach.

Defined cases: a null or empty text is its end token alone; A-Z are lower-cased and words are
split at ASCII white space; without training texts every word has the probability 1; repeated
rows count and are scored each time, null ids too; a very long text is counted and scored piece by
piece; an empty table gives no rows; other columns are ignored, whatever their names. N-grams are
told apart by 56-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import parts_for, text_or_empty, words_by_slice, written

#: Tokens of a chunk, and n-grams asked for in a bucket, about.
CHUNK_TOKENS = 1_000_000
BUCKET_KEYS = 500_000
#: Bytes of a text that are cut into words, and are in one chunk, at once.
SLICE_BYTES = 1 << 22
#: Tokens of a text that are traversed one after the other; the next ones are so beside them.
STRETCH = 512
#: Tokens that the shorter context counts for in each state.
PRIOR = 32.0

_HASH_BITS = np.uint64(56)
_MASK = np.uint64(2**56 - 1)
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_START = np.uint64(0x5851F42D4C957F2D)
_END = np.uint64(0x14057B7EF767814F)


def squeeze(values: np.ndarray) -> bytes:
    """Integers as compressed planes of bytes: small ones take little room."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    packed = pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)
    return len(values).to_bytes(8, "little") + packed


def unsqueeze(packed: bytes) -> np.ndarray:
    size = int.from_bytes(packed[:8], "little")
    raw = pa.decompress(packed[8:], decompressed_size=8 * size, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(8, size)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.int64)


def squeeze_ascending(values: np.ndarray) -> bytes:
    return squeeze(np.diff(values, prepend=values.dtype.type(0)))


def unsqueeze_ascending(packed: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(packed))


class _Numbers(dict):
    """Words to numbers in the order they come."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Grams(NamedTuple):
    """Distinct n-grams of one length in a chunk.

    ``hashes`` tells them apart in the corpus; ``token`` is the last one; ``context`` and
    ``suffix`` are the numbers, one length shorter, of what comes before it and of the n-gram
    without its first token. ``at`` has each position's number, or -1.
    """

    hashes: np.ndarray
    token: np.ndarray
    context: np.ndarray
    suffix: np.ndarray
    at: np.ndarray


class Piece(NamedTuple):
    """Words of a text: all of them, or some with as many before them as contexts reach back."""

    words: list[bytes]
    #: How many words stand before the piece's own.
    lead: int = 0
    #: Whether the text ends here.
    last: bool = True


def pieces_of(text: bytes, lead: int, size: int = SLICE_BYTES) -> Iterator[Piece]:
    """A text's words in pieces of about ``size`` bytes, with ``lead`` words before all but the first.

    With a lead of one word at least, only a text's first piece has none.
    """
    before: list[bytes] = []
    words: list[bytes] = []
    for more in words_by_slice(text, size):
        if len(words) >= max(lead, 1) and more:
            yield Piece(before + words, len(before), False)
            before, words = (before + words)[len(before) + len(words) - lead :], []
        words += more
    yield Piece(before + words, len(before))


class Chunk:
    """Tokens of texts or pieces of them, numbered by the ascending hashes of their words.

    ``lead`` of a piece's tokens are another's, and only contexts here.
    """

    def __init__(
        self, words: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, lead: np.ndarray, held: np.ndarray
    ):
        self.words, self.tokens, self.lengths, self.lead, self.held = words, tokens, lengths, lead, held
        self.starts = np.cumsum(lengths) - lengths
        #: Positions of the pieces' own tokens.
        self.own = np.arange(len(tokens)) >= np.repeat(self.starts + lead, lengths)

    @classmethod
    def of_texts(cls, texts: list[bytes], held: list[bool]) -> Chunk:
        return cls.of_pieces([Piece(text.lower().split()) for text in texts], held)

    @classmethod
    def of_pieces(cls, pieces: list[Piece], held: list[bool]) -> Chunk:
        numbers = _Numbers()
        end = numbers[b" "]  # no word has a blank
        parts, lengths = [], []
        for words, _, last in pieces:
            parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
            parts.append(np.full(int(last), end))
            lengths.append(len(words) + last)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
        hashes[end] = _END
        hashes &= _MASK
        # Words of one hash become one word.
        words, place = np.unique(hashes, return_inverse=True)
        lead = np.array([piece.lead for piece in pieces], np.int64)
        return cls(
            words, place[np.concatenate(parts)], np.array(lengths, np.int64), lead, np.array(held, bool)
        )

    def summed(self, values: np.ndarray) -> np.ndarray:
        """The sum of each piece's own tokens' values."""
        return np.add.reduceat(np.where(self.own, values, 0), self.starts)

    def grams(self, order: int) -> list[Grams]:
        """The distinct n-grams of each length, the shortest first.

        Before a text's first token stands a start; no n-gram reaches further back.
        """
        size = len(self.tokens)
        # Tokens since the start of the piece, and the token itself.
        depth = np.arange(size) - np.repeat(self.starts, self.lengths) + 1
        own = self.words[self.tokens]
        shortest = Grams(
            self.words,
            np.arange(len(self.words)),
            np.full(len(self.words), -1),
            np.full(len(self.words), -1),
            self.tokens,
        )
        levels = [shortest]
        for n in range(2, order + 1):
            shorter = levels[-1]
            # The number of the start of the text is one more than those of all contexts.
            start = len(shorter.hashes)
            before = np.concatenate([[-1], shorter.at[:-1]])
            if n == 2:
                before[self.starts] = np.where(self.lead == 0, start, -1)
            else:
                # The start and n-2 tokens are an n-1-gram of the level below already.
                before[depth < n - 1] = -1
            here = np.flatnonzero(before >= 0)
            pair, at_first, number = np.unique(
                before[here] * len(self.words) + self.tokens[here],
                return_index=True,
                return_inverse=True,
            )
            place = here[at_first]
            context = before[place]
            context_hashes = np.append(shorter.hashes, _START & _MASK)[context]
            mixed = (context_hashes * _MULTIPLY + own[place]) * _MULTIPLY + np.uint64(n)
            mixed ^= mixed >> np.uint64(32)
            at = np.full(size, -1)
            at[here] = number
            levels.append(
                Grams((mixed * _MULTIPLY) >> (np.uint64(64) - _HASH_BITS), self.tokens[place], context, shorter.at[place], at)
            )
        return levels

    def training_counts(self, grams: Grams) -> np.ndarray:
        learned = np.repeat(~self.held, self.lengths) & self.own & (grams.at >= 0)
        return np.bincount(grams.at[learned], minlength=len(grams.hashes))


def _keys(levels: list[Grams]) -> np.ndarray:
    """All n-grams' hashes, with their length's parity of one token or more in the lowest bit."""
    return np.concatenate(
        [(g.hashes << np.uint64(1)) | np.uint64(n > 0) for n, g in enumerate(levels)]
    ).astype(np.int64)


def _dealt(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys by bucket and value, and where the buckets end."""
    bucket = keys % buckets
    order = np.lexsort((keys, bucket))
    return order, np.searchsorted(bucket[order], np.arange(buckets), side="right")


class Automaton:
    """The part of the model that a chunk's texts can reach.

    State 0 has no context, state 1 is the start of a text; then come the contexts of one token,
    of two, and so on, of which those that no training text has are never entered.
    """

    def __init__(
        self, levels: list[Grams], totals: list[np.ndarray], texts: int, tokens: int, types: int,
        prior: float,
    ):
        self.width = len(levels[0].hashes)
        order = len(levels)
        self.unseen = -float(np.log10(tokens + types + 1))
        lower = (totals[0] + 1) / (tokens + types + 1)
        first_state = [2]
        for grams in levels[:-1]:
            first_state.append(first_state[-1] + len(grams.hashes))
        self.fail_weight = np.zeros(first_state[-1])
        self.fail_to = np.zeros(first_state[-1], np.int64)
        self.fail_weight[1] = np.log10(prior / (texts + prior))
        arcs, weights, targets, learned = [], [], [], []
        for n, (grams, total) in enumerate(zip(levels, totals, strict=True), 1):
            if n == 1:
                probability = lower
                state = np.zeros(len(total), np.int64)
            else:
                before = np.append(totals[n - 2], texts)[grams.context]
                probability = (total + prior * lower[grams.suffix]) / (before + prior)
                state = np.where(
                    grams.context == len(totals[n - 2]), 1, first_state[n - 2] + grams.context
                )
            if n < order:
                own = first_state[n - 1] + np.arange(len(total))
                with np.errstate(divide="ignore"):
                    self.fail_weight[own] = np.log10(prior / (total + prior))
                self.fail_to[own] = 0 if n == 1 else first_state[n - 2] + grams.suffix
                target = own
            elif n == 1:
                target = np.zeros(len(total), np.int64)
            else:
                target = first_state[n - 2] + grams.suffix
            arcs.append(state * self.width + grams.token)
            weights.append(np.log10(probability))
            targets.append(target)
            learned.append(total > 0)
            lower = probability
        self.start = 1 if order > 1 and texts else 0
        # How many tokens each state's context has.
        sizes = [len(grams.hashes) for grams in levels[:-1]]
        self.level = np.repeat(np.arange(order), [1, *sizes] if order > 1 else [1])
        self.level = np.insert(self.level, 1, int(order > 1))
        self.order, self._levels = order, levels
        self._arcs, self.weights, self.targets, self._learned = map(
            np.concatenate, (arcs, weights, targets, learned)
        )

    def score(self, tokens: list[int]) -> float:
        """log10 probability of a text, token by token."""
        arcs = dict(zip(self._arcs[self._learned].tolist(), np.flatnonzero(self._learned), strict=True))
        total, state = 0.0, self.start
        for token in tokens:
            while (arc := arcs.get(state * self.width + token)) is None:
                if not state:
                    total += self.unseen
                    break
                total += self.fail_weight[state]
                state = self.fail_to[state]
            else:
                total += self.weights[arc]
                state = self.targets[arc]
        return total

    def score_pieces(self, chunk: Chunk) -> np.ndarray:
        """log10 probability of each piece's own tokens: all stretches in lockstep."""
        # The arc that each position's n-gram of each length is, if it was learned.
        arcs, first = np.full((self.order, len(chunk.tokens)), -1), 0
        for n, grams in enumerate(self._levels):
            known = np.flatnonzero(grams.at >= 0)
            number = first + grams.at[known]
            arcs[n, known] = np.where(self._learned[number], number, -1)
            first += len(grams.hashes)

        own = chunk.lengths - chunk.lead
        stretches = -(-own // STRETCH)
        piece = np.repeat(np.arange(len(own)), stretches)
        place = np.arange(len(piece)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
        begin = (chunk.starts + chunk.lead)[piece] + place * STRETCH
        length = np.minimum(own[piece] - place * STRETCH, STRETCH)
        at_start = (place == 0) & (chunk.lead[piece] == 0)
        warm = np.where(at_start, 0, self.order - 1)
        # The longest first, so that those still going on are the first ones.
        by_length = np.argsort(-(length + warm), kind="stable")
        piece, warm = piece[by_length], warm[by_length]
        begin, length = begin[by_length] - warm, length[by_length] + warm
        state = np.where(at_start[by_length], self.start, 0)
        total = np.zeros(len(piece))
        running = np.searchsorted(-length, -np.arange(int(length.max(initial=0))), side="left")
        for step, count in enumerate(running):
            price, state[:count] = self._step(state[:count], arcs, begin[:count] + step)
            total[:count] += np.where(step >= warm[:count], price, 0.0)
        return np.bincount(piece, total, len(own))

    def _step(
        self, state: np.ndarray, arcs: np.ndarray, position: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Prices of the tokens at some positions, and the states after them."""
        state, price = state.copy(), np.zeros(len(state))
        arc = arcs[self.level[state], position]
        missing = np.flatnonzero(arc < 0)
        while len(missing):
            of = state[missing]
            price[missing] += np.where(of == 0, self.unseen, self.fail_weight[of])
            state[missing] = self.fail_to[of]
            missing = missing[of != 0]
            arc[missing] = arcs[self.level[state[missing]], position[missing]]
            missing = missing[arc[missing] < 0]
        found = np.flatnonzero(arc >= 0)
        price[found] += self.weights[arc[found]]
        state[found] = self.targets[arc[found]]
        return price, state


CHUNKS = (
    "chunk bigint, doc_ids array<bigint>, texts array<bigint>, held array<boolean>, "
    "lengths array<bigint>, lead array<bigint>, words binary, tokens binary, n_tokens bigint, n_learned bigint, n_texts bigint"
)
_CHUNK_ARROW = pa.schema(
    [
        ("chunk", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("texts", pa.list_(pa.int64())),
        ("held", pa.list_(pa.bool_())),
        ("lengths", pa.list_(pa.int64())),
        ("lead", pa.list_(pa.int64())),
        ("words", pa.binary()),
        ("tokens", pa.binary()),
        ("n_tokens", pa.int64()),
        ("n_learned", pa.int64()),
        ("n_texts", pa.int64()),
    ]
)


def _chunk_of(row: dict) -> Chunk:
    return Chunk(
        unsqueeze_ascending(row["words"]).astype(np.uint64),
        unsqueeze(row["tokens"]),
        np.array(row["lengths"], np.int64),
        np.array(row["lead"], np.int64),
        np.array(row["held"], bool),
    )


def cut_chunks(
    docs: DataFrame,
    held_out: Column,
    order: int,
    chunk_tokens: int = CHUNK_TOKENS,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Documents (``doc_id``, ``text``) as chunks of tokens; those of ``held_out`` are only scored.

    ``texts`` numbers the texts that are in pieces; it is null for whole ones.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        split, rows, n = number, [], 0

        def close() -> pa.RecordBatch:
            ids, texts, held, pieces = map(list, zip(*rows, strict=True))
            chunk = Chunk.of_pieces(pieces, held)
            learned = np.where(chunk.held, 0, chunk.lengths - chunk.lead)
            row = {
                "chunk": number,
                "doc_ids": ids,
                "texts": texts,
                "held": held,
                "lengths": chunk.lengths.tolist(),
                "lead": chunk.lead.tolist(),
                "words": squeeze_ascending(chunk.words),
                "tokens": squeeze(chunk.tokens),
                "n_tokens": len(chunk.tokens),
                "n_learned": int(learned.sum()),
                "n_texts": int((~chunk.held & (chunk.lead == 0)).sum()),
            }
            rows.clear()
            return pa.RecordBatch.from_pylist([row], _CHUNK_ARROW)

        for batch in batches:
            for doc_id, out, text in zip(*batch.columns, strict=True):
                doc_id, out, text = doc_id.as_py(), out.as_py(), text.as_py()
                for piece in pieces_of(text, max(order - 1, 1), slice_bytes):
                    whole = piece.last and not piece.lead
                    rows.append((doc_id, None if whole else split, out, piece))
                    n += len(piece.words) + piece.last
                    if n >= chunk_tokens:
                        yield close()
                        number, n = number + 1, 0
                split += 1
        if rows:
            yield close()

    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held"),
        text_or_empty().cast("binary").alias("text"),
    )
    return texts.mapInArrow(cut, CHUNKS)


def _requests(chunks: DataFrame, order: int, buckets: int) -> DataFrame:
    """What each chunk asks of each bucket: its n-grams there, and how often it has learned them."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _chunk_of(row)
                levels = chunk.grams(order)
                keys = _keys(levels)
                counts = np.concatenate([chunk.training_counts(g) for g in levels])
                by_bucket, ends = _dealt(keys, buckets)
                keys, counts = keys[by_bucket], counts[by_bucket]
                # Within a bucket the remainder says nothing: quotients take fewer bits.
                out = [
                    (
                        bucket,
                        row["chunk"],
                        squeeze_ascending(keys[low:high] // buckets),
                        squeeze(counts[low:high]),
                    )
                    for bucket, (low, high) in enumerate(zip([0, *ends], ends))
                    if high > low
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(c, t)
                        for c, t in zip(
                            zip(*out, strict=True),
                            [pa.int32(), pa.int64(), pa.binary(), pa.binary()],
                            strict=True,
                        )
                    ],
                    names=["bucket", "chunk", "keys", "counts"],
                )

    return chunks.mapInArrow(ask, "bucket int, chunk bigint, keys binary, counts binary")


def _add_up(asked: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """One bucket: the totals of its n-grams, sent to each chunk that asked for them.

    A row without a chunk has the bucket's number of distinct learned words.
    """
    bucket = int(asked["bucket"].iloc[0])
    keys = [unsqueeze_ascending(x) * buckets + bucket for x in asked["keys"]]
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.concatenate([unsqueeze(x) for x in asked["counts"]])
    totals = np.bincount(place, counts, len(every)).astype(np.int64)
    ends = np.cumsum([len(k) for k in keys])
    replies = [squeeze(x) for x in np.split(totals[place], ends[:-1])]
    words = int(((totals > 0) & (every & 1 == 0)).sum())
    size = len(replies)
    return pd.DataFrame(
        {
            "chunk": pd.array([*asked["chunk"], None], "Int64"),
            "bucket": [*asked["bucket"], bucket],
            "totals": [*replies, b""],
            "n_types": [0] * size + [words],
        }
    )


def score_documents(
    docs: DataFrame,
    held_out: Column,
    order: int = 2,
    prior: float = PRIOR,
    chunk_tokens: int = CHUNK_TOKENS,
    bucket_keys: int = BUCKET_KEYS,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Every document's score by a model of those that are not ``held_out``.

    ``doc_id``, ``held_out``, ``n_tokens``, ``n_known`` (tokens that training texts have),
    ``train_tokens``, ``base_score`` (words alone, one count added) and ``score``, both log10.
    """
    chunks = written(cut_chunks(docs, held_out, order, chunk_tokens, slice_bytes), "chunks")
    sums = chunks.agg(*(F.sum(c).alias(c) for c in ("n_tokens", "n_learned", "n_texts"))).first()
    n_tokens, learned, texts = (int(x or 0) for x in sums)
    buckets = parts_for(n_tokens, bucket_keys)
    asked = _requests(chunks, order, buckets)
    replies = written(
        asked.groupBy("bucket").applyInPandas(
            lambda part: _add_up(part, buckets),
            "chunk bigint, bucket int, totals binary, n_types bigint",
        ),
        "replies",
    )
    types = int(replies.agg(F.sum("n_types")).first()[0] or 0)

    def integers(values: list) -> pd.array:
        return pd.array([None if x is None or x != x else int(x) for x in values], "Int64")

    def traverse(chunk_rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in chunk_rows.to_dict("records"):
            chunk = _chunk_of(row)
            levels = chunk.grams(order)
            by_bucket, _ = _dealt(_keys(levels), buckets)
            totals = np.empty(len(by_bucket), np.int64)
            own = answers.sort_values("bucket")["totals"]
            totals[by_bucket] = np.concatenate([unsqueeze(x) for x in own])
            totals = np.split(totals, np.cumsum([len(g.hashes) for g in levels])[:-1])
            automaton = Automaton(levels, totals, texts, learned, types, prior)
            counts = totals[0][chunk.tokens]
            out.append(
                pd.DataFrame(
                    {
                        "doc_id": integers(row["doc_ids"]),
                        "text": integers(row["texts"]),
                        "held_out": chunk.held,
                        "n_tokens": chunk.lengths - chunk.lead,
                        "n_known": chunk.summed((counts > 0).astype(np.int64)),
                        "base_score": chunk.summed(np.log10((counts + 1) / (learned + types + 1))),
                        "score": automaton.score_pieces(chunk),
                    }
                )
            )
        return pd.concat(out) if out else pd.DataFrame(columns=[c.split()[0] for c in SCORES.split(", ")])

    asked_back = replies.where(F.col("chunk").isNotNull()).select("chunk", "bucket", "totals")
    cells = chunks.groupBy("chunk").cogroup(asked_back.groupBy("chunk"))
    scored = cells.applyInPandas(traverse, SCORES)
    # A text in pieces is put together by its number; a whole one is alone with its null.
    train_tokens = F.lit(learned).cast("bigint").alias("train_tokens")
    if not chunks.where(F.exists("texts", lambda text: text.isNotNull())).isEmpty():
        scored = written(scored, "scores")
        sums = ("n_tokens", "n_known", "base_score", "score")
        joined = scored.where(F.col("text").isNotNull()).groupBy("text", "doc_id", "held_out")
        joined = joined.agg(*(F.sum(c).alias(c) for c in sums))
        scored = scored.where(F.col("text").isNull()).unionByName(joined)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", train_tokens, "base_score", "score"
    )


SCORES = (
    "doc_id bigint, text bigint, held_out boolean, n_tokens bigint, n_known bigint, "
    "base_score double, score double"
)
