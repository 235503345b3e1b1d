"""Whole texts to token ids with a vocabulary file of the ``tokenizers`` library.

White space never ends up inside a token of these vocabularies, so a text is the sequence of its
pieces between ASCII white space, and each distinct piece has to be encoded only once a worker.
"""

from __future__ import annotations

import struct
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

ID_TYPE = np.dtype("<u4")

#: ASCII marks. Between a letter and marks alone up to the piece's end two tokens always part. The
#: apostrophe is left out, since it may begin a token of letters.
MARKS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum() and b != ord("'"))
LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyz")


class PieceIds(dict):
    """Piece of text (UTF-8, lower-cased A-Z) to its ids, as little-endian unsigned 32-bit.

    The vocabulary has no capitals. Pieces are kept in two generations of at most ``max_pieces``
    each: when the younger is full, it replaces the older, so that frequent pieces stay. Pieces of
    more than ``max_bytes`` are encoded each time they come.
    """

    def __init__(self, path: str, max_pieces: int, max_bytes: int = 64):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.max_pieces, self.max_bytes = max_pieces, max_bytes
        self.older: dict[bytes, bytes] = {}

    def _encode(self, piece: bytes) -> bytes:
        ids = self.tokenizer.encode(piece.decode(), add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.older.get(piece)
        keep = len(piece) <= self.max_bytes
        if ids is None:
            word = piece.rstrip(MARKS)
            if len(word) < len(piece) and word and word[-1] in LETTERS:
                # With its marks a word is kept only if it comes again.
                keep = keep and word in self
                ids = self[word] + self[piece[len(word) :]]
            else:
                ids = self._encode(piece)
        if keep:
            if len(self) >= self.max_pieces:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        """All ids of a text, as bytes. ``bytes.split`` splits at ASCII white space alone."""
        if b"<|" in text:  # may begin a special token, which has to be written just so
            return b"".join(map(self._encode, text.split()))
        return b"".join(map(self.__getitem__, text.lower().split()))


#: Pieces of a generation, by default: with both full, about 200 MB a worker.
MAX_PIECES = 500_000


@lru_cache(maxsize=1)
def piece_ids(path: str, max_pieces: int = MAX_PIECES) -> PieceIds:
    """The cache of this worker process, kept from task to task."""
    return PieceIds(path, max_pieces)


@lru_cache(maxsize=2)
def vocabulary_size(path: str) -> int:
    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)
