import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from ledgerlift.llm import registry
from ledgerlift.llm.byte_bpe import (
    ByteBpe,
    decode_documents,
    encode_documents,
    read_ranks,
    round_trip_digests,
)

FILES = (registry.BYTE_BPE, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=read_ranks(registry.BYTE_BPE),
        special_tokens={},
    )


@pytest.fixture(scope="module")
def own():
    return ByteBpe(*FILES)


def ids_of(own, text):
    ((ids, decimal),) = own.encode_batch([text])
    found = np.frombuffer(ids, "<u4").tolist()
    assert decimal == ",".join(map(str, found)).encode()
    assert own.decode(ids) == text.encode()
    return found


def random_text(rng, alphabet, size):
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(0, size)))


@pytest.mark.parametrize("seed", range(40))
def test_matches_the_library(own, library, seed):
    rng = random.Random(seed)
    alphabets = ["ab ", "etaoin shrdlu,.'", "aé漢😀 \n\t\x1c\x85  ​᠎", "'strevmld "]
    for alphabet in [*alphabets, "".join(alphabets), "".join(map(chr, range(1, 700)))]:
        text = random_text(rng, alphabet, 600)
        assert ids_of(own, text) == library.encode_ordinary(text)


@pytest.mark.parametrize("text", ["x" * 5000, "ab" * 1500, "é" * 129, " " * 700, "the" * 400])
def test_long_pieces(own, library, text):
    assert ids_of(own, text) == library.encode_ordinary(text)


def test_matrix_and_heap_agree(own):
    rng = random.Random(1)
    for _ in range(300):
        piece = random_text(rng, "etaoinshr", 200).encode() or b"e"
        width = 256
        assert own._matrix([piece], width)[0].tolist() == own._long(piece).tolist()


def expected(library, text):
    ids = library.encode_ordinary(text or "")
    return (
        len(ids),
        hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
        hashlib.sha256((text or "").encode()).hexdigest(),
    )


def test_query_matches_the_library(spark, sf_dir, documents, library):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = registry.queries()["op3_byte_bpe"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(library, texts[r.doc_id])


def test_odd_rows(odd_documents, library):
    got = round_trip_digests(odd_documents, *FILES, texts_at_once=2).collect()
    rows = odd_documents.collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        ((r.doc_id, *expected(library, r.text)) for r in rows), key=repr
    )
    decoded = decode_documents(encode_documents(odd_documents, *FILES), *FILES).collect()
    assert sorted((r.doc_id or -1, bytes(r.decoded)) for r in decoded) == sorted(
        (r.doc_id or -1, (r.text or "").encode()) for r in rows
    )


def test_no_rows(no_documents):
    assert round_trip_digests(no_documents, *FILES).count() == 0
