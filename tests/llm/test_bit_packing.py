import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerlift.llm import registry
from ledgerlift.llm.bit_packing import bits_for, pack, read_packed, unpack, write_packed
from ledgerlift.llm.word_tokens import piece_ids
from ledgerlift.sources import scratch_path

TOKENIZER = Tokenizer.from_file(registry.WORD_BPE)


def expected(rows):
    """(doc_id, start, n_tokens, crc) of (doc_id, text) rows that are in order."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 24, 31, 32])
def test_pack_round_trip_and_random_access(bits):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 1 << bits, 70_001, dtype=np.uint64).astype("<u4")
    payload = pack(ids, bits)
    assert len(payload) == (len(ids) * bits + 7) // 8
    for start, count in [(0, len(ids)), (0, 0), (1, 1), (65_530, 20), (70_000, 1), (70_001, 0)]:
        assert (unpack(payload, bits, start, count) == ids[start : start + count]).all()


def test_pack_refuses_wide_ids():
    with pytest.raises(ValueError, match="does not fit"):
        pack(np.array([8], "<u4"), 3)


def test_bits():
    assert [bits_for(n) for n in (1, 2, 3, 256, 257, 49_408)] == [1, 1, 2, 8, 9, 16]


def test_pieces_match_the_library(documents, odd_documents):
    pieces = piece_ids(registry.WORD_BPE)
    for row in [*documents.select("text").collect(), *odd_documents.select("text").collect()]:
        text = row.text or ""
        ids = np.frombuffer(pieces.encode(text.encode()), "<u4").tolist()
        assert ids == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_query_matches_brute_force(spark, sf_dir, documents):
    rows = documents.select("doc_id", "text").orderBy("doc_id").collect()
    got = registry.queries()["op7_bit_packing"](spark, sf_dir).orderBy("doc_id")
    assert [tuple(r) for r in got.collect()] == expected(rows)


def test_odd_rows(spark, odd_documents):
    path = scratch_path(spark, "odd")
    write_packed(odd_documents, path, registry.WORD_BPE, end_id=1, block_ids=100)
    got = read_packed(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted(
        (r.doc_id for r in odd_documents.collect()), key=lambda x: (x is not None, x)
    )
    texts = {r.doc_id: r.text for r in odd_documents.collect() if r.doc_id not in (3, 6)}
    for r in got:
        if r.doc_id in texts:
            assert expected([(r.doc_id, texts[r.doc_id])])[0][2:] == (r.n_tokens, r.ids_crc32)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()


def test_no_rows(spark, no_documents):
    path = scratch_path(spark, "none")
    write_packed(no_documents, path, registry.WORD_BPE, end_id=1)
    assert read_packed(spark, path).count() == 0


def test_generated_pieces_match_the_library():
    rng = np.random.default_rng(5)
    pieces = piece_ids(registry.WORD_BPE)
    alphabets = ["abC'.,!", "éǺa.'s|<>%$", "<|endoftext|> A.", "x1²ª'tmdre-_`~"]
    for _ in range(3000):
        alphabet = list(alphabets[rng.integers(len(alphabets))] + " \n\x1c ")
        text = "".join(rng.choice(alphabet, rng.integers(1, 30)))
        ids = np.frombuffer(pieces.encode(text.encode()), "<u4").tolist()
        assert ids == TOKENIZER.encode(text, add_special_tokens=False).ids, repr(text)
