import hashlib
import random

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor

from cratedig.llm import pieces
from cratedig.llm.queries import PIECE_BPE, QUERIES
from tests.llm import data


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PIECE_BPE)


def test_query_equals_library(spark, library):
    got = {r.doc_id: r for r in QUERIES["op6_piece_encoding"](spark, data.SF).collect()}
    docs = data.documents()
    assert set(got) == set(docs)
    for i, t in docs.items():
        ids = library.encode(t, add_bos=True, add_eos=True)
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), digest)
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_random_strings(library):
    rng = random.Random(3)
    alphabet = "abet hinorx ▁\n\téß0123 日本語\U0001f600\x00.,  ing"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["", " ", "  ", " a", "a ", "   a  b", "▁", "a▁▁b", "x" * 3000, " " * 70, "\r\n", "the " * 500]
    assert [list(x) for x in pieces.encode(texts, PIECE_BPE)] == library.encode(texts)


def test_backtracking_equals_merging():
    model = pieces.Pieces(PIECE_BPE)
    rng = random.Random(9)
    for _ in range(500):
        unit = pieces.SPACE + "".join(rng.choice("aeinrstthwo") for _ in range(rng.randrange(1, 25)))
        assert [model.text[i] for i in model.ids(unit)] == model.merged(unit)


def test_dirty_rows(spark, library):
    docs = data.dirty(spark)
    made = pieces.with_pieces(docs, PIECE_BPE, batch=4)
    assert [c for c in made.columns if c in docs.columns] == [c for c in docs.columns if c != "text"]
    want = [library.encode(r[1] or "", add_bos=True, add_eos=True) for r in data.dirty_rows()]
    rows = made.collect()
    assert sorted(list(r["_ids"]) for r in rows) == sorted(want)
    assert sorted(r["_decoded"] for r in rows) == sorted(library.decode(x) for x in want)
    assert pieces.with_pieces(data.empty(spark), PIECE_BPE).count() == 0
