import json
import tracemalloc
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from cratedig.llm import records
from cratedig.llm.common import Recent
from cratedig.llm.queries import QUERIES, WORD_BPE
from tests.llm import data

END = 2


def expected(rows):
    t = Tokenizer.from_file(WORD_BPE)
    return [(i, t.encode(x or "", add_special_tokens=False).ids + [END]) for i, x in rows]


def test_query_equals_library(spark):
    got = {r.doc_id: r for r in QUERIES["op1_token_records"](spark, data.SF).collect()}
    start = 0
    for i, ids in sorted(expected(data.documents().items())):
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == len(data.documents())


def test_dirty_rows_round_trip(spark, tmp_path):
    docs = data.dirty(spark)
    records.write(docs, str(tmp_path), WORD_BPE, END, parts=3)
    index = records.write_index(spark, str(tmp_path)).collect()
    want = expected([(r[0], r[1]) for r in data.dirty_rows()])
    key = lambda i: (i is None, i or 0)
    assert sorted((key(r.doc_id), r.ids_crc32) for r in index) == sorted((key(i), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want)
    ordered = sorted(index, key=lambda r: r.start)
    assert [key(r.doc_id) for r in ordered] == sorted(key(i) for i, _ in want)
    assert [r.start for r in ordered] == [sum(x.n_tokens for x in ordered[:k]) for k in range(len(ordered))]
    one, two = (records.read_shuffled(spark, str(tmp_path), s).collect() for s in (1, 2))
    assert one == records.read_shuffled(spark, str(tmp_path), 1).collect() and one != two
    assert sorted((key(r.doc_id), list(r.ids)) for r in one) == sorted((key(i), x) for i, x in want)


def test_memory_of_a_worker():
    """Two workers beside a heap of 1.8 GB stay below 3 GB: what both generations and the texts at hand take."""
    limit = records.CACHED_WORDS
    tracemalloc.start()
    cache = Recent(limit)
    for at in range(0, limit + 100_000, 1000):
        texts = [b"%d %d" % (n, n + 1) for n in range(at, at + 1000)]
        assert len(list(records.ids_of(texts, cache, lambda words: [w[:4] + b";" for w in words]))) == 1000
    held = tracemalloc.get_traced_memory()[0] / (len(cache.new) + len(cache.old))
    tracemalloc.stop()
    words_at_hand = records.TEXTS_AT_ONCE * 600 * 50
    assert 2 * limit * held + words_at_hand < 170e6


def test_plain_words_equal_the_library_without_its_preparation():
    tokenizer = Tokenizer.from_file(WORD_BPE)
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    words = [w + m for w in ("Aa", "zebra", "I", "ABCxyzQ", "s", "startoftext", "re" * 400) for m in ("", *marks, "!!", ",***", "<|", "|>", "\\`^_$+~")]
    words += [w + m for w in [*map(chr, range(0x80, 0x180)), "Übung", "ÀÉÎÕÜÇÑØÞß", "niña", "sí"] for m in ("", ".", "!?")]
    words += ["<|endoftext|>", "a<|endoftext|>", "it's", "a'll", "x1", "1.", "é", "Éa.", "\u212aa", "a\u0301", "\x00a", "a\x00", "a-b", "...", "'", "a\u00a0b"]
    encode, wide = records.encoder(WORD_BPE)
    made = encode([w.encode() for w in words])
    assert [np.frombuffer(m, "<u4" if wide else "<u2").tolist() for m in made] == [tokenizer.encode(w, add_special_tokens=False).ids for w in words]

    settings = json.loads(open(WORD_BPE, encoding="utf-8").read())
    assert records.cuts_plain_words(settings)
    assert not records.cuts_plain_words(settings | {"normalizer": None})
    assert not records.cuts_plain_words(settings | {"pre_tokenizer": {"type": "Whitespace"}})
    assert not records.cuts_plain_words(settings | {"added_tokens": [{"content": "bra"}]})


def test_empty_table(spark, tmp_path):
    records.write(data.empty(spark), str(tmp_path), WORD_BPE, END)
    assert records.write_index(spark, str(tmp_path)).count() == 0
    assert records.read_shuffled(spark, str(tmp_path), 1).count() == 0


@pytest.mark.parametrize("wide", [False, True])
def test_frames(wide):
    ids = np.array([1, 2, 65535], "<u4" if wide else "<u2")
    whole = records.frame(-7, ids.tobytes(), wide) + b"\n" + records.frame(None, b"", wide) + b"\n"
    doc_id, back, then = records.read_frame(memoryview(whole), 0)
    assert doc_id == -7 and back.tolist() == ids.tolist()
    assert records.read_frame(memoryview(whole), then)[0] is None
    for at in (0, 9, 20, then - 3):
        broken = bytearray(whole)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            records.read_frame(memoryview(bytes(broken)), 0)
