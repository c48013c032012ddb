import random
from collections import Counter

from cratedig.llm import quality
from cratedig.llm.queries import QUERIES
from tests.llm import data


def plain(text):
    w = data.words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    twice = {x for x, n in Counter(windows).items() if n > 1}
    repeated = {p for i, x in enumerate(windows) if x in twice for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if data.words(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeated), failed


def measured(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_query(spark):
    docs = data.documents()
    for r in QUERIES["op9_host_quality"](spark, data.SF).collect():
        assert measured(r) == plain(docs[r.doc_id])
        assert r.kept == (not r.base_failed and not r.host_failed)


def test_dirty_and_random_rows(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice(["a ", "b ", "c\n", "# ", "é ", "\n"]) for _ in range(rng.randrange(90))) for _ in range(300)]
    rows = [(i, t, None, f"s{i % 4}", 0, *["x"] * len(data.CLASHING)) for i, t in enumerate(texts, 100)] + data.dirty_rows()
    docs = spark.createDataFrame(rows, data.SCHEMA)
    got = quality.judged(docs).collect()
    assert sorted(measured(r) for r in got) == sorted(plain(r[1]) for r in rows)
    kept = quality.kept(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.kept)


def test_host_verdicts_are_shrunk(spark):
    """Many good hosts, one bad host with many documents, one with a single bad document."""
    good, bad = data.prose(1, 120), "spam " * 200
    rows = [(i, f"{good} {i}", f"h{i % 40}") for i in range(800)] + [(1000 + i, bad, "bad") for i in range(60)] + [(1060, f"{good} z", "bad")]
    rows += [(2000, bad, "single"), (2001, f"{good} y", None)]
    got = {r.doc_id: r for r in quality.judged(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    assert got[1060].host_failed and not got[1060].kept and not got[1060].base_failed
    assert not got[2000].host_failed and not got[2000].kept
    assert got[0].kept and got[2001].kept


def test_empty(spark):
    assert quality.judged(data.empty(spark)).count() == 0
    assert quality.kept(data.empty(spark)).count() == 0


def test_main_path_is_native(spark):
    plan = quality.judged(data.dirty(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
