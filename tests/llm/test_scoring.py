import math
from collections import Counter

import numpy as np

from cratedig.llm import scoring
from cratedig.llm.queries import QUERIES
from tests.llm import data


def plain(rows):
    """(id, text) -> per row: held out, tokens, known, base score; and the number of training tokens."""
    counts = Counter()
    for i, t in rows:
        if not data.held_out(i, 10):
            counts.update([*data.words(data.low(t)), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        tokens = [*data.words(data.low(t)), None]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        out.append((data.held_out(i, 10), len(tokens), sum(counts[w] > 0 for w in tokens), base))
    return out, n


def close(a, b):
    return abs(a - b) <= 1e-9 * max(1.0, abs(b))


def test_query(spark):
    docs = data.documents()
    want, n = plain(list(docs.items()))
    want = dict(zip(docs, want))
    rows = QUERIES["op8_lm_scores"](spark, data.SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        held, tokens, known, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, tokens, known, n)
        assert close(r.base_score, base) and -1e9 < r.score < 0
    # the model beats the unigram score on texts it hasn't seen
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)


def test_dirty_rows_with_small_bounds(spark):
    """A few broadcast words and a small filter: the rest is looked up at the shards, the base score stays exact."""
    rows = data.dirty_rows()
    want, n = plain([(r[0], r[1]) for r in rows])
    got = scoring.scores(data.dirty(spark), max_bits=1 << 14, frequent=3).collect()
    assert {r.train_tokens for r in got} == {n}
    key = lambda x: (x[1], round(x[3], 6), x[0], x[2])
    have = sorted(((r.held_out, r.n_tokens, r.n_known, r.base_score) for r in got), key=key)
    for a, b in zip(have, sorted(want, key=key), strict=True):
        assert a[:3] == b[:3] and close(a[3], b[3])


def test_empty_and_untrained(spark):
    assert scoring.scores(data.empty(spark)).count() == 0
    only = next(i for i in range(1000) if data.held_out(i, 10))
    r = scoring.scores(spark.createDataFrame([(only, "a b")], "doc_id bigint, text string")).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0)


def test_filter_never_gives_too_small_levels(spark):
    texts = [(i, data.prose(i % 3, 200)) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").selectExpr("CAST(text AS BINARY) AS data", "doc_id", "false AS held_out")
    table = scoring.counted(docs.mapInArrow(scoring.split, scoring.BLOCKS), 512)
    model = scoring.fitted(table, 512)
    for r in table.collect():
        for x, c in ((r.pairs, r.pair_counts),):
            x, c = np.frombuffer(x, "<u8"), np.frombuffer(c, "<u8").astype(np.int64)
            if len(x):
                assert (scoring.levels_in(model, x, 512) >= scoring.level(c)).all()
    strangers = scoring.mix(np.arange(20_000, dtype=np.uint64))
    assert (scoring.levels_in(model, strangers, 512) > 0).mean() < 0.02
    middle = scoring.level_counts()
    assert middle[1] == 1 and middle[2] == 2 and all(scoring.level(np.array([1, 2, 3])) == [1, 2, 3])


def test_what_is_known_does_not_depend_on_the_broadcast_bounds(spark):
    """Pairs outside the broadcast filter, those seen once too, are found at their shards: the model score stays the same."""
    docs = spark.createDataFrame([(i, data.prose(i, 150)) for i in range(80)], "doc_id bigint, text string")
    wide = {r.doc_id: r.score for r in scoring.scores(docs).collect()}
    for bits, words in ((1 << 16, 3), (64, 0)):
        got = {r.doc_id: r.score for r in scoring.scores(docs, max_bits=bits, frequent=words).collect()}
        assert sum(abs(got[i] - wide[i]) for i in wide) < 5e-3 * sum(abs(x) for x in wide.values())


def test_pairs_seen_once_are_known(spark):
    """'a b' was seen once in training and 'b a' never, from words of equal counts."""
    train = [i for i in range(1000) if not data.held_out(i, 10)][:2]
    asked = [i for i in range(1000) if data.held_out(i, 10)][:2]
    rows = [(train[0], "x a b y"), (train[1], "y b x a z"), (asked[0], "a b"), (asked[1], "b a")]
    got = {r.doc_id: r.score for r in scoring.scores(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[asked[0]] > got[asked[1]] + 1e-6


def test_regions_grow_with_the_pairs():
    small, large = (scoring.region(scoring.mix(np.arange(n, dtype=np.uint64)), np.ones(n, np.int64)) for n in (1000, 50_000))
    assert len(large) > 45 * len(small)
    strangers = scoring.mix(np.arange(1 << 20, (1 << 20) + 20_000, dtype=np.uint64))
    assert (scoring.levels_at(large, 8 * len(large), scoring.mix(np.arange(50_000, dtype=np.uint64))) >= 1).all()
    assert (scoring.levels_at(large, 8 * len(large), strangers) > 0).mean() < 0.02


def plain_scores(rows, prior):
    """The model's score with counts known exactly, in dictionaries, and quantised as the filter does."""
    split = [[*data.words(data.low(t)), None] for _, t in rows]
    train = [w for (i, _), w in zip(rows, split) if not data.held_out(i, 10)]
    words = Counter(x for w in train for x in w)
    pairs = Counter(p for w in train for p in zip([None, *w], w))
    n, v, middle = sum(words.values()), len(words), scoring.level_counts()
    about = lambda c: float(middle[scoring.level(np.array([c]))[0]]) if c else 0.0
    out, unseen = [], 0.0
    for (i, _), w in zip(rows, split):
        total = 0.0
        for p in zip([None, *w], w):
            first, second = about(words[p[0]]), about(words[p[1]])
            pair = min(about(pairs[p]), first, second)
            own = (second + 0.1) / (n + 0.1 * (v + 1))
            total += math.log10((pair + prior * own) / (max(first, pair) + prior))
            if not data.held_out(i, 10):
                once = max(pair - 1, 0.0)
                unseen += math.log10((once + prior * own) / (max(max(first, pair) - 1, once) + prior))
        out.append(total)
    return out, unseen


def test_scores_equal_a_plain_model(spark, monkeypatch):
    """With so many bits that no probe is wrong, each row's score is that of exact dictionaries, and the weight the best of all."""
    monkeypatch.setattr(scoring, "BITS_PER_LEVEL", 4000)
    docs = [*data.documents().items()][:60] + [(1000, data.prose(1, 50)), (1001, data.prose(1, 50)), (1002, None), (1003, "never seen before")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    for bounds in ({}, {"max_bits": 1 << 20, "frequent": 20}):
        got = {r.doc_id: r for r in scoring.scores(df, **bounds).collect()}
        prior = got[1002].prior
        want, _ = plain_scores(docs, prior)
        assert all(close(got[i].score, x) for (i, _), x in zip(docs, want))
        assert prior == max(scoring.PRIORS, key=lambda k: plain_scores(docs, k)[1])
