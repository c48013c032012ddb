import random
import re
import zlib
from collections import Counter

from cratedig.llm import spelling
from cratedig.llm.queries import QUERIES
from tests.llm import data


def near(a, b):
    """One letter replaced, added or taken away."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    """(id, text) -> word: (form, root, n, n_near, form_n), comparing every word with every other."""
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = data.low(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 7 and k >= 2}
    beside = {w: [o for o in n if near(w, o)] for w in n}
    best = {w: min(o, key=lambda x: (-n[x], x)) for w, o in beside.items() if o}
    form = {w: best[w] for w in best if n[best[w]] >= 10 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n[w], len(beside[w]), n[form[w]] if w in form else None) for w in n}


def found(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def edited(rng, word, letters):
    i, kind = rng.randrange(len(word)), rng.randrange(3)
    return word[:i] + (rng.choice(letters) if kind else "") + word[i + (kind != 2) :]


def vocabulary(rng, n, letters="abcdeé"):
    out = {"".join(rng.choices(letters, k=rng.randrange(7, 15))) for _ in range(n)}
    for _ in range(2):
        out |= {edited(rng, w, letters) for w in sorted(out)}
    return sorted(w for w in out if len(w) >= 7)


def test_all_pairs_are_found_once_and_only_near_ones(spark):
    rng = random.Random(2)
    words = [*vocabulary(rng, 120), *("ab" * 5, "ab" * 5 + "a", "a" * 7, "a" * 8, "a" * 9, "b" + "a" * 7, "y" * 60, "y" * 61)]
    words = sorted(set(words))
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    want = {(a, b) for i, a in enumerate(words) for b in words[:i] if near(a, b)}
    for share in (0.0, 1 / 50, 1.0):
        pairs = [(r.a, r.b) for r in spelling.near_pairs(df, spelling.dictionary(df, share)).collect()]
        assert len(pairs) == len(set(pairs)) == len(want) > 100
        assert {(max(p), min(p)) for p in pairs} == {(max(p), min(p)) for p in want}


def test_affected_grams_are_bounded():
    """Every gram that survives a block is a gram of the word, and of each word one edit in the block away; one always survives."""
    rng = random.Random(3)
    words = vocabulary(rng, 150, "abcé")
    counts = Counter(g for w in words for g in spelling.grams_of(w))
    grams = spelling.Grams([g for g in counts if len(g) == 2 or counts[g[:-1]] > 6])
    assert {len(g) for g in grams.grams} == {2, 3, 4}
    for w in rng.sample(words, 300):
        c = len(w)
        own = {(p, e): w[p:e] for p, e in grams.cut(w, spelling.widest(c))}
        for first, last in spelling.blocks(c):
            left, right = spelling.survivors(grams, w, c, first, last)
            assert left or right
            places = [(p, e) for p, e in own if e <= len(left) or p >= c - len(right)]
            for i in range(first, min(last, c - 1) + 1):
                for other in (w[:i] + "z" + w[i + 1 :], w[:i] + "z" + w[i:]):
                    shift = len(other) - c
                    theirs = set(grams.cut(other, spelling.widest(c)))
                    assert all((p, e) in theirs if e <= len(left) else (p + shift, e + shift) in theirs for p, e in places)
                    assert spelling.survivors(grams, other, c, first, last) == (left, right)


def test_against_all_pairs_of_words(spark):
    rng = random.Random(5)
    words = vocabulary(rng, 60)
    rows = [(i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(len(words))], k=200)).title()) for i in range(60)]
    rows += [(100, "Anything anything anythin ANYTHING " * 30 + "anythng anythng " + "ÀÉÎÕÜ×÷ÿabc ÀÉÎÕÜ×÷ÿabc"), (101, None), (None, "nothing-at-all nothing"), (None, "nothing")]
    rows += [(200, "chainlonx " * 3 + "chainlong " * 40 + "chaanlong " * 500)] * 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = plain(rows)
    assert found(spelling.grouped(df)) == want
    assert any(w[0] for w in want.values()) and want["chainlonx"][:2] == ("chainlong", "chaanlong")


def test_query(spark):
    docs = data.documents()
    assert found(QUERIES["op12_spelling_variants"](spark, data.SF)) == plain(docs.items())


def test_dirty_and_empty(spark):
    rows = [(r[0], r[1]) for r in data.dirty_rows()]
    assert found(spelling.grouped(data.dirty(spark))) == plain(rows)
    assert spelling.grouped(data.empty(spark)).count() == 0


def test_the_dictionary_keeps_to_its_bound(spark):
    rng = random.Random(6)
    words = spark.createDataFrame([("".join(rng.choices("abcdefgh", k=9)), 2) for _ in range(800)], "word string, n long")
    whole = spelling.dictionary(words, 0.0)
    assert {len(g) for g in whole} == {2, 3, 4} and len(whole) > 1000
    few = spelling.dictionary(words, 0.0, 200)
    assert {len(g) for g in few} >= {2} and 64 <= len(few) <= 200


def test_chains_of_forms(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(13)], "word string, form string")
    assert {r.word: r.root for r in spelling.roots(forms).collect()} == {f"w{i}": "w13" for i in range(13)}
