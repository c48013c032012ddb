from collections import Counter

import numpy as np
from xxhash import xxh64_intdigest

import corpus_pipeline
from tests.llm import data
from tests.llm.test_mixing import plain_targets
from tests.llm.test_quality import plain


def row_hash(doc_id, text):
    seed = 42
    for part in (None if doc_id is None else np.int64(doc_id).tobytes(), None if text is None else text.encode("utf-8")):
        seed = seed if part is None else xxh64_intdigest(part, seed)
    return seed >> 1


def plain_mix(rows):
    """(doc_id, text, source) rows -> how often each row stays, by walking each source in hash order."""
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(data.words(t))
    target, out = plain_targets(sizes), Counter()
    for s in sizes:
        whole = int(target[s] // sizes[s]) if sizes[s] else 0
        rest, below, run = target[s] - whole * sizes[s], 0, 0
        mine = sorted((row_hash(i, t), len(data.words(t))) for i, t, x in rows if x == s)
        if rest > 0:
            below = 1 << 63
            for h in sorted({h for h, _ in mine}):
                n = sum(k for g, k in mine if g == h)
                if run + n > rest:
                    below = h + (run + n - rest < rest - run)
                    break
                run += n
        for i, t, x in rows:
            if x == s:
                out[i, t] += whole + (row_hash(i, t) < below)
    return out


def stage_rows(spark, docs, n):
    for name, stage in corpus_pipeline.STAGES[:n]:
        docs = stage(spark, docs, data.SF)
    return docs


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{data.SF}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    known = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, data.SF).collect()}
    assert len(known) >= 0.99 * len(rows)  # prose in four languages stays
    rows = [r for r in rows if r[0] in known and not plain(r[1])[-1]]
    rows.sort()
    least = data.components([data.fingerprint(t) for _, t, _ in rows])
    rows = [r for k, r in enumerate(rows) if least[k] == k]
    want = plain_mix(rows)
    got = Counter(r.doc_id for r in corpus_pipeline.run(spark, data.SF).select("doc_id").collect())
    assert got == Counter({i: n for (i, _), n in want.items() if n})


def test_all_but_the_last_return_the_columns(spark):
    docs = data.dirty(spark)
    for n in range(1, len(corpus_pipeline.STAGES)):
        made = stage_rows(spark, docs, n)
        assert made.columns == docs.columns and [t for _, t in made.dtypes] == [t for _, t in docs.dtypes]
    assert stage_rows(spark, docs, len(corpus_pipeline.STAGES)).count() > 0
    assert stage_rows(spark, data.empty(spark), len(corpus_pipeline.STAGES)).count() == 0
