import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from cratedig.llm import language
from cratedig.llm.queries import QUERIES
from tests.llm import data

WORDS = {
    "aa": "kala palo tima saru neko lumi hata rino".split(),
    "be": "strzg wplk brmt zkrv ptsh grzw klmn vrtk".split(),
}


def text(lang, seed, n=12):
    rng = random.Random(f"{lang}{seed}")
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def rows(spark, extra=()):
    base = [(i, text(x, i), x, "org", "site.org", f"h{i % 3}.site.org") for i in range(120) for x in [("aa", "be")[i % 2]]]
    return spark.createDataFrame(base + list(extra), "id bigint, text string, declared string, suffix string, site string, host string")


def test_query_agrees_with_the_declared_language(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()}
    got = QUERIES["op7_language_id"](spark, sf).collect()
    docs = [r for r in got if r.doc_id is not None]
    assert len(docs) == len(truth) and sum(r.page_id is not None for r in got) == pq.read_table(f"{sf}/pages.parquet").num_rows
    assert sum(r.lang == truth[r.doc_id] for r in docs) >= 0.98 * len(docs)
    assert sum(r.kept for r in docs) >= 0.99 * len(docs)


def test_text_decides_against_a_wrong_tag(spark):
    got = {r.id: r for r in language.identified(rows(spark, [(500, text("aa", 7, 40), "be", "org", "site.org", "h0.site.org")])).collect()}
    assert got[500].lang == "aa"
    assert all(got[i].lang == ("aa", "be")[i % 2] for i in range(120))


def test_priors_decide_where_the_text_says_little(spark):
    """Ten hosts of one language each; a text of one unseen trigram-poor word follows its host."""
    more = [(1000 + i, text("aa", i), "aa", "net", "only.net", "x.only.net") for i in range(60)]
    more += [(2000, "xq", None, None, "only.net", "x.only.net"), (2001, "xq", None, None, "only.net", "new.only.net")]
    seen = language.with_likelihoods(rows(spark, more), language.fit([(text(x, i), x) for i in range(50) for x in WORDS], ["aa", "be"]), "ll")
    got = {r.id: r.posterior for r in language.fused(seen, 2).collect()}
    assert got[2000][0] > 0.6 and got[2001][0] > 0.6
    assert all(abs(sum(p) - 1) < 1e-9 for p in got.values())


def test_unknown_and_missing(spark):
    extra = [(600, None, None, None, None, None), (601, "", "aa", None, None, None), (602, "123 !!!", "aa", "org", None, None),
             (603, "日本語 文章 の 例 " * 30, None, None, None, None), (604, text("be", 3), None, None, None, None)]
    got = {r.id: r for r in language.identified(rows(spark, extra)).collect()}
    assert [got[i].kept for i in (600, 601, 602, 603, 604)] == [False, False, False, False, True]
    assert got[604].lang == "be" and got[600].lang is None
    bare = rows(spark).withColumn("declared", F.lit(None).cast("string"))
    assert not any(r.kept for r in language.identified(bare).collect())
    assert language.identified(rows(spark).where("false")).count() == 0


def test_page_evidence(spark):
    html = '<!DOCTYPE html><HTML class=x lang="FR"><script>var a="<p>";</script><body><!-- no --><p>Bon&nbsp;jour</p></body>'
    page = spark.createDataFrame([(html, "https://u@m.ex.example.com:80/a?b"), (None, None), ("plain", "nonsense")], "html string, url string")
    got = page.select(language.page_text().alias("t"), *language.evidence_of_pages()).collect()
    assert got[0].t.split() == ["Bon", "jour"]
    assert tuple(got[0])[1:] == ("fr", "com", "example.com", "m.ex.example.com")
    assert tuple(got[1]) == (None,) * 5 and tuple(got[2])[1:] == (None,) * 4


def test_dirty_rows(spark):
    kept = language.accepted(data.dirty(spark))
    assert kept.columns == data.dirty(spark).columns
    assert 0 < kept.count() <= len(data.dirty_rows())
    assert not [r for r in kept.collect() if not data.words(r.text)]
    assert language.accepted(data.empty(spark)).count() == 0


def test_a_rare_language_is_found_however_many_others_there_are(spark):
    """Six rows of 2,006, declared only by some rows, are a language of their own."""
    WORDS["ca"] = "oeghi uaqqo yioxe eijju oaxxu iuoqe".split()
    many = [(10_000 + i, text("aa", i), "aa", "org", "site.org", "h0.site.org") for i in range(2000)]
    few = [(20_000 + i, text("ca", i, 30), "ca", None, None, None) for i in range(6)] + [(30_000, text("ca", 99, 30), None, None, None, None)]
    got = {r.id: r.lang for r in language.identified(rows(spark, many + few)).where("id >= 20000").collect()}
    assert set(got.values()) == {"ca"} and len(got) == 7


def test_tags_that_are_no_codes_are_no_languages(spark):
    extra = [(500 + i, text("aa", i), "english", None, None, None) for i in range(30)]
    assert language.declared_languages(rows(spark, extra), "declared") == ["aa", "be"]


def test_pages_declare_languages_too(spark, tmp_path):
    """The query learns a language that no document has."""
    from cratedig.llm import queries

    WORDS["ca"] = "oeghi uaqqo yioxe eijju oaxxu iuoqe".split()
    docs = [(i, text(x, i, 40), x, "s") for i in range(60) for x in [("aa", "be")[i % 2]]]
    pages = [(i, f'<html lang="ca"><p>{text("ca", i, 40)}</p></html>', f"http://h{i}.cc/") for i in range(20)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(pages, "page_id bigint, html string, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = [r.lang for r in queries.QUERIES["op7_language_id"](spark, str(tmp_path)).collect() if r.page_id is not None]
    assert got == ["ca"] * 20


def test_the_sample_keeps_to_its_bound_and_takes_the_smallest_hashes(spark):
    many = [(i, text("aa", i, 6), "aa", None, None, None) for i in range(3000)] + [(i, text("be", i, 6), "be", None, None, None) for i in range(5000, 5030)]
    df = rows(spark, many)
    got = language.sample(df, "text", "declared", ["aa", "be"], 500)
    of = lambda x: [t for t, own in got if own == x]
    assert 250 <= len(of("aa")) <= 500 and len(set(of("aa"))) == len(of("aa"))
    hashes = {r.t: r.h for r in df.where("declared = 'aa'").selectExpr("text AS t", "xxhash64(text) AS h").distinct().collect()}
    assert max(hashes[t] for t in of("aa")) < min(h for t, h in hashes.items() if t not in set(of("aa")))
    assert len(of("be")) == df.where("declared = 'be'").select("text").distinct().count()


def test_many_languages_stay_within_the_stated_memory():
    """With every code of the list the model has four bytes a slot and language."""
    samples = [(" ".join(f"{code}{x}{code[::-1]}" for x in "qwertyuiop"), code) for code in language.CODES for _ in range(5)]
    model = language.fit(samples, list(language.CODES))
    assert model.logs.nbytes == language.SLOTS * len(language.CODES) * 4 < 50 << 20
    assert not any(x in language.CODES for x in ("zz", "qqq", "bb")) and len(set(language.CODES)) == len(language.CODES) < 200
