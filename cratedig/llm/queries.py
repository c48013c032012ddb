"""The registered queries of this package and the SQL some of them are checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cratedig import session
from cratedig.llm import compression, language, licences, mixing, neighbours, pieces, quality, records, scoring, simhash, spelling, toxicity, trie

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_token_records")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes token records of all documents and reads them back: one row per record."""
    path = session.scratch(spark, "token-records")
    records.write(table(spark, sf_dir, "documents"), path, WORD_BPE, end_id=2)
    return records.write_index(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "offset", "length")


@query("op2_simhash_near_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.component_ids(table(spark, sf_dir, "documents"))


@query("op3_source_mix")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes, targets and words taken of every document."""
    return mixing.taken(table(spark, sf_dir, "documents"))


@query("op6_piece_encoding")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's piece ids and of their decoding."""
    return pieces.digests(table(spark, sf_dir, "documents"), PIECE_BPE)


@query("op8_lm_scores")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model and unigram scores of every document."""
    return scoring.scores(table(spark, sf_dir, "documents"))


@query(
    "op9_host_quality",
    sql="""
    WITH texts AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
    split AS (
        SELECT *, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w,
            list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
        FROM texts),
    windows AS (
        SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win
        FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM split WHERE len(w) >= 3)),
    twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM windows) WHERE n > 1),
    words AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
    measured AS (
        SELECT s.r, doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
            len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
            len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
        FROM split s LEFT JOIN words USING (r)),
    failed AS (
        SELECT *, n_words < 50 AS f_short, 100 * n_repeat_words > 50 * n_words AS f_repeated,
            10 * n_symbols > word_chars AS f_symbols, 10 * n_dup_lines > 3 * n_lines AS f_lines
        FROM measured),
    rules AS (
        SELECT source, rule, count(*) AS n, count(*) FILTER (WHERE f) AS k FROM (
            SELECT source, unnest(['short', 'repeated', 'symbols', 'lines']) AS rule,
                unnest([f_short, f_repeated, f_symbols, f_lines]) AS f FROM failed)
        GROUP BY source, rule),
    seen AS (
        SELECT rule, avg(k / n) AS mean, var_pop(k / n) AS spread, avg(1 / n) AS inverse FROM rules GROUP BY rule),
    priors AS (
        SELECT rule, mean, greatest(spread - mean * (1 - mean) * inverse, 0) AS between_hosts FROM seen),
    strengths AS (
        SELECT rule, mean, CASE WHEN between_hosts > 0
            THEN least(1000, greatest(10, mean * (1 - mean) / between_hosts - 1)) ELSE 1000 END AS strength FROM priors),
    hosts AS (
        SELECT source, bool_or((k + mean * strength) / (n + strength) > 0.5) AS host_failed
        FROM rules JOIN strengths USING (rule) GROUP BY source)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f_short OR f_repeated AS base_failed,
        NOT (f_short OR f_repeated) AND NOT host_failed AS kept, host_failed
    FROM failed JOIN hosts ON failed.source IS NOT DISTINCT FROM hosts.source
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdicts of every document."""
    return quality.judged(table(spark, sf_dir, "documents"))


@query(
    "op10_block_neighbours",
    sql="""
    WITH v AS (
        SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    pairs AS (
        SELECT q.r, q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) AS score
        FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.r <> c.r)
    SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM pairs
    WINDOW best AS (PARTITION BY r ORDER BY score DESC, vec_id)
    QUALIFY rank <= 20
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels of those not held out."""
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document (doc_id) and of every web page (page_id)."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    none = F.lit(None).cast("long")
    of_docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), none.alias("page_id"), "text", *language.evidence_of_documents(docs))
    of_pages = pages.select(none.alias("doc_id"), F.col("page_id").cast("long").alias("page_id"), language.page_text().alias("text"), *language.evidence_of_pages())
    return language.identified(of_docs.unionByName(of_pages))


@query("op5_licence_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence statements of every document."""
    return licences.scanned(table(spark, sf_dir, "documents"))


#: crc32 of ASCII text in SQL: its table from the generating polynomial, then byte by byte.
CRC = """
    tab AS (
        SELECT list(v ORDER BY b) AS tab FROM (
            SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v
            FROM range(256) r(b)))"""


def crc_of(bytes_: str) -> str:
    return f"xor(list_reduce(list_concat([4294967295], {bytes_}), lambda x, y: xor(x >> 8, tab[(xor(x, y) & 255) + 1])), 4294967295)"


@query(
    "op11_prefix_trie",
    sql=f"""
    WITH {CRC},
    own AS (
        SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    opened AS (SELECT *, {crc_of("list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))")} % 4 AS h FROM own, tab),
    convs AS (
        SELECT o.conv_id, list_concat(coalesce(b.turns, [])[1:o.h], o.turns[o.h + 1:]) AS turns
        FROM opened o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
    spots AS (SELECT conv_id AS member, d AS depth, turns[1:d] AS prefix, d = len(turns) AS ends FROM convs, unnest(range(len(turns) + 1)) u(d)),
    grouped AS (
        SELECT depth, prefix, min(member) AS conv_id, count(*) AS n_convs,
            sha256(coalesce(string_agg(CAST(member AS VARCHAR), ',' ORDER BY member) FILTER (WHERE ends), '')) AS ends_sha256
        FROM spots GROUP BY depth, prefix),
    parents AS (
        SELECT g.*, p.conv_id AS parent_conv_id,
            (g.n_convs - 1) * CASE WHEN g.depth = 0 THEN 0 ELSE len(list_filter(string_split_regex(g.prefix[-1].t, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) END AS saved
        FROM grouped g LEFT JOIN grouped p ON p.depth = g.depth - 1 AND p.prefix = g.prefix[1:g.depth - 1]),
    kids AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM parents WHERE depth > 0 GROUP BY ALL),
    full_nodes AS (SELECT p.*, coalesce(n_children, 0) AS n_children FROM parents p LEFT JOIN kids USING (conv_id, depth)),
    ancestors AS (
        SELECT g.conv_id AS top, g.depth AS top_depth, s.member, s.depth FROM spots s JOIN grouped g USING (depth, prefix)),
    sums AS (
        SELECT a.top AS conv_id, a.top_depth AS depth, sum(v.saved) AS saved_tokens, count(*) FILTER (WHERE v.n_children = 0) AS n_leaves
        FROM full_nodes v JOIN ancestors a ON a.member = v.conv_id AND a.depth <= v.depth GROUP BY ALL)
    SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
    FROM full_nodes JOIN sums USING (conv_id, depth)
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of rebuilt conversations with its subtree totals."""
    return trie.nodes(table(spark, sf_dir, "conversations"))


UTF8 = "flatten(list_transform(string_split({}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, CAST(unicode(c) AS BIGINT) - 64] END))"


@query(
    "op12_spelling_variants",
    sql=f"""
    WITH RECURSIVE {CRC},
    runs AS (
        SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
        FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents)
        WHERE length(run) >= 7 GROUP BY ALL),
    hashed AS (
        SELECT run, n, {crc_of(UTF8.format("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run"))} AS h FROM runs, tab),
    counted AS (
        SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n) AS n
        FROM hashed GROUP BY 1),
    words AS (SELECT word, CAST(n AS BIGINT) AS n, length(word) AS c FROM counted WHERE n >= 2 AND length(word) >= 7),
    shorter AS (SELECT word, n, c, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM words, unnest(range(c)) u(i)),
    near AS (
        SELECT a.word, b.word AS near FROM shorter a JOIN shorter b USING (c, i, rest) WHERE a.word <> b.word
        UNION SELECT s.word, w.word FROM shorter s JOIN words w ON s.rest = w.word
        UNION SELECT w.word, s.word FROM shorter s JOIN words w ON s.rest = w.word),
    best AS (
        SELECT near.word, count(*) AS n_near, max(o.n) AS top, list(near.near ORDER BY o.n DESC, encode(near.near))[1] AS form
        FROM near JOIN words o ON o.word = near.near GROUP BY near.word),
    formed AS (
        SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 10 * w.n THEN form END AS form, CASE WHEN top >= 10 * w.n THEN top END AS form_n
        FROM words w LEFT JOIN best USING (word)),
    walk AS (
        SELECT word, word AS last FROM formed
        UNION ALL SELECT walk.word, formed.form FROM walk JOIN formed ON walk.last = formed.word WHERE formed.form IS NOT NULL),
    walked AS (SELECT walk.word, walk.last AS root FROM walk JOIN formed ON walk.last = formed.word WHERE formed.form IS NULL)
    SELECT word, form, root, n, n_near, form_n FROM formed JOIN walked USING (word)
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words' number, usual form and root."""
    return spelling.grouped(table(spark, sf_dir, "documents"))


@query("op13_compression_quality")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, by which dictionary compresses it better."""
    return compression.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
