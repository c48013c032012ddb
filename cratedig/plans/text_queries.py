"""Name, credit, format and JSON-check queries over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cratedig.functions import bodies, formats, text
from cratedig.operators import upsert, validate
from cratedig.plans.registry import query
from cratedig.sources import testbed as tb

CREDIT = r"[Bb]y ([^<.,]+)"


@query("normalize_producer_name", "", r"""SELECT doc_id, CASE WHEN trim(t) = '' OR n = '' THEN 'unknown_producer' ELSE n END AS normalized_name FROM
  (SELECT doc_id, text AS t, regexp_replace(regexp_replace(lower(text), '[^0-9A-Za-z_\s]', '', 'g'), '\s+', '_', 'g') AS n FROM documents)""")
def _(s, d):
    return tb.table(s, d, "documents").select("doc_id", text.normalize_producer_name(F.col("text")).alias("normalized_name"))


@query("normalize_producer_name_spaces", "", r"""SELECT doc_id, CASE WHEN trim(t) = '' OR n = '' THEN 'unknown_producer' ELSE n END AS normalized_name FROM
  (SELECT doc_id, text AS t, trim(regexp_replace(regexp_replace(lower(text), '[^0-9A-Za-z_\s]', '', 'g'), '\s+', ' ', 'g')) AS n FROM documents)""")
def _(s, d):
    return tb.table(s, d, "documents").select("doc_id", text.normalize_producer_name_spaces(F.col("text")).alias("normalized_name"))


@query("normalize_track_name", "", "SELECT p_partkey, lower(regexp_replace(p_name, '[^a-zA-Z0-9]', '', 'g')) AS normalized_name FROM part")
def _(s, d):
    return tb.table(s, d, "part").select("p_partkey", text.normalize_track_name(F.col("p_name")).alias("normalized_name"))


@query("representative_track", "tracks albums", """SELECT artist_id, lower(regexp_replace(name, '[^a-zA-Z0-9]', '', 'g')) AS normalized_name, arg_min(track_id, (release_date, track_id)) AS representative_track_id
  FROM tracks JOIN albums USING (album_id) GROUP BY 1, 2""")
def _(s, d):
    rows = tb.tracks(s, d, names=True).select("track_id", "album_id", "name").join(
        tb.albums(s, d).select("album_id", "artist_id", "release_date"), "album_id"
    )
    return upsert.representative_track(rows, "release_date", "track_id")


@query("format_release_date", "albums", """SELECT album_id, CASE album_id % 4 WHEN 0 THEN make_date(year(release_date), 1, 1)
  WHEN 1 THEN make_date(year(release_date), month(release_date), 1) WHEN 2 THEN release_date END AS released FROM albums""")
def _(s, d):
    full = F.date_format("release_date", "yyyy-MM-dd")
    n = F.col("album_id") % 4
    given = F.when(n == 0, F.substring(full, 1, 4)).when(n == 1, F.substring(full, 1, 7)).when(n == 2, full).otherwise("x")
    return tb.albums(s, d).select("album_id", text.format_release_date(given).alias("released"))


@query("sanitize_dedup_key", "", "SELECT page_id, concat('dedup:pages:', regexp_replace(url, '[^a-zA-Z0-9_:-]', '-', 'g')) AS dedup_key FROM pages")
def _(s, d):
    return tb.table(s, d, "pages").select("page_id", text.sanitize_dedup_key(F.col("url"), "pages").alias("dedup_key"))


@query("truncate_text", "", "SELECT doc_id, substr(text, 1, 200) AS shown FROM documents")
def _(s, d):
    return tb.table(s, d, "documents").select("doc_id", text.truncate_text(F.col("text"), 200).alias("shown"))


@query("social_links", "", """SELECT c_custkey, concat('https://twitter.com/', b) AS twitter, concat('https://instagram.com/', b) AS instagram,
  concat('https://open.spotify.com/artist/', b) AS spotify, concat('https://', b, '.com') AS website
  FROM (SELECT c_custkey, regexp_replace(lower(c_name), '[^a-z0-9]', '', 'g') AS b FROM customer)""")
def _(s, d):
    return tb.table(s, d, "customer").select("c_custkey", text.social_links(F.col("c_name")).alias("l")).select("c_custkey", "l.*")


@query("enrich_producers", "producers", """SELECT producer_id, name, CASE WHEN enriched_at IS NULL THEN TIMESTAMP '2001-08-02 00:00:00' ELSE enriched_at END AS enriched_at,
  CASE WHEN enriched_at IS NULL THEN concat('https://', regexp_replace(lower(name), '[^a-z0-9]', '', 'g'), '.com') END AS website FROM producers""")
def _(s, d):
    rows = upsert.enrich_producers(tb.producers(s, d), tb.CATALOG_AS_OF)
    return rows.select("producer_id", "name", "enriched_at", "social_links.website")


CREDIT_SQL = r"""hit AS (SELECT {key}, unnest(regexp_extract_all({col}, '[Bb]y ([^<.,]+)', 1)) AS raw FROM {table}),
nm AS (SELECT {key}, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS name FROM hit)
SELECT {key}, name, count(*) AS n FROM nm WHERE length(name) < 50 AND len(string_split(name, ' ')) < 6 GROUP BY 1, 2"""


def _credits(s, d, table, key, column):
    names = text.credit_names(F.col(column), (CREDIT,))
    return (
        tb.table(s, d, table).select(key, F.explode(names).alias("name"))
        .groupBy(key, "name").agg(F.count(F.lit(1)).alias("n"))
    )


@query("extract_producers_text", "", "WITH " + CREDIT_SQL.format(key="doc_id", col="text", table="documents"))
def _(s, d):
    return _credits(s, d, "documents", "doc_id", "text")


@query("extract_producers_text_pages", "", "WITH " + CREDIT_SQL.format(key="page_id", col="html", table="pages"))
def _(s, d):
    return _credits(s, d, "pages", "page_id", "html")


def _songs(s, d):
    """A song payload per supplier, credited in all three ways."""
    k, n = F.col("s_suppkey"), F.col("s_name")
    who = F.struct(k.alias("id"), n.alias("name"))
    nobody = F.struct(k.alias("id"), F.lit("").alias("name"))
    return tb.table(s, d, "supplier").select(
        k.alias("track_id"),
        F.struct(
            k.alias("id"), n.alias("title"), who.alias("primary_artist"),
            F.array(who, nobody).alias("producer_artists"),
            F.array(
                F.struct(F.lit("Co-Producer").alias("label"), F.array(F.struct(k.alias("id"), F.concat(F.lit("co "), n).alias("name"))).alias("artists")),
                F.struct(F.lit("Mixing").alias("label"), F.array(who).alias("artists")),
            ).alias("custom_performances"),
            F.struct(F.concat(F.lit("<p>Produced by "), n, F.lit("<br>Beats by Dr "), n, F.lit(".</p>")).alias("html")).alias("description"),
        ).alias("song"),
    )


SONG_SQL = """SELECT s_suppkey AS track_id, {cols} FROM supplier"""
CREDITS_ALL = """WITH c AS (SELECT s_suppkey AS track_id, 0 AS position, s_name AS name, 0.95::DOUBLE AS confidence, 'genius_producer_artists' AS source FROM supplier
 UNION ALL SELECT s_suppkey, 1, concat('co ', s_name), 0.9, 'genius_custom_performances' FROM supplier
 UNION ALL SELECT s_suppkey, 2, s_name, 0.7, 'genius_description' FROM supplier
 UNION ALL SELECT s_suppkey, 3, concat('Dr ', s_name), 0.7, 'genius_description' FROM supplier) """


@query("extract_producers", "", CREDITS_ALL + "SELECT * FROM c")
def _(s, d):
    rows = _songs(s, d).select("track_id", F.posexplode(text.extract_producers(F.col("song"))).alias("position", "c"))
    return rows.select("track_id", "position", "c.name", "c.confidence", "c.source")


@query("extract_producers_structured", "", CREDITS_ALL + "SELECT track_id, name, confidence, source FROM c WHERE position < 2")
def _(s, d):
    rows = _songs(s, d).select("track_id", F.explode(text.extract_producers_structured(F.col("song"))).alias("c"))
    return rows.select("track_id", "c.name", "c.confidence", "c.source")


# --- formats ---------------------------------------------------------------

@query("is_email", "", r"SELECT doc_id, regexp_matches(w, '^[^\s@]+@[^\s@]+\.[^\s@]+$') AS ok, count(*) AS n FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\s+')) AS w FROM documents) GROUP BY 1, 2")
def _(s, d):
    """Every whitespace-separated word of every document, tested and counted."""
    words = tb.table(s, d, "documents").select("doc_id", F.explode(F.split("text", r"\s+", -1)).alias("w"))
    return words.groupBy("doc_id", formats.is_email(F.col("w")).alias("ok")).agg(F.count(F.lit(1)).alias("n"))


@query("is_url", "", "SELECT page_id, regexp_matches(url, '^[a-z]+://[^ ]+$') AS ok, false AS title_ok FROM pages")
def _(s, d):
    return tb.table(s, d, "pages").select(
        "page_id", formats.is_url(F.col("url")).alias("ok"), formats.is_url(F.lit("no address")).alias("title_ok")
    )


@query("is_uuid", "", "SELECT doc_id, doc_id % 2 = 0 AS ok FROM documents")
def _(s, d):
    h = F.md5("text")
    made = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("4"), F.substring(h, 14, 3)),
                       F.concat(F.lit("a"), F.substring(h, 18, 3)), F.substring(h, 21, 12))
    given = F.when(F.col("doc_id") % 2 == 0, F.upper(made)).otherwise(F.concat(made, F.lit("0")))
    return tb.table(s, d, "documents").select("doc_id", formats.is_uuid(given).alias("ok"))


@query("is_spotify_id", "", "SELECT c_custkey, regexp_matches(CASE WHEN c_custkey % 2 = 0 THEN replace(c_name, '#', '') ELSE c_name END, '^[0-9a-zA-Z]{10,30}$') AS ok FROM customer")
def _(s, d):
    given = F.when(F.col("c_custkey") % 2 == 0, F.regexp_replace("c_name", "#", "")).otherwise(F.col("c_name"))
    return tb.table(s, d, "customer").select("c_custkey", formats.is_spotify_id(given).alias("ok"))


@query("is_genius_id", "", "SELECT c_custkey, c_custkey > 0 AS key_ok, false AS name_ok, c_acctbal > 0 AND c_acctbal = floor(c_acctbal) AS balance_ok FROM customer")
def _(s, d):
    return tb.table(s, d, "customer").select(
        "c_custkey", formats.is_genius_id(F.col("c_custkey")).alias("key_ok"),
        formats.is_genius_id(F.col("c_name")).alias("name_ok"), formats.is_genius_id(F.col("c_acctbal")).alias("balance_ok"),
    )


@query("is_date", "", "SELECT o_orderkey, true AS date_ok, false AS status_ok FROM orders")
def _(s, d):
    return tb.table(s, d, "orders").select(
        "o_orderkey", formats.is_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date_ok"),
        formats.is_date(F.col("o_orderpriority")).alias("status_ok"),
    )


@query("in_enum", "", "SELECT o_orderkey, o_orderstatus IN ('F', 'O') AS ok FROM orders")
def _(s, d):
    return tb.table(s, d, "orders").select("o_orderkey", formats.in_enum(F.col("o_orderstatus"), ["F", "O"]).alias("ok"))


@query("check_string", "", "SELECT doc_id, length(text) BETWEEN 20 AND 2000 AND regexp_matches(text, '^[A-Z]') AS ok FROM documents")
def _(s, d):
    return tb.table(s, d, "documents").select("doc_id", formats.check_string(F.col("text"), 20, 2000, "^[A-Z]").alias("ok"))


@query("check_number", "", "SELECT c_custkey, c_acctbal BETWEEN 0 AND 5000 AS ok FROM customer")
def _(s, d):
    return tb.table(s, d, "customer").select("c_custkey", formats.check_number(F.col("c_acctbal"), 0, 5000).alias("ok"))


@query("check_boolean", "", "SELECT event_id, event_id % 3 < 2 AS ok FROM events")
def _(s, d):
    n = F.col("event_id") % 3
    raw = F.when(n == 0, "true").when(n == 1, "false").otherwise("1")
    return tb.table(s, d, "events").select("event_id", formats.check_boolean(raw).alias("ok"))


@query("check_array", "", """SELECT doc_id, len(string_split(text, ' ')) BETWEEN 5 AND 400 AND list_max(list_transform(string_split(text, ' '), lambda w: length(w))) < 30 AS ok FROM documents""")
def _(s, d):
    words = F.split("text", " ", -1)
    ok = formats.check_array(words, 5, 400, lambda w: F.length(w) < 30)
    return tb.table(s, d, "documents").select("doc_id", ok.alias("ok"))


# --- JSON building and checking --------------------------------------------

@query("json_build", "", """SELECT c_custkey, concat('{"id":', CAST(c_custkey AS VARCHAR), ',"name":"', c_name, '"}') AS body FROM customer""")
def _(s, d):
    return tb.table(s, d, "customer").select("c_custkey", bodies.json_build(id=F.col("c_custkey"), name=F.col("c_name")).alias("body"))


@query("json_merge", "", "SELECT c_custkey, c_name AS name, c_mktsegment AS segment, 'x' AS fixed FROM customer")
def _(s, d):
    old = F.create_map(F.lit("name"), F.lit("old"), F.lit("fixed"), F.lit("x"))
    new = F.create_map(F.lit("name"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment"))
    m = bodies.json_merge(old, new)
    return tb.table(s, d, "customer").select("c_custkey", m.alias("m")).select(
        "c_custkey", F.col("m")["name"].alias("name"), F.col("m")["segment"].alias("segment"), F.col("m")["fixed"].alias("fixed")
    )


def _artist_payloads(s, d):
    """Artist payloads from customers; some ids, popularities and images are wrong on purpose."""
    k = F.col("c_custkey")
    spotify = F.when(k % 10 == 3, F.lit("short")).otherwise(F.lpad(k.cast("string"), 22, "0"))
    image = F.struct(F.when(k % 10 == 7, F.lit("nope")).otherwise(F.lit("https://i.example.com/1")).alias("url"), F.lit(64).alias("height"))
    body = F.to_json(F.struct(
        spotify.alias("id"), F.col("c_name").alias("name"), F.struct((k * 3).alias("total")).alias("followers"),
        F.array("c_mktsegment").alias("genres"), F.array(image).alias("images"),
        F.when(k % 10 == 5, 101).otherwise(k % 101).alias("popularity"),
    ))
    return tb.table(s, d, "customer").select(k, body.alias("payload"))


BAD_SQL = """bad AS (SELECT c_custkey, CASE c_custkey % 10 WHEN 3 THEN 'id' WHEN 5 THEN 'popularity' WHEN 7 THEN 'images[0].url' END AS path FROM customer)"""


@query("validate_spotify_artist", "", f"WITH {BAD_SQL} SELECT c_custkey, path IS NULL AS valid, CASE WHEN path IS NULL THEN 0 WHEN path LIKE 'images%' THEN 4 ELSE 2 END AS errors FROM bad")
def _(s, d):
    rows = validate.with_validation(_artist_payloads(s, d), "payload", validate.SPOTIFY_ARTIST)
    return rows.select("c_custkey", "valid", F.size("errors").alias("errors"))


@query("error_report", "", f"""WITH {BAD_SQL} SELECT c_custkey, 'SpotifyArtist' AS schema_name, path, 'pattern' AS rule, CASE path WHEN 'id' THEN concat('Field ''id'' must be a valid Spotify ID')
  ELSE 'Field ''images[0].url'' must be a valid URL' END AS message FROM bad WHERE path IN ('id', 'images[0].url')
  UNION ALL SELECT c_custkey, 'SpotifyArtist', path, 'maxValue', 'Field ''popularity'' must not exceed 100' FROM bad WHERE path = 'popularity'""")
def _(s, d):
    rows = validate.with_validation(_artist_payloads(s, d), "payload", validate.SPOTIFY_ARTIST)
    report = validate.error_report(rows, "SpotifyArtist", "c_custkey")
    return report.filter(F.col("rule") != "type").select("c_custkey", "schema_name", "path", "rule", "message")


@query("validate_schema", "", "SELECT event_id, true AS loose_ok, event_id % 4 <> 0 AS strict_ok FROM events")
def _(s, d):
    """The same bodies against a small schema, loosely and strictly."""
    e = F.col("event_id")
    body = F.to_json(F.struct(e.alias("k"), F.when(e % 4 == 0, F.lit("more")).alias("extra")))
    schema = {"k": validate.field(validate.NUMBER, required=True)}
    loose = validate.validate_schema(body, schema, validate.Options(strict=False))
    strict = validate.validate_schema(body, schema)
    return tb.table(s, d, "events").select(e, (F.size(loose) == 0).alias("loose_ok"), (F.size(strict) == 0).alias("strict_ok"))


@query("validate_spotify_album", "albums", "SELECT album_id, album_id % 6 <> 0 AS valid FROM albums")
def _(s, d):
    k = F.col("album_id")
    who = F.struct(F.lpad(F.col("artist_id").cast("string"), 22, "0").alias("id"), F.lit("n").alias("name"))
    body = F.to_json(F.struct(
        F.lpad(k.cast("string"), 22, "0").alias("id"), F.concat(F.lit("Album "), k).alias("name"),
        F.array(who).alias("artists"), F.when(k % 6 != 0, F.date_format("release_date", "yyyy")).alias("release_date"),
        F.col("total_tracks").alias("total_tracks"),
    ))
    return tb.albums(s, d).select("album_id", (F.size(validate.validate_spotify_album(body)) == 0).alias("valid"))


@query("validate_spotify_track", "albums", "SELECT album_id, album_id % 6 <> 1 AS valid FROM albums")
def _(s, d):
    k = F.col("album_id")
    who = F.struct(F.lpad(F.col("artist_id").cast("string"), 22, "0").alias("id"), F.lit("n").alias("name"))
    body = F.to_json(F.struct(
        F.lpad(k.cast("string"), 22, "0").alias("id"), F.concat(F.lit("Track "), k).alias("name"), F.array(who).alias("artists"),
        F.struct(F.lpad(k.cast("string"), 22, "0").alias("id"), F.lit("a").alias("name")).alias("album"),
        F.when(k % 6 == 1, -1).otherwise(k).alias("duration_ms"), (k % 2 == 0).alias("explicit"),
        F.lit("https://p.example.com/x").alias("preview_url"),
    ))
    return tb.albums(s, d).select("album_id", (F.size(validate.validate_spotify_track(body)) == 0).alias("valid"))


@query("validate_genius_song", "", "SELECT s_suppkey, s_suppkey > 0 AS valid FROM supplier")
def _(s, d):
    k = F.col("s_suppkey")
    who = F.struct(k.cast("string").alias("id"), F.col("s_name").alias("name"))
    body = F.to_json(F.struct(k.alias("id"), F.col("s_name").alias("title"), who.alias("primary_artist"), F.array(who).alias("producer_artists")))
    return tb.table(s, d, "supplier").select("s_suppkey", (F.size(validate.validate_genius_song(body)) == 0).alias("valid"))


@query("validate_stage_messages", "", """SELECT event_id, event_id % 3 <> 0 AS artist_ok, event_id % 3 <> 1 AS social_ok FROM events""")
def _(s, d):
    """Two of the stage message schemas over bodies derived from events."""
    e, n = F.col("event_id"), F.col("event_id") % 3
    artist = F.to_json(F.struct(F.when(n == 0, F.lit("short")).otherwise(F.lpad(e.cast("string"), 22, "0")).alias("artistId"), F.lit("n").alias("artistName")))
    h = F.md5(e.cast("string"))
    uuid = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("4"), F.substring(h, 14, 3)),
                       F.concat(F.lit("a"), F.substring(h, 18, 3)), F.substring(h, 21, 12))
    social = F.to_json(F.struct(F.when(n != 1, uuid).alias("producerId"), F.lit("p").alias("producerName")))
    return tb.table(s, d, "events").select(
        e, (F.size(validate.validate_stage_message(artist, "artist_discovery")) == 0).alias("artist_ok"),
        (F.size(validate.validate_stage_message(social, "social_enrichment")) == 0).alias("social_ok"),
    )


@query("validate_album_message", "", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 THEN false ELSE true END AS valid FROM orders""")
def _(s, d):
    """Both ids must look like catalog ids where they are given; one is too short, the other has a mark in it."""
    k = F.col("o_orderkey")
    body = F.to_json(F.struct(
        F.when(k % 3 == 0, F.lit("short")).otherwise(F.lpad(k.cast("string"), 22, "0")).alias("albumId"),
        F.when(k % 5 == 0, F.lpad(F.lit("-"), 22, "0")).when(k % 2 == 0, F.lpad(F.col("o_custkey").cast("string"), 22, "0")).alias("artistId"),
    ))
    return tb.table(s, d, "orders").select(k, (F.size(validate.validate_stage_message(body, "album_discovery")) == 0).alias("valid"))


@query("validate_track_message", "", """SELECT l_orderkey, l_linenumber, l_linenumber <> 3 AND l_returnflag <> 'R' AS valid FROM lineitem""")
def _(s, d):
    """A track id that is too long, or an album id that is a number instead of text."""
    k = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string")
    track = F.when(F.col("l_linenumber") == 3, F.lpad(k, 31, "0")).otherwise(F.lpad(k, 22, "0"))
    text = F.to_json(F.struct(track.alias("trackId"), F.lpad(F.col("l_orderkey").cast("string"), 22, "0").alias("albumId")))
    number = F.to_json(F.struct(track.alias("trackId"), F.col("l_orderkey").alias("albumId")))
    body = F.when(F.col("l_returnflag") == "R", number).otherwise(text)
    verdict = F.size(validate.validate_stage_message(body, "track_discovery")) == 0
    return tb.table(s, d, "lineitem").select("l_orderkey", "l_linenumber", verdict.alias("valid"))


@query("validate_credit_message", "", """SELECT p_partkey, (CASE WHEN p_partkey % 7 = 0 THEN 2 ELSE 0 END) + (CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END)
  + (CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END) AS n_errors FROM part""")
def _(s, d):
    """The id must be a UUID, which counts as two errors where it isn't, and all three fields must be there."""
    k = F.col("p_partkey")
    h = F.md5(k.cast("string"))
    uuid = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("4"), F.substring(h, 14, 3)),
                       F.concat(F.lit("a"), F.substring(h, 18, 3)), F.substring(h, 21, 12))
    body = F.to_json(F.struct(
        F.when(k % 7 == 0, F.lit("12")).otherwise(uuid).alias("trackId"), F.when(k % 3 != 0, F.col("p_name")).alias("trackName"),
        F.when(k % 4 != 0, F.col("p_brand")).alias("artistName"),
    ))
    return tb.table(s, d, "part").select(k, F.size(validate.validate_stage_message(body, "producer_identification")).alias("n_errors"))


@query("validate_queue_message", "", """SELECT event_id, event_id % 3 = 0 AS valid, CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 2 = 0
  THEN 'Invalid album discovery message: missing or empty artistId' ELSE 'Invalid producer identification message: missing or empty trackId' END AS error FROM events""")
def _(s, d):
    e = F.col("event_id")
    n, even = e % 3, e % 2 == 0
    value = F.when(n == 0, e.cast("string")).when(n == 1, F.lit(""))
    body = F.when(even, bodies.json_build(artistId=value)).otherwise(bodies.json_build(track_id=value))
    queue = F.when(even, "album_discovery").otherwise("producer_identification")
    return tb.table(s, d, "events").select(e, validate.validate_queue_message(queue, body).alias("v")).select(e, "v.valid", "v.error")


@query("validate_message_zod", "", """SELECT event_id, CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'artistName: Required' WHEN 2 THEN 'spotifyId: String must contain exactly 22 character(s)'
  ELSE 'popularity: Number must be less than or equal to 100' END AS errors FROM events""")
def _(s, d):
    e, n = F.col("event_id"), F.col("event_id") % 4
    body = F.to_json(F.struct(
        F.when(n == 2, F.lit("abc")).otherwise(F.lpad(e.cast("string"), 22, "0")).alias("spotifyId"),
        F.when(n != 1, F.lit("n")).alias("artistName"), F.when(n == 3, 101).otherwise(50).alias("popularity"),
    ))
    errors = F.array_join(validate.validate_message_zod(body, "artist_discovery"), "; ")
    return tb.table(s, d, "events").select(e, errors.alias("errors"))
