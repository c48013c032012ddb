"""Golden cases for the expressions, including every branch of the rule chains."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from cratedig.functions import bodies, errors, formats, text, times
from cratedig.operators import dedup, queues


def values(spark, inputs, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {dtype}")
    return [r[1] for r in df.select("i", fn(F.col("v"))).orderBy("i").collect()]


def test_release_dates(spark):
    got = values(spark, ["2002", "2002-01", "2002-01-31", "2002-13", "x", None, "2002\n", "2002-02-30"], text.format_release_date)
    assert got == [date(2002, 1, 1), date(2002, 1, 1), date(2002, 1, 31), None, None, None, None, None]


def test_producer_names(spark):
    names = [None, "", "  ", "  Metro  Boomin'", "!!!", " Ab C", "Ünal"]
    assert values(spark, names, text.normalize_producer_name) == [
        "unknown_producer", "unknown_producer", "unknown_producer", "_metro_boomin", "unknown_producer", "_ab_c", "nal",
    ]
    assert values(spark, names, text.normalize_producer_name_spaces)[3:6] == ["metro boomin", "unknown_producer", "ab c"]


def test_track_names(spark):
    assert values(spark, ["Señor (Remix) 2", "夜"], text.normalize_track_name) == ["seorremix2", ""]
    assert values(spark, ["Señor 2", "夜"], lambda c: text.normalize_track_name(c, unicode=True)) == ["señor2", "夜"]


def test_track_names_lose_all_but_ascii_letters_and_digits(spark):
    names = ["".join(map(chr, range(128))), "Àé-B_c 9", "\u212aelvin \u0130I", "a\u0301\U0001f3b5Z", "\x00tab\t\x7f.", "", None]
    want = [None if n is None else re.sub("[^a-zA-Z0-9]", "", n).lower() for n in names]
    assert values(spark, names, text.normalize_track_name) == want


def test_credit_text(spark):
    html = (
        "<p>Produced by Metro Boomin, mixed by X. Producers: A B C<br>Producer: Zed</p> beats by Dr Dre <i>produced by "
        + "x" * 60 + "</i> Beat by one two three four five six."
    )
    got = values(spark, [html, None, "nothing"], text.credit_names)
    assert got[0] == ["Metro Boomin", "A B C", "Zed", "Dr Dre"]
    assert got[1] == [] or got[1] is None
    assert got[2] == []


def test_credits_in_order(spark):
    song = (
        '{"id":1,"producer_artists":[{"id":1,"name":"P"},{"id":2,"name":""},null,{"id":3}],'
        '"custom_performances":[{"label":"Beat Maker","artists":[{"id":4,"name":"B"}]},{"label":"Mixing","artists":[{"id":5,"name":"M"}]},'
        '{"label":null,"artists":[]},{"label":"Co-Producer"}],"description":{"html":"Produced by T."}}'
    )
    from cratedig import schemas

    got = values(spark, [song, "{}"], lambda c: text.extract_producers(F.from_json(c, schemas.SONG)))
    assert [(c.name, c.confidence, c.source) for c in got[0]] == [
        ("P", 0.95, "genius_producer_artists"), ("B", 0.9, "genius_custom_performances"), ("T", 0.7, "genius_description"),
    ]
    assert got[1] == []


def test_keys_and_links(spark):
    assert values(spark, ["a b/ü:x_1-"], lambda c: text.sanitize_dedup_key(c, "ns")) == ["dedup:ns:a-b--:x_1-"]
    assert values(spark, ["Dr. Dre"], text.social_links)[0].website == "https://drdre.com"
    with pytest.raises(ValueError):
        text.dedup_key_for("nothing", F.lit(1))


@pytest.mark.parametrize(
    "body, want",
    [
        ('{"a":1}', '{"a":1}'),
        ('"{\\"a\\":1}"', '{"a":1}'),
        ('{"message":"{\\"a\\":1}"}', '{"a":1}'),
        ('{"message":{"a":1},"msg_id":"4"}', '{"a":1}'),
        ('{"message":{"message":{"a":1}}}', '{"a":1}'),
        ('{"message":{"message":{"a":1},"b":2}}', '{"message":{"a":1},"b":2}'),
        ('{"message":null,"a":1}', '{"message":null,"a":1}'),
        ("{broken", None),
        ('{"message":"broken"}', None),
        ("[1]", None),
        (None, None),
    ],
)
def test_parse_body(spark, body, want):
    assert values(spark, [body], bodies.parse_body) == [want]


def test_body_fields(spark):
    assert values(spark, ['{"msgId":7}', '{"message":{"id":3}}', '{"id":null,"messageId":"x"}', "{}"], bodies.extract_message_id) == [
        "7", "3", "x", None,
    ]
    assert values(spark, ['{"a":null}', '{"b":1}', None], lambda c: bodies.json_has_key(c, "a")) == [True, False, False]
    track = values(spark, ['{"albumSpotifyId":"s","albumId":"","offset":50}'], lambda c: bodies.coalesce_aliases(c, "track_discovery"))[0]
    assert track.asDict() == {"album_spotify_id": "s", "album_name": "Unknown Album", "album_id": None, "artist_id": None, "offset": 50}
    same = values(spark, ['{"b":1,"a":"x"}', '{"a":"x","b":1}'], lambda c: bodies.idempotency_key(F.lit("q"), c))
    assert same[0] == same[1] and same[0].startswith("q:")
    assert values(spark, ['{"_idempotencyKey":"k"}'], lambda c: bodies.idempotency_key(F.lit("q"), c)) == ["q:k"]
    assert values(spark, ['{"track_id":"t"}', '{"idempotencyKey":"k"}', '{"x":1}'], bodies.track_operation_key) == [
        "track:t:producer-identification", "k", 'producer-identification:7:{"x":1}',
    ]


def test_merge_maps(spark):
    df = spark.createDataFrame([({"a": "1", "b": "1"}, {"b": "2"}), (None, {"c": "3"}), ({"a": "1"}, None)], "o map<string,string>, n map<string,string>")
    got = [r[0] for r in df.select(bodies.json_merge(F.col("o"), F.col("n"))).collect()]
    assert got == [{"a": "1", "b": "2"}, {"c": "3"}, {"a": "1"}]


CASES = [
    # message, name, status, code, source, category
    ("spotify says rate limit", "", None, None, None, "TRANSIENT_RATE_LIMIT"),
    ("spotify x", "", 429, None, None, "TRANSIENT_RATE_LIMIT"),
    ("spotify exceeded", "", None, None, None, "TRANSIENT_RATE_LIMIT"),
    ("spotify x", "", 403, None, None, "PERMANENT_AUTH"),
    ("x", "", 401, None, "GENIUS_API", "PERMANENT_AUTH"),
    ("spotify timed out", "", None, None, None, "TRANSIENT_TIMEOUT"),
    ("x", "TimeoutError", None, None, "REDIS", "TRANSIENT_TIMEOUT"),
    ("statement_timeout in sql", "", None, "57014", None, "TRANSIENT_TIMEOUT"),
    ("spotify econnreset", "", None, None, None, "TRANSIENT_NETWORK"),
    ("redis ECONNREFUSED", "", None, None, None, "TRANSIENT_NETWORK"),
    ("spotify x", "", 503, None, None, "TRANSIENT_SERVICE"),
    ("genius x", "", 599, None, None, "TRANSIENT_SERVICE"),
    ("genius not found", "", 404, None, None, "PERMANENT_NOT_FOUND"),
    ("queue timeout", "", None, None, None, "UNKNOWN"),
    ("timeout", "", None, None, None, "UNKNOWN"),
    ("validation failed", "", None, None, None, "PERMANENT_VALIDATION"),
    ("x", "ValidationError", None, None, None, "PERMANENT_VALIDATION"),
    ("x", "", 400, None, None, "PERMANENT_BAD_REQUEST"),
    ("internal error", "", None, None, None, "SYSTEM"),
    (None, None, None, None, None, "UNKNOWN"),
]


def test_error_categories(spark):
    df = spark.createDataFrame(
        [(i, *c) for i, c in enumerate(CASES)], "i int, m string, n string, st int, code string, src string, want string"
    )
    got = df.select(
        "i", "m", "want", errors.classify_error(F.col("m"), F.col("n"), F.col("st"), F.col("code"), F.col("src")).alias("got")
    ).orderBy("i").collect()
    assert [(r.m, r.got) for r in got] == [(r.m, r.want) for r in got]
    kept = errors.classify_error(F.lit("x"), category=F.lit("SYSTEM"))
    assert spark.range(1).select(kept).first()[0] == "SYSTEM"


def test_simple_categories_and_delays(spark):
    assert values(spark, ["ETIMEDOUT", "malformed", "boom", None], errors.classify_error_simple) == ["TRANSIENT", "PERMANENT", "UNKNOWN", "UNKNOWN"]
    got = values(spark, [0, 3, 20], lambda c: errors.retry_delay_ms(c, F.lit(200), F.lit(10000)), "int")
    assert got == [200.0, 1600.0, 10000.0]
    assert len(errors.RETRY_POLICIES) == errors.retry_policies(spark).distinct().count() == 11


def test_formats(spark):
    assert values(spark, ["a@b.c", "a b@c.d", "a@b", None], formats.is_email) == [True, False, False, False]
    assert values(spark, ["550E8400-e29b-41d4-a716-446655440000", "550e8400-e29b-61d4-a716-446655440000"], formats.is_uuid) == [True, False]
    assert values(spark, ["0123456789", "012345678", "01234 6789", "x" * 31], formats.is_spotify_id) == [True, False, False, False]
    assert values(spark, ["5", "-5", "1.5", "x", None], formats.is_genius_id) == [True, False, False, False, False]
    assert values(spark, ["https://a.b/c", "nope", "mailto:x@y.z", None], formats.is_url) == [True, False, True, False]
    assert values(spark, ["2020-01-01", "2020-01-01T10:00:00Z", "x"], formats.is_date) == [True, True, False]


def test_times(spark):
    assert values(spark, [None, 0.5, 1.0, 23.96, 24.0, 36.0], times.human_eta, "double") == [
        "Cannot estimate", "30 minutes", "1.0 hours", "24.0 hours", "1.0 days", "1.5 days",
    ]
    done = spark.createDataFrame([(1, 8), (5, 8), (3, 0)], "a int, b int").select(times.pct_completion(F.col("a"), F.col("b")))
    assert [r[0] for r in done.collect()] == [12.0, 62.0, 100.0]
    assert [times.env_ttl_seconds(e) for e in ("Production", "staging", "test", "dev", None)] == [86400, 3600, 3600, 600, 600]
    assert values(spark, ["pgmq.a", "q_b", "qa", "q_q_c"], queues.queue_name_norm) == ["a", "b", "qa", "q_c"]


def test_key_patterns(spark):
    keys = ["dedup:a:x1", "dedup:b:x1", "dedup:a:y.z", "other:a:x"]
    assert values(spark, keys, lambda c: dedup.matches_keys(c)) == [True, True, True, False]
    assert values(spark, keys, lambda c: dedup.matches_keys(c, "a")) == [True, False, True, False]
    assert values(spark, keys, lambda c: dedup.matches_keys(c, None, "x*")) == [True, True, False, False]
    assert values(spark, keys, lambda c: dedup.matches_keys(c, "a", "y.z")) == [False, False, True, False]
