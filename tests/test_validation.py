"""Golden cases for the JSON checks."""

import pytest
from pyspark.sql import functions as F

from cratedig.operators import validate as V


def errors(spark, body, schema, **options):
    df = spark.createDataFrame([(body,)], "b string")
    got = df.select(V.validate_schema(F.col("b"), schema, V.Options(**options)).alias("e")).first().e
    return [(e.path, e.rule) for e in got]


SID = "abcdefghij1"


@pytest.mark.parametrize(
    "body, want",
    [
        ('{"id":"%s","name":"x"}' % SID, []),
        ('{"id":"%s","name":null,"images":null}' % SID, []),
        ("[]", [("root", "type")]),
        ("bad", [("root", "type")]),
        ("{}", [("id", "required"), ("name", "required")]),
        ('{"id":"%s","name":5}' % SID, [("name", "type"), ("name", "type")]),
        ('{"id":"%s","name":"x","popularity":101}' % SID, [("popularity", "maxValue"), ("popularity", "type")]),
        ('{"id":"%s","name":"x","more":1}' % SID, [("more", "additionalProperty")]),
        ('{"id":"%s","name":"x","genres":["a",1]}' % SID, [("genres[1]", "type"), ("genres[1]", "type"), ("genres", "type")]),
        (
            '{"id":"%s","name":"x","images":[{"height":1}]}' % SID,
            [("images[0].url", "required"), ("images[0]", "type"), ("images", "type")],
        ),
    ],
)
def test_artist(spark, body, want):
    assert errors(spark, body, V.SPOTIFY_ARTIST) == want


def test_options(spark):
    body = '{"more":1}'
    assert errors(spark, body, V.SPOTIFY_ARTIST, abort_early=True) == [("id", "required")]
    assert errors(spark, body, {"a": V.field(V.STRING)}, strict=False) == []
    assert errors(spark, body, {"a": V.field(V.STRING)}, additional_properties=True) == []


def test_type_unions(spark):
    both = {"v": V.field(V.NUMBER, V.STRING)}
    # the second type matches, yet the error of the first stays noted
    assert errors(spark, '{"v":"x"}', both) == [("v", "type")]
    assert errors(spark, '{"v":1}', both) == []
    nested = {"o": V.field(V.OBJECT, properties=both)}
    assert errors(spark, '{"o":{"v":"x"}}', nested) == [("o.v", "type")]
    track = {"preview_url": V.SPOTIFY_TRACK["preview_url"]}
    assert errors(spark, '{"preview_url":null}', track) == []
    assert errors(spark, '{"preview_url":"zz z"}', track) == [("preview_url", "pattern"), ("preview_url", "type")]


def test_scalar_rules(spark):
    schema = {
        "s": V.field(V.STRING, min_length=2, max_length=3, pattern="^a"),
        "n": V.field(V.NUMBER, nullable=False),
        "e": V.field(V.ENUM, enum=("x", "y")),
        "d": V.field(V.DATE),
        "u": V.field(V.UUID),
        "m": V.field(V.EMAIL),
        "g": V.field(V.GENIUS_ID),
        "l": V.field(V.ARRAY, min_length=1, max_length=2, items=V.field(V.BOOLEAN)),
        "o": V.field(V.OBJECT),
        "any": V.field(V.ANY),
    }
    good = '{"s":"ab","n":1.5,"e":"x","d":"2020-01-01","u":"550e8400-e29b-41d4-a716-446655440000","m":"a@b.c","g":"7","l":[true],"o":{"q":1},"any":[]}'
    assert errors(spark, good, schema) == []
    bad = '{"s":"bcde","n":null,"e":"z","d":"x","u":"x","m":"x","g":1.5,"l":[],"o":[1]}'
    assert errors(spark, bad, schema) == [
        ("s", "maxLength"), ("s", "pattern"), ("s", "type"), ("n", "nullable"), ("e", "enum"), ("e", "type"),
        ("d", "type"), ("d", "type"), ("u", "pattern"), ("u", "type"), ("m", "pattern"), ("m", "type"),
        ("g", "pattern"), ("g", "type"), ("l", "minLength"), ("l", "type"), ("o", "type"),
    ]


def test_report(spark):
    df = spark.createDataFrame([(1, "{}"), (2, '{"id":"%s","name":"x"}' % SID)], "k int, b string")
    rows = V.error_report(V.with_validation(df, "b", V.SPOTIFY_ARTIST), "SpotifyArtist", "k").collect()
    assert [(r.k, r.schema_name, r.path, r.message) for r in rows] == [
        (1, "SpotifyArtist", "id", "Required field 'id' is missing"),
        (1, "SpotifyArtist", "name", "Required field 'name' is missing"),
    ]


L22 = "0123456789012345678901"


@pytest.mark.parametrize(
    "stage, body, want",
    [
        ("artist_discovery", '{"artistName":"x","unknown":1}', []),
        ("artist_discovery", '{"artistName":5}', ["artistName: Expected string, received number"]),
        ("artist_discovery", '{"artistName":"x","genres":[1]}', ["genres: Expected string items"]),
        ("artist_discovery", '{"artistName":"x","popularity":-1}', ["popularity: Number must be greater than or equal to 0"]),
        ("album_discovery", '{"spotifyId":"%s","artistSpotifyId":"%s","albumType":"single"}' % (L22, L22), []),
        ("album_discovery", '{"spotifyId":"x"}', ["spotifyId: String must contain exactly 22 character(s)", "artistSpotifyId: Required"]),
        ("track_discovery", "{}", []),
        ("producer_identification", '{"trackName":"x","confidence":2}', ["confidence: Number must be less than or equal to 1"]),
        ("social_enrichment", '{"artistSpotifyId":"%s","socialPlatform":"myspace","socialHandle":"h"}' % L22,
         ["socialPlatform: Invalid enum value. Expected 'twitter' | 'instagram' | 'facebook' | 'youtube', received 'myspace'"]),
        ("social_enrichment", "[]", ["body: Expected object"]),
    ],
)
def test_contracts(spark, stage, body, want):
    df = spark.createDataFrame([(body,)], "b string")
    assert df.select(V.validate_message_zod(F.col("b"), stage)).first()[0] == want


@pytest.mark.parametrize(
    "queue, body, valid",
    [
        ("album_discovery", '{"artistId":""}', False),
        ("album_discovery", '{"artistId":"x"}', True),
        ("track_discovery", '{"albumId":""}', True),
        ("track_discovery", '{"albumId":null}', False),
        ("producer_identification", '{"track_id":"3"}', True),
        ("producer_identification", '{"trackId":""}', False),
        ("other", "{}", False),
        ("other", None, False),
        ("other", '{"a":null}', True),
    ],
)
def test_required_fields(spark, queue, body, valid):
    df = spark.createDataFrame([(queue, body)], "q string, b string")
    got = df.select(V.validate_queue_message(F.col("q"), F.col("b")).alias("v")).first().v
    assert got.valid is valid and (got.error is None) is valid
