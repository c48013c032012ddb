"""Declarative checks of JSON text, compiled to one column of errors.

A schema is a dict of field name to ``field(...)``. The result is an array of
(path, value, rule, message) built by Spark expressions alone; nothing is
parsed row by row in Python.
"""

from __future__ import annotations

from dataclasses import dataclass, field as dc_field

from pyspark.sql import Column, DataFrame, functions as F

from cratedig.functions import formats
from cratedig.functions.bind import let
from cratedig.functions.bodies import json_has_key

ERROR = "struct<path:string,value:string,rule:string,message:string>"
ERRORS = f"array<{ERROR}>"

# Type names.
STRING, NUMBER, BOOLEAN, OBJECT, ARRAY = "string", "number", "boolean", "object", "array"
NULL, ANY, DATE, UUID, EMAIL, URL = "null", "any", "date", "uuid", "email", "url"
ENUM, SPOTIFY_ID, GENIUS_ID = "enum", "spotify_id", "genius_id"


@dataclass(frozen=True)
class Field:
    types: tuple[str, ...]
    required: bool = False
    nullable: bool = True
    min_length: int | None = None
    max_length: int | None = None
    min_value: float | None = None
    max_value: float | None = None
    pattern: str | None = None
    enum: tuple = ()
    properties: dict = dc_field(default_factory=dict)
    items: Field | None = None


def field(*types: str, **rules) -> Field:
    return Field(tuple(types), **rules)


@dataclass(frozen=True)
class Options:
    strict: bool = True
    abort_early: bool = False
    additional_properties: bool = False


# While checking, an error also says whether it is only noted: a value that
# matches its second type keeps the errors of the first, but passes.
NOTED = "array<struct<path:string,value:string,rule:string,message:string,noted:boolean>>"


def _none() -> Column:
    return F.array().cast(NOTED)


def _error(path: Column, value: Column, rule: str, message: Column) -> Column:
    return F.struct(
        path.alias("path"),
        value.alias("value"),
        F.lit(rule).alias("rule"),
        message.alias("message"),
        F.lit(False).alias("noted"),
    )


def _silent() -> Column:
    """A failure that leaves its report to the field's closing error."""
    none = F.lit(None).cast("string")
    return F.array(F.struct(
        none.alias("path"), none.alias("value"), none.alias("rule"), none.alias("message"), F.lit(False).alias("noted")
    ))


def _ok(errors: Column) -> Column:
    return ~F.exists(errors, lambda e: ~e["noted"])


def _kind(v: Column) -> Column:
    """string, number, boolean, object, array, null, or undefined for a missing value."""
    return let(
        F.schema_of_variant(v),
        lambda t: F.when(t.isNull(), "undefined")
        .when(t == "STRING", STRING)
        .when(t.startswith("ARRAY"), ARRAY)
        .when(t.startswith("OBJECT"), OBJECT)
        .when(t == "BOOLEAN", BOOLEAN)
        .when(t == "VOID", NULL)
        .otherwise(NUMBER),
    )


def _js(kind: Column) -> Column:
    """How a kind is called in messages, where arrays and nulls are objects."""
    return F.when(kind.isin(ARRAY, NULL), OBJECT).otherwise(kind)


def _plain(x: float) -> str:
    return str(int(x)) if float(x).is_integer() else str(x)


def _named(path: Column, tail: str | Column, lead: str = "Field") -> Column:
    tail = F.lit(tail) if isinstance(tail, str) else tail
    return F.concat(F.lit(f"{lead} '"), path, F.lit("' "), tail)


class _Value:
    """A value under check. Its kind is found once; its text is only made where it is read."""

    def __init__(self, row: Column):
        self.v, self.kind = row["v"], row["kind"]

    @property
    def text(self) -> Column:
        return F.try_variant_get(self.v, "$", "string")

    @staticmethod
    def of(v: Column, use) -> Column:
        return let(v, lambda x: let(F.struct(x.alias("v"), _kind(x).alias("kind")), lambda row: use(_Value(row))))


class _Compiler:
    """Every method gives one expression: the array of errors of a value."""

    def __init__(self, options: Options):
        self.o = options

    def join(self, steps: list[Column]) -> Column:
        """All errors in order; when aborting early, up to the first step that fails."""
        if self.o.abort_early:
            return F.aggregate(F.array(*steps), _none(), self._until_bad)
        return F.concat(*steps)

    @staticmethod
    def _until_bad(acc: Column, errors: Column) -> Column:
        return F.when(_ok(acc), F.concat(acc, errors)).otherwise(acc)

    def object(self, x: _Value, schema: dict, path: Column | None) -> Column:
        here = F.lit("root") if path is None else path
        got = F.when(x.kind == ARRAY, ARRAY).otherwise(_js(x.kind))
        wrong = _error(here, x.text, "type", F.concat(F.lit("Expected object but got "), got))
        steps = [self._member(x, name, f, path) for name, f in schema.items()]
        if self.o.strict and not self.o.additional_properties:
            steps.append(self._additional(x, schema, path))
        return F.when(x.kind == OBJECT, self.join(steps)).otherwise(F.array(wrong))

    def _member(self, x: _Value, name: str, f: Field, path: Column | None) -> Column:
        at = F.lit(name) if path is None else F.concat(path, F.lit(f".{name}"))
        value = F.try_variant_get(x.v, f"$['{name}']", "variant")
        missing = _none()
        if f.required:
            message = F.concat(F.lit("Required field '"), at, F.lit("' is missing"))
            missing = F.array(_error(at, F.lit(None).cast("string"), "required", message))
        return let(value, lambda v: F.when(v.isNull(), missing).otherwise(_Value.of(v, lambda y: self.field(y, f, at))))

    def _additional(self, x: _Value, schema: dict, path: Column | None) -> Column:
        prefix = F.lit("") if path is None else F.concat(path, F.lit("."))
        known = F.array(*[F.lit(k) for k in schema])
        members = F.try_variant_get(x.v, "$", "map<string,variant>")

        def one(members: Column, key: Column) -> Column:
            at = F.concat(prefix, key)
            message = F.concat(F.lit("Additional property '"), at, F.lit("' not allowed"))
            return _error(at, F.try_variant_get(members[key], "$", "string"), "additionalProperty", message)

        def found(m: Column) -> Column:
            extra = F.array_except(F.map_keys(m), known)
            if self.o.abort_early:
                extra = F.slice(extra, 1, 1)
            return F.transform(extra, lambda k: one(m, k))

        return let(members, found)

    def field(self, x: _Value, f: Field, path: Column) -> Column:
        none = F.lit(None).cast("string")
        on_null = _none() if f.nullable else F.array(_error(path, none, "nullable", _named(path, "cannot be null")))
        tail = F.concat(F.lit(f"expected to be {' or '.join(f.types)} but got "), _js(x.kind))
        rest = F.array(_error(path, x.text, "type", _named(path, tail)))
        for kind in reversed(f.types):
            rest = self._or_else(self.type(x, kind, f, path), rest)
        return F.when(x.kind == NULL, on_null).otherwise(rest)

    @staticmethod
    def _or_else(tried: Column, rest: Column) -> Column:
        """The first type that fits decides; when it is not the first, earlier errors are only noted."""

        def note(errors: Column) -> Column:
            return F.transform(errors, lambda e: e.withField("noted", F.lit(True)))

        def next_type(t: Column) -> Column:
            after = let(rest, lambda r: F.when(_ok(r), F.concat(note(t), r)).otherwise(F.concat(t, r)))
            return F.when(_ok(t), t).otherwise(after)

        return let(tried, next_type)

    def type(self, x: _Value, kind: str, f: Field, path: Column) -> Column:
        if kind == ANY:
            return _none()
        if kind == NULL or (kind == OBJECT and not f.properties):
            return F.when(x.kind == kind, _none()).otherwise(_silent())
        if kind == OBJECT:
            return self.object(x, f.properties, path)
        if kind == ARRAY:
            return self._array(x, f, path)
        if kind == ENUM:
            if not f.enum:
                return F.array(_error(path, x.text, "enum", _named(path, "has invalid enum definition")))
            allowed = ", ".join(str(e) for e in f.enum)
            bad = F.array(_error(path, x.text, "enum", _named(path, f"must be one of [{allowed}]")))
            return F.when(formats.in_enum(x.text, [str(e) for e in f.enum]), _none()).otherwise(bad)
        if kind == DATE:
            tail = F.when(x.kind == STRING, F.lit("expected to be a valid date string")).otherwise(
                F.concat(F.lit("expected to be a Date object or date string but got "), _js(x.kind))
            )
            bad = F.array(_error(path, x.text, "type", _named(path, tail)))
            return F.when((x.kind == STRING) & formats.is_date(x.text), _none()).otherwise(bad)
        if kind == GENIUS_ID:
            numeric = (x.kind == NUMBER) | ((x.kind == STRING) & x.text.try_cast("double").isNotNull())
            odd = F.array(_error(path, x.text, "pattern", _named(path, "must be a positive integer")))
            tail = F.concat(F.lit("expected to be a number but got "), _js(x.kind))
            bad = F.array(_error(path, x.text, "type", _named(path, tail)))
            return F.when(~numeric, bad).when(formats.is_genius_id(x.text), _none()).otherwise(odd)
        return self._rules(x, path, *self._checks(x, kind, f))

    @staticmethod
    def _checks(x: _Value, kind: str, f: Field):
        """(wanted kind, [(failed, rule, message tail)]) of a scalar type."""
        if kind == NUMBER:
            n = F.try_variant_get(x.v, "$", "double")
            found = []
            if f.min_value is not None:
                found.append((n < f.min_value, "minValue", f"must be at least {_plain(f.min_value)}"))
            if f.max_value is not None:
                found.append((n > f.max_value, "maxValue", f"must not exceed {_plain(f.max_value)}"))
            return NUMBER, found
        if kind == BOOLEAN:
            return BOOLEAN, []
        if kind == STRING:
            size, found = F.length(x.text), []
            if f.min_length is not None:
                found.append((size < f.min_length, "minLength", f"length must be at least {f.min_length} characters"))
            if f.max_length is not None:
                found.append((size > f.max_length, "maxLength", f"length must not exceed {f.max_length} characters"))
            if f.pattern is not None:
                found.append((~x.text.rlike(f.pattern), "pattern", f"must match pattern /{f.pattern}/"))
            return STRING, found
        # Text formats and how they are named in messages.
        named = {
            UUID: (formats.is_uuid, "must be a valid UUID"),
            EMAIL: (formats.is_email, "must be a valid email address"),
            URL: (formats.is_url, "must be a valid URL"),
            SPOTIFY_ID: (formats.is_spotify_id, "must be a valid Spotify ID"),
        }
        test, tail = named[kind]
        return STRING, [(~test(x.text), "pattern", tail)]

    @staticmethod
    def _rules(x: _Value, path: Column, wanted: str, checks, lead: str = "Field") -> Column:
        tail = F.concat(F.lit(f"expected to be {wanted} but got "), _js(x.kind))
        wrong = F.array(_error(path, x.text, "type", _named(path, tail)))
        inner = _none()
        if checks:
            notes = [
                F.when(failed, _error(path, x.text, rule, _named(path, text, lead))) for failed, rule, text in checks
            ]
            inner = F.array_compact(F.array(*notes))
        return F.when(x.kind == wanted, inner).otherwise(wrong)

    def _array(self, x: _Value, f: Field, path: Column) -> Column:
        items = F.try_variant_get(x.v, "$", "array<variant>")
        size, sizes = F.size(items), []
        if f.min_length is not None:
            sizes.append((size < f.min_length, "minLength", f"length must be at least {f.min_length} items"))
        if f.max_length is not None:
            sizes.append((size > f.max_length, "maxLength", f"length must not exceed {f.max_length} items"))
        sized = self._rules(x, path, ARRAY, sizes, "Array")
        if f.items is None:
            return sized

        def each(v: Column, i: Column) -> Column:
            at = F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
            return _Value.of(v, lambda y: self.field(y, f.items, at))

        checked = F.transform(items, each)
        if self.o.abort_early:
            errors = F.aggregate(checked, _none(), self._until_bad)
        else:
            errors = F.flatten(checked)
        return let(sized, lambda r: F.when(F.size(r) == 0, errors).otherwise(r))


def validate_schema(body: Column, schema: dict, options: Options = Options()) -> Column:
    """Errors of a JSON text against a schema; an empty array means valid."""
    errors = _Value.of(F.try_parse_json(body), lambda x: _Compiler(options).object(x, schema, None))
    return F.transform(F.filter(errors, lambda e: e["rule"].isNotNull()), lambda e: e.dropFields("noted"))


def with_validation(df: DataFrame, body: str, schema: dict, options: Options = Options()) -> DataFrame:
    return df.withColumn("errors", validate_schema(F.col(body), schema, options)).withColumn(
        "valid", F.size("errors") == 0
    )


def error_report(df: DataFrame, schema_name: str, *keep: str) -> DataFrame:
    """One row per error of the invalid rows."""
    rows = df.select(*keep, F.explode_outer("errors").alias("e")).filter(F.col("e").isNotNull())
    return rows.select(*keep, F.lit(schema_name).alias("schema_name"), "e.*")


# Payload and message schemas.
_IMAGES = field(
    ARRAY,
    items=field(OBJECT, properties={"url": field(URL, required=True), "height": field(NUMBER), "width": field(NUMBER)}),
)
_NAMED_SPOTIFY = {"id": field(SPOTIFY_ID, required=True), "name": field(STRING, required=True)}
_NAMED_GENIUS = {"id": field(GENIUS_ID, required=True), "name": field(STRING, required=True)}

SPOTIFY_ARTIST = {
    "id": field(SPOTIFY_ID, required=True),
    "name": field(STRING, required=True),
    "followers": field(OBJECT, properties={"total": field(NUMBER)}),
    "genres": field(ARRAY, items=field(STRING)),
    "images": _IMAGES,
    "popularity": field(NUMBER, min_value=0, max_value=100),
}
SPOTIFY_ALBUM = {
    "id": field(SPOTIFY_ID, required=True),
    "name": field(STRING, required=True),
    "artists": field(ARRAY, items=field(OBJECT, properties=_NAMED_SPOTIFY), required=True),
    "release_date": field(STRING, required=True),
    "release_date_precision": field(STRING),
    "total_tracks": field(NUMBER),
    "images": _IMAGES,
}
SPOTIFY_TRACK = {
    "id": field(SPOTIFY_ID, required=True),
    "name": field(STRING, required=True),
    "artists": field(ARRAY, items=field(OBJECT, properties=_NAMED_SPOTIFY), required=True),
    "album": field(OBJECT, properties=_NAMED_SPOTIFY),
    "duration_ms": field(NUMBER, min_value=0),
    "explicit": field(BOOLEAN),
    "popularity": field(NUMBER, min_value=0, max_value=100),
    "preview_url": field(URL, NULL),
}
GENIUS_SONG = {
    "id": field(GENIUS_ID, required=True),
    "title": field(STRING, required=True),
    "primary_artist": field(OBJECT, properties=_NAMED_GENIUS, required=True),
    "producer_artists": field(ARRAY, items=field(OBJECT, properties=_NAMED_GENIUS)),
}
MESSAGE_SCHEMAS = {
    "artist_discovery": {
        "artistId": field(SPOTIFY_ID),
        "artistName": field(STRING),
        "_idempotencyKey": field(STRING),
        "spotifyId": field(SPOTIFY_ID),
    },
    "album_discovery": {"albumId": field(SPOTIFY_ID), "artistId": field(SPOTIFY_ID)},
    "track_discovery": {"trackId": field(SPOTIFY_ID), "albumId": field(SPOTIFY_ID)},
    "producer_identification": {
        "trackId": field(UUID, required=True),
        "trackName": field(STRING, required=True),
        "artistName": field(STRING, required=True),
    },
    "social_enrichment": {"producerId": field(UUID, required=True), "producerName": field(STRING, required=True)},
}


def validate_spotify_artist(body: Column) -> Column:
    return validate_schema(body, SPOTIFY_ARTIST)


def validate_spotify_album(body: Column) -> Column:
    return validate_schema(body, SPOTIFY_ALBUM)


def validate_spotify_track(body: Column) -> Column:
    return validate_schema(body, SPOTIFY_TRACK)


def validate_genius_song(body: Column) -> Column:
    return validate_schema(body, GENIUS_SONG)


def validate_stage_message(body: Column, stage: str) -> Column:
    return validate_schema(body, MESSAGE_SCHEMAS[stage])


# --- per-queue required field ---------------------------------------------

# The field each queue needs, its accepted spellings, whether
# empty text is refused, and the error text.
REQUIRED_FIELDS = {
    "album_discovery": (
        ["artistId"], True, "Invalid album discovery message: missing or empty artistId"),
    "producer_identification": (
        ["trackId", "track_id"], True, "Invalid producer identification message: missing or empty trackId"),
    "track_discovery": (
        ["albumId"], False, "Invalid track discovery message: missing or empty albumId"),
}


def validate_queue_message(queue: Column, body: Column) -> Column:
    """(valid, error, queue) of a message by the rule of its queue."""
    empty = body.isNull() | (F.get_json_object(body, "$").isNull()) | F.coalesce(
        F.size(F.json_object_keys(body)) == 0, F.lit(False)
    )
    valid, error = ~empty, F.lit("Empty or null message")
    for name, (spellings, nonempty, text) in REQUIRED_FIELDS.items():
        has = F.lit(False)
        for key in spellings:
            got = F.get_json_object(body, f"$.{key}")
            one = json_has_key(body, key) & got.isNotNull()
            has = has | (one & (got != "") if nonempty else one)
        valid = F.when(queue == name, F.coalesce(has, F.lit(False))).otherwise(valid)
        error = F.when(queue == name, F.lit(text)).otherwise(error)
    valid = F.coalesce(valid, F.lit(False))
    return F.struct(
        valid.alias("valid"), F.when(~valid, error).alias("error"), F.when(~valid, queue).alias("queue")
    )


# --- typed message contracts ----------------------------------------------

# Contract fields as (name, type, required, rule).
_BASE = [("id", STRING, False, None), ("createdAt", STRING, False, None), ("retries", NUMBER, False, None)]
_LEN22 = ("length", 22)
CONTRACTS = {
    "artist_discovery": _BASE + [
        ("spotifyId", STRING, False, _LEN22),
        ("artistName", STRING, True, None),
        ("genres", ARRAY, False, ("items", STRING)),
        ("popularity", NUMBER, False, ("range", (0, 100))),
    ],
    "album_discovery": _BASE + [
        ("spotifyId", STRING, True, _LEN22),
        ("artistSpotifyId", STRING, True, _LEN22),
        ("albumName", STRING, False, None),
        ("releaseDate", STRING, False, None),
        ("albumType", ENUM, False, ("enum", ("album", "single", "compilation"))),
        ("artistId", STRING, False, ("uuid", None)),
        ("artist_id", STRING, False, ("uuid", None)),
    ],
    "track_discovery": _BASE + [
        ("spotifyId", STRING, False, _LEN22),
        ("albumSpotifyId", STRING, False, _LEN22),
        ("artistSpotifyId", STRING, False, _LEN22),
        ("trackName", STRING, False, None),
        ("durationMs", NUMBER, False, None),
        ("trackNumber", NUMBER, False, None),
        ("discNumber", NUMBER, False, None),
        ("albumId", STRING, False, None),
        ("artistId", STRING, False, None),
        ("albumName", STRING, False, None),
        ("offset", NUMBER, False, None),
    ],
    "producer_identification": _BASE + [
        ("trackSpotifyId", STRING, False, _LEN22),
        ("trackId", STRING, False, None),
        ("trackName", STRING, True, None),
        ("producerName", STRING, False, None),
        ("producerRole", STRING, False, None),
        ("confidence", NUMBER, False, ("range", (0, 1))),
        ("artistId", STRING, False, None),
        ("albumId", STRING, False, None),
    ],
    "social_enrichment": _BASE + [
        ("artistSpotifyId", STRING, True, _LEN22),
        ("socialPlatform", ENUM, True, ("enum", ("twitter", "instagram", "facebook", "youtube"))),
        ("socialHandle", STRING, True, None),
        ("verified", BOOLEAN, False, None),
    ],
}
# The UUID form the contracts accept (any version).
CONTRACT_UUID = r"(?i)^[0-9a-f]{8}\b-[0-9a-f]{4}\b-[0-9a-f]{4}\b-[0-9a-f]{4}\b-[0-9a-f]{12}\z"


def _contract_field(v: Column, name: str, kind: str, required: bool, rule) -> Column:
    """Error texts of one field (``field: text``), nulls where a check passes."""

    def notes(x: _Value) -> Column:
        base = STRING if kind == ENUM else kind
        fits = x.kind == base

        def note(test: Column, message: str | Column) -> Column:
            message = F.lit(message) if isinstance(message, str) else message
            return F.when(test, F.concat(F.lit(f"{name}: "), message))

        there = x.kind != "undefined"
        expected = "'" + "' | '".join(rule[1]) + "'" if kind == ENUM else kind
        found = [note(there & ~fits, F.concat(F.lit(f"Expected {expected}, received "), x.kind))]
        if required:
            found.append(note(~there, "Required"))
        if rule and rule[0] == "length":
            found.append(note(fits & (F.length(x.text) != rule[1]), f"String must contain exactly {rule[1]} character(s)"))
        if rule and rule[0] == "range":
            low, high = rule[1]
            n = F.try_variant_get(x.v, "$", "double")
            found.append(note(fits & (n < low), f"Number must be greater than or equal to {low}"))
            found.append(note(fits & (n > high), f"Number must be less than or equal to {high}"))
        if rule and rule[0] == "enum":
            got = F.concat(F.lit(f"Invalid enum value. Expected {expected}, received '"), x.text, F.lit("'"))
            found.append(note(fits & ~x.text.isin(list(rule[1])), got))
        if rule and rule[0] == "uuid":
            found.append(note(fits & ~x.text.rlike(CONTRACT_UUID), "Invalid uuid"))
        if rule and rule[0] == "items":
            items = F.try_variant_get(x.v, "$", "array<variant>")
            wrong = F.exists(F.coalesce(items, F.array().cast("array<variant>")), lambda i: _kind(i) != rule[1])
            found.append(note(fits & wrong, f"Expected {rule[1]} items"))
        return F.array(*found)

    return _Value.of(F.try_variant_get(v, f"$['{name}']", "variant"), notes)


def validate_message_zod(body: Column, stage: str) -> Column:
    """Contract errors of a stage's message; unknown keys are ignored."""

    def check(x: _Value) -> Column:
        fields = F.concat(*[_contract_field(x.v, *spec) for spec in CONTRACTS[stage]])
        return F.when(x.kind == OBJECT, F.array_compact(fields)).otherwise(F.array(F.lit("body: Expected object")))

    return _Value.of(F.try_parse_json(body), check)
