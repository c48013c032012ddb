"""Name, date, key and credit-extraction expressions. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Whitespace as the source data's normalizer understands it
# (ASCII whitespace plus the Unicode spaces), written as a Java character-class body.
UNICODE_SPACE = r"\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
SPACE = r"\s" + UNICODE_SPACE

UNKNOWN_PRODUCER = "unknown_producer"

# Free-text credit patterns, in order of precedence.
CREDIT_PATTERNS = (
    r"[Pp]roduced by ([^<.,]+)",
    r"[Pp]roducer(?:s)?:? ([^<.,]+)",
    r"[Bb]eat(?:s)? by ([^<.,]+)",
)
# Credit length bounds, confidences and source labels.
MAX_CREDIT_CHARS = 50
MAX_CREDIT_WORDS = 6
CONF_STRUCTURED, SRC_STRUCTURED = 0.95, "genius_producer_artists"
CONF_PERFORMANCE, SRC_PERFORMANCE = 0.9, "genius_custom_performances"
CONF_TEXT, SRC_TEXT = 0.7, "genius_description"

CREDIT_TYPE = "array<struct<name:string,confidence:double,source:string>>"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{SPACE}]+|[{SPACE}]+$", "")


def _bare(c: Column) -> Column:
    """Lower case with only ASCII word characters and whitespace left.

    The class is nested so that the common characters are decided first.
    """
    return F.regexp_replace(F.lower(c), r"[^\w[\s[" + UNICODE_SPACE + "]]]+", "")


def _or_unknown(raw: Column, done: Column) -> Column:
    filled = raw.rlike(f"[^{SPACE}]")
    return F.coalesce(F.when(filled, F.nullif(done, F.lit(""))), F.lit(UNKNOWN_PRODUCER))


def normalize_producer_name(c: Column) -> Column:
    """Key of a producer: lower case, word characters only, whitespace runs become ``_``.

    Outer whitespace becomes ``_`` as well.
    """
    return _or_unknown(c, F.regexp_replace(_bare(c), r"\W+", "_"))


def normalize_producer_name_spaces(c: Column) -> Column:
    """As above, but whitespace runs become one space and the ends are trimmed."""
    return _or_unknown(c, F.trim(F.regexp_replace(_bare(c), r"\W+", " ")))


#: All of ASCII but letters and digits.
ASCII_MARKS = "".join(c for c in map(chr, range(128)) if not c.isalnum())


def normalize_track_name(c: Column, unicode: bool = False) -> Column:
    """Key of a song: letters and digits only, lower case.

    ``unicode`` keeps non-ASCII letters, which the default drops. There a table of characters takes out those of ASCII,
    and the slower pattern is left to names that have others (as many bytes as characters: none).
    """
    if unicode:
        return F.lower(F.regexp_replace(c, r"[^\p{L}\p{Nd}]", ""))
    plain = F.translate(c, ASCII_MARKS, "")
    return F.lower(F.when(F.octet_length(plain) == F.char_length(plain), plain).otherwise(F.regexp_replace(plain, "[^a-zA-Z0-9]", "")))


def format_release_date(c: Column) -> Column:
    """``YYYY``, ``YYYY-MM`` and ``YYYY-MM-DD`` text to a date; anything else is null."""
    full = (
        F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}\z"), c)
        .when(c.rlike(r"^\d{4}-\d{2}\z"), F.concat(c, F.lit("-01")))
        .when(c.rlike(r"^\d{4}\z"), F.concat(c, F.lit("-01-01")))
    )
    return full.try_cast("date")


def sanitize_dedup_key(key: Column, namespace: Column | str) -> Column:
    ns = F.lit(namespace) if isinstance(namespace, str) else namespace
    return F.concat(F.lit("dedup:"), ns, F.lit(":"), F.regexp_replace(key, "[^a-zA-Z0-9_:-]", "-"))


def dedup_key_for(kind: str, *parts: Column) -> Column:
    """The repeat-detection key of one message kind."""
    text = [p.cast("string") for p in parts]
    if kind == "artist_albums":
        return F.concat(F.lit("album_discovery:artist:"), text[0], F.lit(":offset:"), text[1])
    if kind == "album":
        return F.concat(F.lit("album_discovery:album:"), text[0])
    if kind == "album_tracks":
        return F.concat(F.lit("track_discovery:album:"), text[0], F.lit(":offset:"), text[1])
    if kind == "album_tracks_next":
        return F.concat(F.lit("album:"), text[0], F.lit(":offset:"), text[1])
    if kind == "track":
        return F.concat(F.lit("track:"), text[0])
    if kind in ("producer", "enrichment"):
        return F.concat(F.lit("producer:"), text[0])
    if kind == "artist_name":
        return F.concat(F.lit("artist:name:"), F.lower(text[0]))
    if kind == "seed_artist_albums":
        return F.concat(F.lit("artist:"), text[0], F.lit(":albums:offset:"), text[1])
    raise ValueError(f"unknown key kind {kind}")


def truncate_text(c: Column, n: int = 200) -> Column:
    return F.substring(c, 1, n)


def social_links(name: Column) -> Column:
    """Four profile addresses derived from the bare name."""
    bare = F.regexp_replace(F.lower(name), "[^a-z0-9]", "")
    return F.struct(
        F.concat(F.lit("https://twitter.com/"), bare).alias("twitter"),
        F.concat(F.lit("https://instagram.com/"), bare).alias("instagram"),
        F.concat(F.lit("https://open.spotify.com/artist/"), bare).alias("spotify"),
        F.concat(F.lit("https://"), bare, F.lit(".com")).alias("website"),
    )


def _credit(name: Column, confidence: float, source: str) -> Column:
    return F.struct(
        name.alias("name"), F.lit(confidence).alias("confidence"), F.lit(source).alias("source")
    )


def _none() -> Column:
    return F.array().cast(CREDIT_TYPE)


def extract_producers_structured(song: Column) -> Column:
    """Credits from the explicit producer list, then from production-like performance roles."""
    listed = F.transform(
        F.filter(song["producer_artists"], lambda p: p["name"].isNotNull() & (p["name"] != "")),
        lambda p: _credit(p["name"], CONF_STRUCTURED, SRC_STRUCTURED),
    )
    roles = F.filter(
        song["custom_performances"],
        lambda r: F.lower(r["label"]).contains("produc") | F.lower(r["label"]).contains("beat"),
    )
    performed = F.flatten(
        F.transform(
            roles,
            lambda r: F.transform(
                F.coalesce(r["artists"], F.array().cast("array<struct<id:bigint,name:string>>")),
                lambda a: _credit(a["name"], CONF_PERFORMANCE, SRC_PERFORMANCE),
            ),
        )
    )
    return F.concat(F.coalesce(listed, _none()), F.coalesce(performed, _none()))


def credit_names(text: Column, patterns=CREDIT_PATTERNS) -> Column:
    """All short-enough captures of the patterns over the whole text, pattern by pattern."""
    found = F.concat(
        *[
            F.coalesce(F.regexp_extract_all(text, F.lit(p), F.lit(1)), F.array().cast("array<string>"))
            for p in patterns
        ]
    )
    return F.filter(
        F.transform(found, strip),
        lambda n: (F.length(n) < MAX_CREDIT_CHARS)
        & (F.size(F.split(n, " ", -1)) < MAX_CREDIT_WORDS),
    )


def extract_producers_text(text: Column, patterns=CREDIT_PATTERNS) -> Column:
    return F.transform(credit_names(text, patterns), lambda n: _credit(n, CONF_TEXT, SRC_TEXT))


def extract_producers(song: Column) -> Column:
    """Every credit of a song in order of precedence; nameless ones are dropped."""
    found = F.concat(
        extract_producers_structured(song), extract_producers_text(song["description"]["html"])
    )
    return F.filter(found, lambda c: c["name"].isNotNull() & (c["name"] != ""))
