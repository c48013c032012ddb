"""Error categories, retry policies and dead-letter records as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Retry policy per error category.
# (category, max_retries, base_delay_ms, max_delay_ms, jitter_factor, timeout_ms)
RETRY_POLICIES = [
    ("TRANSIENT_NETWORK", 5, 200, 10000, 0.3, 5000),
    ("TRANSIENT_TIMEOUT", 3, 500, 5000, 0.2, 8000),
    ("TRANSIENT_RATE_LIMIT", 7, 1000, 60000, 0.1, 3000),
    ("TRANSIENT_SERVICE", 5, 2000, 30000, 0.2, 5000),
    ("PERMANENT_AUTH", 0, 0, 0, 0.0, 3000),
    ("PERMANENT_VALIDATION", 0, 0, 0, 0.0, 3000),
    ("PERMANENT_NOT_FOUND", 0, 0, 0, 0.0, 3000),
    ("PERMANENT_BAD_REQUEST", 0, 0, 0, 0.0, 3000),
    ("PERMANENT_FORBIDDEN", 0, 0, 0, 0.0, 3000),
    ("UNKNOWN", 2, 500, 5000, 0.3, 5000),
    ("SYSTEM", 1, 1000, 3000, 0.1, 10000),
]
RETRIABLE = [
    "TRANSIENT_NETWORK",
    "TRANSIENT_TIMEOUT",
    "TRANSIENT_RATE_LIMIT",
    "TRANSIENT_SERVICE",
    "UNKNOWN",
]

# Patterns per error source, as (status, message fragments, codes).
SOURCE_PATTERNS = {
    "SPOTIFY_API": {
        "rate": [(429, ["rate limit", "too many requests"], None), (None, ["api rate limit", "exceeded"], None)],
        "auth": [(401, ["unauthorized", "invalid token"], None), (403, ["forbidden"], None)],
        "timeout": [(None, ["timeout", "timed out", "etimedout", "econnaborted"], None)],
        "network": [(None, ["network error", "econnrefused", "econnreset", "enotfound"], None)],
        "service": [(500, [], None), (502, [], None), (503, [], None), (504, [], None)],
    },
    "GENIUS_API": {
        "rate": [(429, ["rate limit", "too many requests"], None)],
        "auth": [(401, ["unauthorized", "invalid token", "auth"], None), (403, ["forbidden"], None)],
        "not_found": [(404, ["not found"], None)],
    },
    "DATABASE": {
        "timeout": [(None, ["timeout", "statement_timeout"], ["57014", "57P04"])],
    },
    "REDIS": {
        "timeout": [(None, ["timeout", "ETIMEDOUT"], None)],
    },
}
# How a source is recognised when none is given, in order: (source, message, name).
SOURCE_HINTS = [
    ("SPOTIFY_API", ["spotify"], "SpotifyAPI"),
    ("GENIUS_API", ["genius"], "GeniusAPI"),
    ("DATABASE", ["database", "sql", "pg"], "Database"),
    ("REDIS", ["redis"], "Redis"),
    ("QUEUE", ["queue"], "Queue"),
]
# Rules within a known source, in order:
# (category, pattern kind, message fragments, name fragments, status codes, status range)
SOURCE_RULES = [
    ("TRANSIENT_RATE_LIMIT", "rate", ["rate limit", "too many requests"], [], [429], None),
    ("PERMANENT_AUTH", "auth", ["unauthorized", "authentication", "not authenticated"], [], [401, 403], None),
    ("TRANSIENT_TIMEOUT", "timeout", ["timeout"], ["TimeoutError"], [], None),
    ("TRANSIENT_NETWORK", "network", ["network", "ECONNREFUSED", "ENOTFOUND"], ["NetworkError"], [], None),
    ("TRANSIENT_SERVICE", "service", ["service unavailable", "internal server error"], [], [], (500, 599)),
    ("PERMANENT_NOT_FOUND", "not_found", ["not found"], [], [404], None),
]
# Rules without a source, in order: (category, message, name, status codes)
GENERAL_RULES = [
    ("PERMANENT_VALIDATION", ["validation failed", "invalid", "malformed"], ["ValidationError"], []),
    ("PERMANENT_BAD_REQUEST", ["bad request"], [], [400]),
    ("SYSTEM", ["system error", "internal error"], ["SystemError"], []),
]
# Three-way classification used for retry decisions.
SIMPLE_RULES = [
    (
        "TRANSIENT",
        [
            "ECONNREFUSED", "ETIMEDOUT", "ENOTFOUND", "timeout", "rate limit",
            "too many requests", "service unavailable", "internal server error",
        ],
        ["TimeoutError", "NetworkError", "ConnectionError"],
    ),
    (
        "PERMANENT",
        ["validation failed", "not found", "invalid", "malformed", "forbidden", "unauthorized"],
        ["ValidationError", "NotFoundError"],
    ),
]
# Error texts that mark a message as failing its contract.
CONTRACT_FAILURES = ["Invalid message format", "Required", "required field"]


def any_of(*tests: Column) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _has(c: Column, fragments) -> Column:
    return any_of(*[F.coalesce(c.contains(x), F.lit(False)) for x in fragments])


def _pattern(pattern, text: Column, status: Column, code: Column) -> Column:
    want, fragments, codes = pattern
    ok = F.lit(True) if want is None else F.coalesce(status == want, F.lit(False))
    if codes:
        ok = ok & (code.isNull() | _has(code, codes))
    if fragments:
        return ok & _has(text, fragments)
    if want is not None:
        return ok
    return ok & (code.isNotNull() if codes else F.lit(False))


def detect_source(message: Column, name: Column) -> Column:
    found = F.lit(None).cast("string")
    for source, fragments, name_part in reversed(SOURCE_HINTS):
        found = F.when(_has(message, fragments) | _has(name, [name_part]), F.lit(source)).otherwise(found)
    return found


def classify_error(
    message: Column,
    name: Column | None = None,
    status: Column | None = None,
    code: Column | None = None,
    source: Column | None = None,
    category: Column | None = None,
) -> Column:
    """One of eleven categories; an already known category is kept."""
    message = F.coalesce(message, F.lit(""))
    name = F.coalesce(name, F.lit("")) if name is not None else F.lit("")
    status = status.cast("int") if status is not None else F.lit(None).cast("int")
    code = code if code is not None else F.lit(None).cast("string")
    detected = detect_source(message, name)
    source = detected if source is None else F.coalesce(source, detected)
    text = F.lower(F.concat_ws(" ", message, name))
    known = F.coalesce(source.isin(list(SOURCE_PATTERNS)), F.lit(False))

    rules: list[tuple[Column, str]] = []
    for cat, kind, fragments, names, codes, span in SOURCE_RULES:
        special = any_of(
            *[
                F.coalesce(source == s, F.lit(False)) & _pattern(p, text, status, code)
                for s, kinds in SOURCE_PATTERNS.items()
                for p in kinds.get(kind, [])
            ]
        )
        plain = _has(message, fragments) | _has(name, names)
        if codes:
            plain = plain | F.coalesce(status.isin(codes), F.lit(False))
        if span:
            plain = plain | F.coalesce(status.between(*span), F.lit(False))
        rules.append((known & (special | plain), cat))
    for cat, fragments, names, codes in GENERAL_RULES:
        plain = _has(message, fragments) | _has(name, names)
        if codes:
            plain = plain | F.coalesce(status.isin(codes), F.lit(False))
        rules.append((plain, cat))

    found = F.lit("UNKNOWN")
    for test, cat in reversed(rules):
        found = F.when(test, F.lit(cat)).otherwise(found)
    return found if category is None else F.coalesce(category, found)


def classify_error_simple(message: Column, name: Column | None = None) -> Column:
    """TRANSIENT, PERMANENT or UNKNOWN."""
    name = F.lit("") if name is None else name
    found = F.lit("UNKNOWN")
    for cat, fragments, names in reversed(SIMPLE_RULES):
        found = F.when(_has(message, fragments) | _has(name, names), F.lit(cat)).otherwise(found)
    return found


def is_retriable(category: Column) -> Column:
    return F.coalesce(category.isin(RETRIABLE), F.lit(False))


def is_validation_failure(error: Column) -> Column:
    return _has(error, CONTRACT_FAILURES)


def retry_policies(spark: SparkSession) -> DataFrame:
    """The eleven-row policy dimension."""
    return spark.createDataFrame(
        RETRY_POLICIES,
        "category string, max_retries int, base_delay_ms int, max_delay_ms int, "
        "jitter_factor double, timeout_ms int",
    )


def retry_policy_join(df: DataFrame, category: str = "category") -> DataFrame:
    """Adds the policy columns of each row's error category.

    The policy side has one row per category, eleven in all, so it is broadcast.
    """
    policies = retry_policies(df.sparkSession).withColumnRenamed("category", category)
    return df.join(F.broadcast(policies), category, "left")


def retry_delay_ms(attempt: Column, base_ms: Column, max_ms: Column) -> Column:
    """Exponential back-off with cap and floor, without the random part."""
    grown = base_ms.cast("double") * F.pow(F.lit(2.0), attempt)
    return F.greatest(base_ms.cast("double"), F.least(grown, max_ms.cast("double")))


def dead_letter_record(
    message: Column,
    queue: Column,
    message_id: Column,
    error_message: Column,
    category: Column,
    attempts: Column,
    dead_lettered_at: Column,
    *,
    error_name: Column | None = None,
    source: Column | None = None,
    status: Column | None = None,
    entity_type: Column | None = None,
    entity_id: Column | None = None,
    operation: Column | None = None,
    correlation_id: Column | None = None,
) -> Column:
    """What is stored about a message that will not be tried again."""
    none = F.lit(None).cast("string")
    source = F.lit("QUEUE") if source is None else source
    return F.struct(
        message.alias("original_message"),
        queue.alias("original_queue"),
        message_id.cast("string").alias("original_message_id"),
        F.struct(
            error_message.alias("message"),
            (F.concat(source, F.lit("Error")) if error_name is None else error_name).alias("name"),
            category.alias("category"),
            source.alias("source"),
            is_retriable(category).alias("retriable"),
            (none.cast("int") if status is None else status).alias("statusCode"),
        ).alias("error"),
        F.struct(
            (none if entity_type is None else entity_type).alias("entityType"),
            (none if entity_id is None else entity_id).alias("entityId"),
            (none if operation is None else operation).alias("operationName"),
            (none if correlation_id is None else correlation_id).alias("correlationId"),
            attempts.alias("attempts"),
            dead_lettered_at.alias("deadLetteredAt"),
        ).alias("context"),
    )
