"""Quality rules of documents and hosts, in DataFrame expressions only.

Each document is measured by itself. Rule failures are then summed by host; a
host's rate is shrunk towards the rate of all hosts by a beta prior fitted to the
hosts' rates, so that a host with a few bad documents is not judged by them alone,
and the host's verdict is joined back to its documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from cratedig.llm.common import clear_of, keep

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 3
#: Rules by name, over the measures; a host fails if the shrunk share of its documents failing one exceeds HOST_LIMIT.
RULES: dict[str, str] = {
    "short": "n_words < 50",
    "repeated": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "lines": "10 * n_dup_lines > 3 * n_lines",
}
BASE_RULES = ("short", "repeated")
HOST_LIMIT = 0.5
#: Bounds of the prior's weight, in documents.
WEAKEST, STRONGEST = 10.0, 1000.0


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluates ``value`` once for an expression that reads it several times."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeat_words(words: Column) -> Column:
    """Words that lie in a window of WINDOW words found twice or more; windows are compared by 64-bit hashes."""
    n = F.size(words)
    windows = F.slice(
        F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, WINDOW)])), 1, F.greatest(n - WINDOW + 1, F.lit(0))
    )

    def covered(at: Column) -> Column:
        """Positions in ascending order cover WINDOW words each, less where the next begins earlier."""
        steps = F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, step: total + step)

    def twice(placed: Column) -> Column:
        def alike(x: Column, i: Column) -> Column:
            return F.coalesce(F.get(placed, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(placed, i + 1)["h"] == x["h"], F.lit(False))

        return let(F.sort_array(F.transform(F.filter(placed, alike), lambda x: x["i"])), covered)

    def measured(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(let(placed, twice))

    return F.when(n < WINDOW, F.lit(0).cast("bigint")).otherwise(let(windows, measured))


def measures(text: str = "text") -> Column:
    """The measures of a text as nested structs, so that each part is computed once; a null text has no words."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.struct(
        let(
            words,
            lambda w: F.struct(
                F.size(w).cast("bigint").alias("n_words"),
                F.char_length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
                repeat_words(w).alias("n_repeat_words"),
            ),
        ).alias("by_word"),
        let(
            lines,
            lambda x: F.struct(
                F.size(x).cast("bigint").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines")
            ),
        ).alias("by_line"),
        F.regexp_count(t, F.lit(f"[{SYMBOLS}]")).cast("bigint").alias("n_symbols"),
    )


def flat(m: str) -> list[Column]:
    parts = {"by_word": ("n_words", "word_chars", "n_repeat_words"), "by_line": ("n_lines", "n_dup_lines")}
    return [F.col(m)[k][name].alias(name) for k, names in parts.items() for name in names] + [F.col(m)["n_symbols"].alias("n_symbols")]


def host_verdicts(measured: DataFrame, host: str, rules: dict[str, str] | None = None, limit: float = HOST_LIMIT) -> DataFrame:
    """From measured documents: one row per host (null is a host) with ``host_failed``.

    For each rule a beta prior is fitted to the hosts' failure rates by their mean and variance. Two numbers a rule
    reach the driver. With one host, or hosts that hardly differ, the prior weighs ``STRONGEST`` documents, never less than ``WEAKEST``.
    """
    rules = rules or RULES
    hosts = keep(
        measured.groupBy(F.col(host).alias("host")).agg(
            F.count(F.lit(1)).alias("n"), *[F.count_if(F.expr(rule)).alias(f"failed_{name}") for name, rule in rules.items()]
        ),
        "hosts",
    )
    rate = lambda name: F.col(f"failed_{name}") / F.col("n")
    seen = hosts.agg(
        *[f(rate(name)).alias(f"{kind}_{name}") for name in rules for kind, f in (("mean", F.mean), ("spread", F.var_pop))], F.mean(1 / F.col("n")).alias("inverse")
    ).first()
    bad = F.lit(False)
    for name in rules:
        mean, spread = seen[f"mean_{name}"] or 0.0, seen[f"spread_{name}"] or 0.0
        between = max(spread - mean * (1 - mean) * (seen["inverse"] or 0.0), 0.0)  # what chance doesn't explain
        strength = min(STRONGEST, max(WEAKEST, mean * (1 - mean) / between - 1)) if between > 0 else STRONGEST
        bad = bad | ((F.col(f"failed_{name}") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength)) > limit)
    return hosts.select("host", bad.alias("host_failed"))


def judged(docs: DataFrame, host: str = "source") -> DataFrame:
    """For documents (doc_id, text, host): the measures, base_failed, kept, host_failed.

    A document is kept if it passes the base rules and its host passes all rules. A null text has no words and fails;
    repeated rows count each; an empty table gives no rows.
    """
    m = keep(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(host).alias("host"), measures().alias("m")), "measures")
    rows = m.select("doc_id", "host", *flat("m"))
    base = F.expr(" OR ".join(f"({RULES[r]})" for r in BASE_RULES))
    verdicts = host_verdicts(rows, "host").withColumnRenamed("host", "of")
    joined = rows.withColumn("base_failed", base).join(verdicts, F.col("host").eqNullSafe(F.col("of")))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return joined.select(*columns, (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"), "host_failed")


def kept(docs: DataFrame, host: str = "source") -> DataFrame:
    """The columns of ``docs``, without documents that the rules reject. Rows are written once with their measures."""
    m, of = clear_of(docs, "m", "of")
    rows = keep(docs.withColumn(m, measures()), "measured")
    verdicts = host_verdicts(rows.select(F.col(host).alias("host"), *flat(m)), "host")
    bad_hosts = verdicts.where("host_failed").select(F.col("host").alias(of))
    by_word = F.col(m)["by_word"]
    base = (by_word["n_words"] < 50) | (100 * by_word["n_repeat_words"] > 50 * by_word["n_words"])
    return rows.where(~base).join(bad_hosts, F.col(host).eqNullSafe(F.col(of)), "left_anti").select(*docs.columns)
