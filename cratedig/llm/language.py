"""Language identification by Bayesian fusion of evidence.

The text gives a likelihood for each language (character trigrams of its words).
A row may also carry a declared language (mark-up), an address suffix and a host.
What these say is learnt from the data by grouped aggregation: first the text
alone gives each row a posterior; summed by declared tag, suffix and host it
gives P(tag | language), P(suffix | language) and host priors. Host priors are
smoothed towards their site's, these towards the corpus's. A second step adds
all of it up in log space.

The text model is fitted on a bounded sample of rows with a declared language
(``SAMPLE`` rows a language of at most ``LONGEST_SAMPLE`` bytes). Everything else
counts all rows. The model has SLOTS x languages numbers of four bytes, with all
languages of the code list 48 MB.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cratedig import session
from cratedig.llm.common import Recent, as_bytes, clear_of, content_key, keep, worker_store

SAMPLE = 1000
#: A language needs so many declared rows, whatever the number of others.
LEAST_ROWS = 5
# The two-letter codes of ISO 639. No other tag names a language, so there are never more classes than these.
CODES = (
    "aa ab ae af ak am an ar as av ay az ba be bg bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz ee el en eo es et eu "
    "fa ff fi fj fo fr fy ga gd gl gn gu gv ha he hi ho hr ht hu hy hz ia id ie ig ii ik io is it iu ja jv ka kg ki kj kk kl km "
    "kn ko kr ks ku kv kw ky la lb lg li ln lo lt lu lv mg mh mi mk ml mn mr ms mt my na nb nd ne ng nl nn no nr nv ny oc oj om "
    "or os pa pi pl ps pt qu rm rn ro ru rw sa sc sd se sg si sk sl sm sn so sq sr ss st su sv sw ta te tg th ti tk tl tn to tr "
    "ts tt tw ty ug uk ur uz ve vi vo wa wo xh yi yo za zh zu"
).split()
SLOTS = 1 << 16
#: Trigrams of one text depend on each other; at most so many count in full.
FULL_TRIGRAMS = 60.0
#: Weights, in rows, of the parent's prior for a site and a host, and of the corpus for a tag or suffix.
SITE_WEIGHT, HOST_WEIGHT, TAG_WEIGHT = 50.0, 20.0, 5.0
#: Standard deviations below the usual fit at which a text is of no known language.
FAR_OFF = 6.0
LEAST_POSTERIOR = 0.5
WORD = re.compile(r"[^\W\d_]+")
CACHED_WORDS = 200_000
#: Bytes of the words' values that a worker remembers, twice; with many languages it remembers fewer words.
CACHED_BYTES = 48 << 20
#: Sampled texts are no longer than this, so SAMPLE x languages x this bounds what reaches the driver.
LONGEST_SAMPLE = 1 << 13


def trigrams(word: str) -> list[int]:
    padded = f" {word} "
    return [zlib.crc32(padded[i : i + 3].encode("utf-8", "replace")) % SLOTS for i in range(len(padded) - 2)]


class TextModel:
    """Log-probabilities of hashed trigrams by language, and how well texts of a language usually fit it."""

    def __init__(self, languages: list[str], logs: np.ndarray, usual: float, spread: float):
        self.languages, self.logs, self.usual, self.spread = languages, logs, usual, spread

    def values(self) -> tuple:
        return self.languages, self.logs, self.usual, self.spread


def fit(rows: list[tuple[str, str]], languages: list[str]) -> TextModel:
    """From (text, language) pairs. Every fifth text is left out of the counts and shows how well others fit."""
    counts = np.full((SLOTS, max(1, len(languages))), 0.05)
    at = {x: i for i, x in enumerate(languages)}
    learn = [r for i, r in enumerate(rows) if i % 5 != 4] or rows
    for language in languages:
        words = Counter(w for text, own in learn if own == language for w in WORD.findall(text.lower()))
        slots = [(t, n) for w, n in words.items() for t in trigrams(w)]
        if slots:
            t, n = np.array(slots).T
            counts[:, at[language]] += np.bincount(t, n, SLOTS)
    logs = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    fits = []
    for i, (text, own) in enumerate(rows):
        if i % 5 == 4 and len(t := [s for w in WORD.findall(text.lower()) for s in trigrams(w)]) >= 20:
            fits.append(logs[t, at[own]].mean())
    return TextModel(languages, logs, float(np.mean(fits)) if fits else -20.0, float(np.std(fits)) + 0.1 if fits else 5.0)


def declared_languages(rows: DataFrame, declared: str, least_rows: int = LEAST_ROWS) -> list[str]:
    """Declared codes of at least ``least_rows`` rows, in code point order."""
    tagged = rows.where(F.col(declared).isin(CODES))
    many = tagged.groupBy(declared).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_rows)
    return sorted(r[0] for r in many.select(declared).collect())


def sample(rows: DataFrame, text: str, declared: str, languages: list[str], per_language: int = SAMPLE) -> list[tuple[str, str]]:
    """At most ``per_language`` texts of each language, those of smallest hash, one for each hash.

    Distinct hashes are counted by language and leading bits, and again by the next bits where a language's bound falls; so
    no task sorts a language's rows, and the counts are at most 4,096 a language each time.
    """
    if not languages:
        return []
    hashed = rows.where(F.col(declared).isin(languages) & (F.octet_length(F.col(text)) <= LONGEST_SAMPLE)).select(
        F.col(declared).alias("of"), F.xxhash64(text).alias("h"), F.col(text).alias("t")
    )
    slim = hashed.select("of", "h").distinct()
    before = Window.partitionBy("of").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)

    def bounds(counts: DataFrame) -> DataFrame:
        """For each language the first bucket that doesn't fit any more, and how many fit before it."""
        run = counts.withColumn("fit", F.coalesce(F.sum("n").over(before), F.lit(0))).where(F.col("fit") + F.col("n") > F.col("left"))
        return run.groupBy("of").agg(F.min("at").alias("at"), F.min("fit").alias("fit"))

    many = F.count(F.lit(1)).alias("n")
    top = slim.groupBy("of", F.shiftright("h", 52).alias("at")).agg(many).withColumn("left", F.lit(per_language))
    first = bounds(top).select("of", F.col("at").alias("top"), (F.lit(per_language) - F.col("fit")).alias("left"))
    inner = slim.join(F.broadcast(first), "of").where(F.shiftright("h", 52) == F.col("top"))  # a row for each language, of which CODES bounds the number
    then = bounds(inner.groupBy("of", "left", F.shiftright("h", 40).alias("at")).agg(many))
    found = {r["of"]: r["edge"] for r in then.select("of", F.shiftleft("at", 40).alias("edge")).collect()}
    edge = F.create_map(*[F.lit(x) for of in languages for x in (of, found.get(of, (1 << 63) - 1))])
    some = hashed.where(F.col("h") < edge[F.col("of")]).groupBy("of", "h").agg(F.min("t").alias("t"))
    return [(r["t"], r["of"]) for r in some.orderBy("of", "h").collect()]


def with_likelihoods(rows: DataFrame, model: TextModel, name: str, text: str = "text") -> DataFrame:
    """Adds an array: a tempered log-likelihood for each language, then the mean per trigram of the best, then the number
    of trigrams."""
    (data,) = clear_of(rows, "data")
    given = rows.withColumn(data, as_bytes(text))
    schema = rows.withColumn(name, F.lit(None).cast("array<double>")).schema
    sent = rows.sparkSession.sparkContext.broadcast(model.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, logs, usual, _ = sent.value
        k = max(1, len(languages))
        store = worker_store("language")
        if store.get("model") != (languages, usual):
            store.clear()
            store["model"], store["cache"] = (languages, usual), Recent(min(CACHED_WORDS, CACHED_BYTES // (4 * (k + 1))))

        def weigh(words: list[str]) -> Iterator[bytes]:
            for w in words:
                t = trigrams(w)
                yield np.append(logs[t].sum(axis=0), len(t)).astype(np.float32).tobytes()

        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                part = whole.slice(at, 500)
                split = [WORD.findall(t.decode("utf-8", "replace").lower()) for t in part.column(part.num_columns - 1).to_pylist()]
                index = {w: i for i, w in enumerate(set().union(*split))}
                known = store["cache"].ensure(index, weigh)
                table = np.frombuffer(b"".join(map(known.__getitem__, index)), np.float32).reshape(len(index), k + 1)
                out = np.zeros((len(split), k + 2))
                for i, words in enumerate(split):
                    if words:
                        sums = table[np.fromiter(map(index.__getitem__, words), np.int64, len(words))].sum(axis=0, dtype=np.float64)
                        mean = sums[:k] / sums[k]
                        out[i] = [*(mean * min(sums[k], FULL_TRIGRAMS)), mean.max(), sums[k]]
                offsets = pa.array(np.arange(len(split) + 1) * (k + 2), pa.int32())
                cols = part.columns[:-1] + [pa.ListArray.from_arrays(offsets, pa.array(out.reshape(-1)))]
                yield pa.RecordBatch.from_arrays(cols, [*part.schema.names[:-1], name])

    return given.mapInArrow(run, schema)


def normal(logs: Column) -> Column:
    """Probabilities from log-weights."""
    shifted = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    return F.element_at(F.transform(F.array(shifted), lambda a: F.transform(a, lambda x: x / total(a))), 1)


def _sums(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    """The rows' posteriors summed by some columns, as an array."""
    return rows.groupBy(*by).agg(F.array(*[F.sum(F.get("p", F.lit(i))) for i in range(k)]).alias("n"))


def fused(rows: DataFrame, k: int) -> DataFrame:
    """From rows (ll, declared, suffix, site, host and others): adds ``posterior``, an array over the languages.

    ``ll`` is what :func:`with_likelihoods` gives. Evidence that is null says nothing.
    """
    known = keep(rows.withColumn("p", F.when(F.get("ll", F.lit(k + 1)) > 0, normal(F.slice("ll", 1, k)))), "text-posteriors")
    sure = known.where("p is not null")
    seen = sure.agg(*[F.coalesce(F.sum(F.get("p", F.lit(i))), F.lit(0.0)) for i in range(k)]).first()
    corpus = (np.array(seen, float) + 1) / (sum(seen) + k)
    overall = F.array(*[F.lit(float(x)) for x in corpus])

    def smoothed(counts: DataFrame, parent: Column, weight: float, name: str) -> DataFrame:
        total = F.aggregate("n", F.lit(0.0), lambda s, x: s + x)
        return counts.withColumn(name, F.zip_with("n", parent, lambda n, q: (n + weight * q) / (total + weight))).drop("n")

    def tags(column: str, name: str) -> DataFrame:
        """P(tag | language) up to a factor of the tag: its share of each language against its share of all."""
        lift = smoothed(_sums(sure.where(F.col(column).isNotNull()), [column], k), overall, TAG_WEIGHT, name)
        return lift.withColumn(name, F.zip_with(name, overall, lambda p, q: F.log(p / q))).withColumnRenamed(column, f"{column}_of")

    sites = smoothed(_sums(sure.where("site is not null"), ["site"], k), overall, SITE_WEIGHT, "site_prior")
    hosts = _sums(sure.where("host is not null"), ["site", "host"], k).join(sites.withColumnRenamed("site", "s"), F.col("site") == F.col("s")).drop("s", "site")
    hosts = smoothed(hosts, F.col("site_prior"), HOST_WEIGHT, "host_prior").drop("site_prior").withColumnRenamed("host", "host_of")
    sites = sites.withColumnRenamed("site", "site_of")
    joined = known
    for column, table in (("declared", tags("declared", "declared_lift")), ("suffix", tags("suffix", "suffix_lift")), ("site", sites), ("host", hosts)):
        joined = joined.join(table, F.col(column) == F.col(f"{column}_of"), "left").drop(f"{column}_of")
    prior = F.transform(F.coalesce("host_prior", "site_prior", overall), lambda x: F.log(x))
    nothing = F.array(*[F.lit(0.0)] * k)
    total = prior
    for evidence in (F.slice("ll", 1, k), F.coalesce("declared_lift", nothing), F.coalesce("suffix_lift", nothing)):
        total = F.zip_with(total, evidence, lambda a, b: a + b)
    return joined.withColumn("total", total).withColumn("posterior", normal(F.col("total"))).drop(
        "total", "p", "declared_lift", "suffix_lift", "site_prior", "host_prior"
    )


def decided(rows: DataFrame, model: TextModel) -> DataFrame:
    """Adds lang (null if unknown), posterior of it, and kept.

    Unknown: no letters at all, or a fit ``FAR_OFF`` deviations below what texts of the known languages show (wider for
    short texts), or no language with LEAST_POSTERIOR.
    """
    k = len(model.languages)
    if k == 0:
        return rows.withColumn("lang", F.lit(None).cast("string")).withColumn("probability", F.lit(0.0)).withColumn("kept", F.lit(False))
    best = F.array_max("posterior")
    names = F.array(*[F.lit(x) for x in model.languages])
    n, fit_ = F.get("ll", F.lit(k + 1)), F.get("ll", F.lit(k))
    floor = F.lit(model.usual) - FAR_OFF * model.spread * F.sqrt(1 + 100 / F.greatest(n, F.lit(1.0)))
    kept = (n > 0) & (fit_ >= floor) & (best >= LEAST_POSTERIOR)
    lang = F.get(names, (F.array_position("posterior", best) - 1).cast("int"))
    return rows.withColumn("kept", kept).withColumn("probability", best).withColumn("lang", F.when(F.col("kept"), lang))


def evidence_of_documents(docs: DataFrame) -> list[Column]:
    """Documents declare a language and have a source, which stands for the host; they have no address."""
    none = F.lit(None).cast("string")
    code = F.regexp_extract(F.lower("lang"), "^([a-z]{2,3})[-_]", 1)  # of en-us the language
    return [F.when(code != "", code).otherwise(F.lower("lang")).alias("declared"), none.alias("suffix"), F.lit("documents").alias("site"), F.col("source").cast("string").alias("host")]


def evidence_of_pages(html: str = "html", url: str = "url") -> list[Column]:
    """The mark-up's language, and from the address its suffix, its last two labels (site) and its host."""
    host = F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    some = lambda c: F.when(c != "", c)
    return [
        some(F.lower(F.regexp_extract(F.col(html), r"(?i)<html[^>]*\slang\s*=\s*[\"']?([A-Za-z]+)", 1))).alias("declared"),
        some(F.regexp_extract(host, r"\.([^.]+)$", 1)).alias("suffix"),
        some(F.regexp_extract(host, r"([^.]+\.[^.]+|^[^.]+)$", 1)).alias("site"),
        some(host).alias("host"),
    ]


def page_text(html: str = "html") -> Column:
    """The text between tags, without scripts, styles and comments."""
    gone = F.regexp_replace(F.col(html), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(F.regexp_replace(gone, r"<[^>]*>", " "), r"&[#A-Za-z0-9]+;", " ")


def identified(rows: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """For rows (text, declared, suffix, site, host and others): the others with lang, probability, kept.

    ``labelled`` (text, declared) trains the text model; by default the rows themselves. Null or empty texts and texts
    without letters are of unknown language; missing evidence is neutral; repeated rows count each; without any
    declared language nothing can be learnt and every row is unknown.
    """
    labelled = labelled or rows
    languages = declared_languages(labelled, "declared")
    model = fit(sample(labelled, "text", "declared", languages), languages)
    seen = with_likelihoods(rows, model, "ll").drop("text")
    if not languages:
        return decided(seen, model).drop("ll", "declared", "suffix", "site", "host")
    return decided(fused(seen, len(languages)), model).drop("ll", "posterior", "declared", "suffix", "site", "host")


def accepted(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` (text, lang, source), without documents of unknown language.

    A language that fewer than LEAST_ROWS rows declare, or whose code isn't in CODES, has no class: its documents are unknown
    and go, unless they fit another language. Ids are not looked at, so repeated and null ones make no difference. The decision
    depends on these three columns alone, so the rows that go are named by a key of their values; ``docs`` is read again for
    the rest and is not copied.
    """
    (key,) = clear_of(docs, "key")
    made = content_key(docs, ["text", "lang", "source"])
    slim = docs.select(made.alias("key"), "text", *evidence_of_documents(docs))
    gone = keep(identified(slim).where("not kept").select(F.col("key").alias(key)).distinct(), "unknown-language")
    return docs.withColumn(key, made).join(gone, key, "left_anti").select(*docs.columns)


session.ship_with_jobs(__name__)
