"""Spelling variants: words one edit apart, found through an index of variable-length grams.

A gram dictionary holds all grams of two letters and longer ones only where the
gram without the last letter is on many words' lists, so that long lists are
split and short ones aren't. A word is cut into the longest grams of the
dictionary that start at each of its places, less those inside another.

An edit affects the grams that contain its place, those left of it that a longer
gram of the dictionary could replace, and those right of it that such a gram could
swallow; all others are in the edited word too. A word's places are dealt to
``BLOCKS`` blocks; for each, the bound on affected grams tells which grams survive
any edit there. A partner is on the lists of all of these, so the lists are merged
into one: surviving grams overlap, and the text they cover names the merged list.
Words on one merged list are compared; a pair counts in the block of its first
difference alone.

Words of c and c + 1 letters are compared in class c, and grams there have at most
a third of c letters, which leaves every word a surviving gram in every block. So
no word needs another way, and no list is cut.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cratedig import session
from cratedig.llm.common import as_bytes, keep, shuffle_parts

LEAST_LETTERS, LEAST_TIMES, RATIO = 7, 2, 10
#: A run whose hash this number divides loses a letter.
LOSES = 31
SHORTEST, LONGEST = 2, 4
#: Grams on more than this share of the words' lists are continued by a letter.
SHARE = 1 / 1024
#: The dictionary that every worker gets has no more grams than this; the share rises where it would.
MOST_GRAMS = 1 << 16
BLOCKS = 6
#: Entries that a task holds before it sends them on, or a worker remembers.
FLUSH, REMEMBERED = 300_000, 200_000
RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LEAST_LETTERS)


def words_of(doc_id: str, text: bytes) -> Counter:
    """Words of a text and how often they occur; runs that are too short, or become so, don't count."""
    out: Counter = Counter()
    seed = zlib.crc32(f"{doc_id}:".encode())
    for run, n in Counter(RUN.findall(text.lower().decode("utf-8", "replace"))).items():
        h = zlib.crc32(run.encode(), seed)
        if h % LOSES == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LETTERS:
                continue
        out[run] += n
    return out


def _totals(batches: Iterator[pa.RecordBatch], counts_of) -> Iterator[pa.RecordBatch]:
    """Sums of the counters of all rows, sent on whenever there are many entries."""

    def sent(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["key", "n"])

    held: Counter = Counter()
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            held.update(counts_of(*row))
            if len(held) > FLUSH:
                yield sent(held)
                held = Counter()
    if held:
        yield sent(held)


def vocabulary(docs: DataFrame) -> DataFrame:
    """Words of at least LEAST_LETTERS letters that occur LEAST_TIMES or more, and their number: (word, n), a written table."""
    given = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), as_bytes().alias("data"))
    found = given.mapInArrow(lambda batches: _totals(batches, words_of), "key string, n long")
    return keep(found.groupBy(F.col("key").alias("word")).agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TIMES), "words")


def grams_of(word: str) -> Counter:
    return Counter(word[p : p + q] for q in range(SHORTEST, LONGEST + 1) for p in range(len(word) - q + 1))


class Grams:
    """The dictionary: its grams, and their proper prefixes and suffixes with the length of the shortest gram that has them."""

    def __init__(self, grams: list[str]):
        self.grams = set(grams)
        self.heads: dict[str, int] = {}
        self.tails: dict[str, int] = {}
        for g in grams:
            for n in range(1, len(g)):
                self.heads[g[:n]] = min(len(g), self.heads.get(g[:n], len(g)))
                self.tails[g[-n:]] = min(len(g), self.tails.get(g[-n:], len(g)))
        self.left_ends: dict[tuple[int, str], int] = {}
        self.right_starts: dict[tuple[int, str], int] = {}

    def longest(self, text: str, p: int, q: int) -> int:
        """Length of the longest gram of at most q letters that starts at p; two letters if there is none."""
        for n in range(min(q, len(text) - p), SHORTEST, -1):
            if text[p : p + n] in self.grams:
                return n
        return SHORTEST

    def cut(self, text: str, q: int) -> list[tuple[int, int]]:
        """Start and end of each gram of a word that isn't inside an earlier one."""
        out, last = [], 0
        for p in range(len(text) - SHORTEST + 1):
            end = p + self.longest(text, p, q)
            if end > last:
                out.append((p, end))
                last = end
        return out

    def left_end(self, text: str, q: int) -> int:
        """How much of the text left of a block is covered by grams that no edit in or behind the block affects."""
        key = (q, text)
        if (found := self.left_ends.get(key)) is None:
            size = len(text)
            first = size
            for p in range(max(0, size - q + 1), size):  # the first start whose gram could grow across the edit
                if size - p < SHORTEST or self.heads.get(text[p:], q + 1) <= q:
                    first = p
                    break
            found = max((e for p, e in self.cut(text, q) if p < first), default=0)
            self._remember(self.left_ends, key, found)
        return found

    def right_start(self, text: str, q: int) -> int:
        """Where the cover begins in the text right of a block; its length if nothing survives."""
        key = (q, text)
        if (found := self.right_starts.get(key)) is None:
            reach = 0
            for n in range(min(q - 1, len(text)), 0, -1):  # how far a gram across the edit could reach
                if n < SHORTEST or self.tails.get(text[:n], q + 1) <= q:
                    reach = n
                    break
            found = next((p for p, e in self.cut(text, q) if e > reach), len(text))
            self._remember(self.right_starts, key, found)
        return found

    @staticmethod
    def _remember(store: dict, key: tuple[int, str], value: int) -> None:
        if len(store) >= REMEMBERED:
            store.clear()
        store[key] = value


def widest(c: int) -> int:
    """Letters of the longest gram in class c."""
    return max(SHORTEST, min(LONGEST, c // 3))


def blocks(c: int) -> list[tuple[int, int]]:
    """The places 0..c of an edit between words of c and c or c + 1 letters, as ranges; both outer ones leave a gram beside them."""
    edges = [round(i * (c + 1) / BLOCKS) for i in range(BLOCKS + 1)]
    return [(a, b - 1) for a, b in zip(edges, edges[1:])]


def survivors(grams: Grams, word: str, c: int, first: int, last: int) -> tuple[str, str]:
    """Texts covered by the surviving grams left and right of a block, in class c.

    The right text leaves out the last place's letter for words of c letters and two letters for those of c + 1, so that
    it is the same for words a replaced letter or an added one apart.
    """
    q, right = widest(c), max(0, c - 1 - last)
    left_text, right_text = word[:first], word[len(word) - right :]
    return left_text[: grams.left_end(left_text, q)], right_text[grams.right_start(right_text, q) :]


def lists_of(grams: Grams, word: str) -> Iterator[tuple[int, bool, int, int]]:
    """The merged lists a word is on: name, whether it is the longer kind in its class, first and last place of the block."""
    from xxhash import xxh64_intdigest

    for c in (len(word), len(word) - 1):
        if c >= LEAST_LETTERS:
            for first, last in blocks(c):
                left, right = survivors(grams, word, c, first, last)
                name = xxh64_intdigest(f"{c} {first} {left} {right}".encode())
                yield name - (1 << 64) if name >> 63 else name, len(word) > c, first, last


def dictionary(words: DataFrame, share: float = SHARE, most: int = MOST_GRAMS) -> list[str]:
    """The grams of the dictionary for a vocabulary: at most ``most`` (which must hold all two-letter ones) reach the driver."""
    counted = words.select("word").mapInArrow(lambda batches: _totals(batches, grams_of), "key string, n long")
    counted = keep(counted.groupBy(F.col("key").alias("gram")).agg(F.sum("n").alias("n")), "grams")
    heads = counted.select(F.col("gram").alias("head"), F.col("n").alias("on_list"))
    known = counted.withColumn("head", F.expr("substring(gram, 1, length(gram) - 1)")).join(heads, "head", "left")
    # by powers of two of the list that a gram continues; two-letter grams continue none
    known = keep(known.select("gram", F.when(F.length("gram") > SHORTEST, F.col("on_list")).alias("on_list")), "grams")
    spread = {r["level"]: r["k"] for r in known.groupBy(F.floor(F.log2("on_list")).alias("level")).agg(F.count(F.lit(1)).alias("k")).collect()}
    least = words.count() * share
    level = next((x for x in range(64) if 2.0**x > least and spread.get(None, 0) + sum(k for y, k in spread.items() if y is not None and y >= x) <= most), 64)
    return sorted(r["gram"] for r in known.where(F.col("on_list").isNull() | (F.col("on_list") >= F.lit(2.0**level))).select("gram").collect())


def near_pairs(words: DataFrame, grams: list[str]) -> DataFrame:
    """All pairs of words (word, n) one edit apart: (a, a_n, b, b_n), each pair once."""
    sent = words.sparkSession.sparkContext.broadcast(grams)
    schema = "list long, longer boolean, first short, last short, word string, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Grams(sent.value)
        types = [pa.int64(), pa.bool_(), pa.int16(), pa.int16(), pa.string(), pa.int64()]
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                part = whole.slice(at, 2000)
                rows = [(*x, word, n) for word, n in zip(*(c.to_pylist() for c in part.columns)) for x in lists_of(known, word)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [c.split()[0] for c in schema.split(", ")])

    spread = words.select("word", "n").repartition(shuffle_parts(words.sparkSession), "word")  # a small table, but each word takes a while
    on = keep(spread.mapInArrow(run, schema), "lists")
    a = on.where("not longer").select("list", "first", "last", F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = on.select("list", "longer", F.col("word").alias("b"), F.col("n").alias("b_n"))
    here = F.expr("(longer OR a < b) AND substring(a, 1, last + 1) <> substring(b, 1, last + 1) AND substring(a, 1, first) = substring(b, 1, first)")
    return a.join(b, (a["list"] == b["list"]) & here & (F.levenshtein("a", "b", 1) == 1)).select("a", "a_n", "b", "b_n")


def roots(forms: DataFrame, max_rounds: int = 20) -> DataFrame:
    """For (word, form): (word, root), the last word that forms lead to. Each round doubles the steps; forms must not go round."""
    reached = keep(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(max_rounds):
        on = reached.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        if reached.join(on, "root", "left_semi").isEmpty():
            return reached
        reached = keep(reached.join(on, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "roots")
    raise RuntimeError("forms go round")


def grouped(docs: DataFrame) -> DataFrame:
    """Words of all documents (doc_id, text) with their usual form: word, form, root, n, n_near, form_n.

    ``form`` is the near word of largest n (the first in code-point order of several), if that is RATIO times the word's n or
    more. Null texts have no words; a null id counts as empty in the hash that decides which runs lose a letter. Repeated rows
    count each time. Texts and runs may have any length. No words give no rows; other columns, whatever their names, are not read.
    """
    words = vocabulary(docs)
    pairs = keep(near_pairs(words, dictionary(words)), "near")
    way = lambda x, y: F.struct(F.col(x).alias("word"), F.col(f"{x}_n").alias("n"), F.col(y).alias("form"), F.col(f"{y}_n").alias("form_n"))
    both = pairs.select(F.inline(F.array(way("a", "b"), way("b", "a"))))
    n_near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"))
    best: Column = F.min(F.struct((-F.col("form_n")).alias("m"), "form"))
    forms = both.where(F.col("form_n") >= RATIO * F.col("n")).groupBy("word").agg(best.alias("best")).select("word", "best.form", (-F.col("best.m")).alias("form_n"))
    forms = keep(forms, "forms")
    made = words.join(n_near, "word", "left").join(forms, "word", "left").join(roots(forms), "word", "left")
    return made.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")


session.ship_with_jobs(__name__)
