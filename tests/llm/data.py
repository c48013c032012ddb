"""Small tables with everything that tends to go wrong, and plain versions of shared steps."""

import random
import re
import zlib

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"
#: Columns whose names the operators use inside.
CLASHING = ("fp", "row", "m", "of", "u", "n", "whole", "below", "data", "ids", "decoded", "ROOT", "node", "ll", "host", "score")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHING)

PROSE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from a tall dark tree near the old stone bridge"


def prose(seed: int, n: int) -> str:
    rng, words = random.Random(seed), PROSE.split()
    return " ".join(rng.choice(words) + ("" if i % 11 else str(seed)) for i in range(n))


def dirty_rows() -> list[tuple]:
    texts = [
        (1, prose(1, 80), "en", "a"), (2, prose(2, 90), "en", "b"), (3, prose(1, 80), "en", "a"), (3, prose(1, 80), "en", "a"),
        (4, None, "en", "a"), (5, "", None, None), (6, " \t\n\x0b\x0c\r ", "en", None), (7, "one", "en", "b"), (8, "ONE two", "en", "c"),
        (None, prose(9, 70), "en", "b"), (None, None, None, None), (10, prose(3, 30_000), "en", "b"), (11, "x" * 3000, "en", "c"),
        (12, "bad ▁ ▁▁ text with　spaces  and  runs", "en", "c"), (13, "\U0001f600 ́é �", "xx", "d"),
        (14, prose(4, 60) + "\n" + prose(4, 60), "en", "d"), (15, prose(5, 100), "en", "\U0001f600"), (16, prose(5, 100) + " end", "en", "￿"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), *["x"] * len(CLASHING)) for i, t, lang, s in texts]


def dirty(spark):
    return spark.createDataFrame(dirty_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(sf: str = SF) -> dict[int, str]:
    return {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()}


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def low(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def held_out(doc_id, n: int) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % n == 0


def components(values: list[int], radius: int = 3) -> list[int]:
    """For each value the smallest index of its component, by comparing all pairs."""
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= radius:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(values))]


def fingerprint(text: str | None) -> int:
    from xxhash import xxh64_intdigest

    w = words(low(text))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxh64_intdigest(s.encode("utf-8"), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
