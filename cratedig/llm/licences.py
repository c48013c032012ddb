"""Licence statements: a paragraph classifier whose findings are confirmed against templates.

Paragraphs are runs of lines that hold words; marks of comments are no words, so a
statement may be wrapped. A finding's line is that of its first word. Features are the
word n-grams (one to three words) of the templates below; a softmax regression over
them tells the families and an unknown class apart. It is trained on altered templates,
on a bounded sample of the corpus's own lines (``NEGATIVES``), and, as unknown, on
statements of licences that have no family (``UNLISTED``). Its certainty is calibrated
(one temperature) on examples left out of training, other licences and phrasings among
them. Windows of a paragraph are classified first. What is certain (``CERTAIN``) is then
confirmed: the window must hold ``ALIKE`` of a template of the family it was given, with
one of its words that no other family has; and the terms that are named beside it
(non-commercial, no derivatives, share alike) decide between families that differ in these alone.

An SPDX identifier is a name of its own: it is compared as a whole with the list of
identifiers, versions included, and one that isn't listed is no finding.

A paragraph without any telling word of a template cannot pass the comparison
(this is made sure of when the model is built), so it needs no features.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cratedig import session
from cratedig.llm.common import bounded, clear_of

# Names with versions, statements and passages by which the families are known.
TEMPLATES = {
    "Apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Apache License, Version 2.0",
        "Licensed under the Apache License 2.0",
        "Apache-2.0",
    ],
    "AGPL": [
        "GNU Affero General Public License",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
    ],
    "BSD": [
        "BSD License",
        "BSD 2-Clause License",
        "BSD 3-Clause License",
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ],
    "Boost": ["Boost Software License", "Distributed under the Boost Software License, Version 1.0."],
    "CC-BY": ["CC BY 4.0", "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC": ["CC BY-NC 4.0", "Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-NC-ND": ["CC BY-NC-ND 4.0", "Licensed under CC BY-NC-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA": ["CC BY-NC-SA 4.0", "Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "CC-BY-ND": ["CC BY-ND 4.0", "Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-SA": ["CC BY-SA 4.0", "CC BY-SA 3.0", "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0": ["CC0 1.0 Universal", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "EPL": ["Eclipse Public License"],
    "GPL": [
        "GNU General Public License",
        "licensed under GPLv3",
        "licensed under GPLv2",
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
    ],
    "ISC": [
        "ISC License",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "LGPL": [
        "GNU Lesser General Public License",
        "GNU Library General Public License",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
    ],
    "MIT": [
        "MIT License",
        "License: MIT",
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    ],
    "MPL": ["Mozilla Public License", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "reserved": ["All rights reserved."],
    "zlib": ["zlib License", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."],
}
# Identifiers of the SPDX list, by family; each may be followed by -only or -or-later where its family has these.
SPDX = {
    "AGPL": "AGPL-1.0 AGPL-3.0", "Apache": "Apache-1.0 Apache-1.1 Apache-2.0", "BSD": "0BSD BSD-1-Clause BSD-2-Clause BSD-3-Clause BSD-4-Clause",
    "Boost": "BSL-1.0", "CC-BY": "CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0", "CC0": "CC0-1.0", "EPL": "EPL-1.0 EPL-2.0",
    "CC-BY-NC": "CC-BY-NC-1.0 CC-BY-NC-2.0 CC-BY-NC-2.5 CC-BY-NC-3.0 CC-BY-NC-4.0", "CC-BY-ND": "CC-BY-ND-1.0 CC-BY-ND-2.0 CC-BY-ND-2.5 CC-BY-ND-3.0 CC-BY-ND-4.0",
    "CC-BY-NC-ND": "CC-BY-NC-ND-1.0 CC-BY-NC-ND-2.0 CC-BY-NC-ND-2.5 CC-BY-NC-ND-3.0 CC-BY-NC-ND-4.0",
    "CC-BY-NC-SA": "CC-BY-NC-SA-1.0 CC-BY-NC-SA-2.0 CC-BY-NC-SA-2.5 CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0",
    "CC-BY-SA": "CC-BY-SA-1.0 CC-BY-SA-2.0 CC-BY-SA-2.5 CC-BY-SA-3.0 CC-BY-SA-4.0", "GPL": "GPL-1.0 GPL-2.0 GPL-3.0", "ISC": "ISC",
    "LGPL": "LGPL-2.0 LGPL-2.1 LGPL-3.0", "MIT": "MIT MIT-0", "MPL": "MPL-1.0 MPL-1.1 MPL-2.0", "Unlicense": "Unlicense", "zlib": "Zlib",
}
VERSIONED = ("AGPL", "GPL", "LGPL")
# Statements of licences that have no family here; they teach the unknown class what else is licence-like.
UNLISTED = [
    "Artistic License 2.0", "Distributed under the Artistic License, Version 2.0.", "PostgreSQL License", "Python Software Foundation License",
    "Licensed under the European Union Public Licence, Version 1.2.", "Common Development and Distribution License", "SIL Open Font License, Version 1.1",
    "Microsoft Public License", "W3C Software Notice and License", "Do What The Fuck You Want To Public License", "Academic Free License 3.0",
    "Open Software License 3.0", "Common Public License 1.0", "Licensed under the Server Side Public License, version 1.", "Business Source License 1.1",
    "Released under the Elastic License 2.0.", "This work is licensed under the Open Database License.", "Open Data Commons Attribution License",
    "Licensed under the IBM Public License, Version 1.0.", "University of Illinois Open Source License", "licensed under the terms of our agreement",
]
# Words of terms that change what a Creative Commons licence allows.
TERMS = {
    "nc": "NC", "noncommercial": "NC", "nd": "ND", "noderivatives": "ND", "noderivs": "ND", "derivatives": "ND", "derivs": "ND", "commercial": "NC",
    "sa": "SA", "sharealike": "SA", "alike": "SA",
}
#: Families that differ in their terms alone.
SHARED = "CC-BY"
IDENTIFIER = re.compile(r"spdx-license-identifier:\s*\(?\s*([a-z0-9][a-z0-9.+-]*)(?:\s+(?:or|and|with)\s+([a-z0-9][a-z0-9.+-]*))*", re.IGNORECASE)
UNKNOWN = "unknown"
ORDERS = (1, 2, 3)
NEGATIVES = 10_000
ALTERED = 60
EPOCHS, RATE, DECAY = 300, 2.0, 1e-4
CERTAIN, ALIKE = 0.5, 0.75
#: Words in a larger share of the corpus's lines tell nothing by themselves.
COMMON = 0.01
TOKEN = re.compile(r"[^\W\d_]+|\d+")


def words(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def ngrams(tokens: list[str]) -> set[str]:
    return {" ".join(tokens[i : i + n]) for n in ORDERS for i in range(len(tokens) - n + 1)}


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Model:
    """Weights over template n-grams, the temperature, and the telling words."""

    def __init__(self, negatives: list[str], seed: int = 7):
        rng = random.Random(seed)
        self.families = [*TEMPLATES, UNKNOWN]
        self.shared = [i for i, f in enumerate(self.families) if f.startswith(SHARED)]
        self.templates = [(f, ngrams(words(t))) for f, ts in TEMPLATES.items() for t in ts]
        self.sizes = sorted({len_of(t) for _, t in self.templates})
        # words of one family's templates alone: of a template that has such words, a window must hold one
        homes: dict[str, set[str]] = {}
        for f, grams in self.templates:
            for w in grams:
                homes.setdefault(w, set()).add(f)
        self.names = {f: {w for w, fs in homes.items() if fs == {f} and " " not in w and not w.isdigit()} for f in TEMPLATES}
        self.feature = {g: i for i, g in enumerate(sorted(set().union(*(g for _, g in self.templates))))}
        plain = [words(t) for t in negatives]
        plain = [t for t in plain if not self.confirmed(ngrams(t), None)]  # statements among the corpus's lines
        seen: dict[str, int] = {}
        for t in plain:
            for w in set(t):
                seen[w] = seen.get(w, 0) + 1
        rare = {w for g in self.feature for w in g.split() if seen.get(w, 0) <= COMMON * max(1, len(plain))}
        self.telling = set(rare)
        for _, grams in self.templates:
            # without its telling words less than ALIKE of a template must be left
            if sum(rare.isdisjoint(g.split()) for g in grams) >= ALIKE * len(grams):
                self.telling |= {w for g in grams for w in g.split()}
        filler = [w for t in plain[:2000] for w in t] or ["x"]
        rows, labels = [], []
        for number, family in enumerate(TEMPLATES):
            for text in TEMPLATES[family]:
                base = words(text)
                for _ in range(ALTERED):
                    kept = [w for w in base if rng.random() > 0.08] or base
                    around = [[rng.choice(filler) for _ in range(rng.randrange(0, 12))] for _ in range(2)]
                    rows.append(around[0] + kept + around[1])
                    labels.append(number)
        for t in plain:
            rows.append(t)
            labels.append(len(self.families) - 1)
        for base in map(words, UNLISTED):
            for _ in range(ALTERED):
                around = [[rng.choice(filler) for _ in range(rng.randrange(0, 12))] for _ in range(2)]
                rows.append(around[0] + [w for w in base if rng.random() > 0.08] + around[1])
                labels.append(len(self.families) - 1)
        # fragments of templates: their common words alone must stay unknown
        for base in (words(t) for ts in TEMPLATES.values() for t in ts):
            for _ in range(ALTERED // 6):
                rows.append([w for w in base if w not in rare] + [rng.choice(filler) for _ in range(6)])
                labels.append(len(self.families) - 1)
        self._train([self.vector(ngrams(t)) for t in rows], np.array(labels))

    def vector(self, grams: set[str]) -> list[int]:
        return sorted(self.feature[g] for g in grams if g in self.feature)

    def _train(self, rows: list[list[int]], labels: np.ndarray) -> None:
        x = np.zeros((len(rows), len(self.feature) + 1), np.float32)
        x[:, -1] = 1
        for i, r in enumerate(rows):
            x[i, r] = 1 / np.sqrt(max(1, len(r)))
        k = len(self.families)
        y = np.eye(k, dtype=np.float32)[labels]
        check = np.arange(len(rows)) % 4 == 3
        share = 1 / np.maximum(1, np.bincount(labels[~check], minlength=k))[labels[~check]] / k
        self.weights = np.zeros((x.shape[1], k), np.float32)
        for _ in range(EPOCHS):
            p = softmax(x[~check] @ self.weights)
            self.weights -= RATE * 5 * (x[~check].T @ ((p - y[~check]) * share[:, None].astype(np.float32)) + DECAY * self.weights)
        z = x[check] @ self.weights
        losses = [(-np.log(softmax(z * t)[np.arange(len(z)), labels[check]] + 1e-12).mean(), t) for t in np.geomspace(0.25, 8, 21)]
        self.scale = min(losses)[1]

    def confirmed(self, grams: set[str], family: str | None) -> float:
        """The largest share of a template (of the family, or any) that the paragraph holds, if it is enough; else 0."""
        best = max((len(t & grams) / len(t) for f, t in self.templates if family in (None, f)), default=0.0)
        return best if best >= ALIKE else 0.0

    def judge(self, paragraph: str) -> tuple[str, float, float] | None:
        """Family, calibrated probability and template share of the surest finding; None without a confirmed statement."""
        found = self.findings(words(paragraph))
        return max(found, key=lambda f: f[2])[1:] if found else None

    def findings(self, tokens: list[str]) -> list[tuple[int, str, float, float]]:
        """All confirmed statements in their order: first word, family, calibrated probability, template share.

        Each template that a stretch around telling words holds is judged where it stands, at its own length; of
        findings that cover each other by more than half the one closest to its template stays.
        """
        if self.telling.isdisjoint(tokens):
            return []
        certain: list[tuple[float, int, int, str]] = []
        marks = [i for i, w in enumerate(tokens) if w in self.telling]
        sizes = self.sizes
        for a, b in spans(marks, len(tokens)):
            # as many words of templates as a window must hold at least to be confirmed; windows of fewer aren't classified
            known = [0]
            for w in tokens[a:b]:
                known.append(known[-1] + (w in self.feature))
            tried = {(c, min(b, c + size)) for size in sizes for c in range(a, max(a, b - size) + 1) if 2 * (known[min(b, c + size) - a] - known[c - a]) >= min(b - c, size)}
            for c, d in tried:
                if not self.telling.isdisjoint(tokens[c:d]) and (found := self.classified(tokens, c, d)):
                    certain.append((found[1], c, d, found[0]))
        near = []
        for p, c, d, family in certain:
            grams = ngrams(tokens[c:d])
            shares = [(len_of(t), len(t & grams) / len(t)) for f, t in self.templates if f == family and (t.isdisjoint(self.names[f]) or not grams.isdisjoint(t & self.names[f]))]
            if held := [x for x in shares if x[1] >= ALIKE]:
                near.append((*max(held), c, d, family, p))
        kept: list[tuple[int, int, str, float, float]] = []
        # the longest template first, where it stands closest
        for _, alike, c, d, family, p in sorted(near, key=lambda x: (-x[0], -x[1], x[3] - x[2], x[2], x[4])):
            if not any((2 * (min(d, y) - max(c, x)) > min(d - c, y - x)) or family == f and max(c, x) < min(d, y) for x, y, f, *_ in kept):
                kept.append((c, d, family, p, alike))
        return [(c, *rest) for c, _, *rest in sorted(kept)]

    def classified(self, tokens: list[str], c: int, d: int) -> tuple[str, float] | None:
        """The family of a window and its calibrated probability, if that is certain enough; None if it is unknown.

        Creative Commons licences are certain together; which one it is, the terms named in the window and beside it say.
        """
        at = self.vector(ngrams(tokens[c:d]))
        x = self.weights[at].sum(axis=0) / np.sqrt(max(1, len(at))) + self.weights[-1]
        p = softmax(x * self.scale)
        shared = self.shared
        best, certainty = int(np.argmax(p)), float(p.max())
        if p[shared].sum() >= certainty:
            terms = terms_of(tokens, c, d)
            family = next((f for f in self.families if f.startswith(SHARED) and set(f.split("-")[2:]) == terms), UNKNOWN)
            certainty = float(p[shared].sum())
        else:
            family = self.families[best]
        return (family, certainty) if family != UNKNOWN and certainty >= CERTAIN else None


def len_of(template: set[str]) -> int:
    """About how many words a template has."""
    return max(sum(1 for g in template if g.count(" ") == 0), 2 + sum(1 for g in template if g.count(" ") == 2))


def terms_of(tokens: list[str], c: int, d: int) -> set[str]:
    """The Creative Commons terms named in a window and right beside it."""
    end = d
    while end < len(tokens) and end < d + 6 and (tokens[end] in TERMS or tokens[end] in ("non", "no", "share")):
        end += 1
    start = c
    while start > 0 and tokens[start - 1] in TERMS:
        start -= 1
    return {TERMS[w] for w in tokens[start:end] if w in TERMS}


def identifiers(line: str) -> list[tuple[str, str]]:
    """(family, identifier) of the listed SPDX identifiers in a line, each compared as a whole."""
    out = []
    for m in IDENTIFIER.finditer(line):
        for name in re.split(r"[\s()]+", m[0].split(":", 1)[1].strip()):
            plain = name.lower().rstrip(".,;")
            for family, ids in SPDX.items():
                for one in ids.split():
                    ends = ("", "+", "-only", "-or-later") if family in VERSIONED else ("", "+")
                    if plain in [f"{one.lower()}{e}" for e in ends]:
                        out.append((family, one + plain[len(one) :]))
    return out


def paragraphs(text: str) -> Iterator[tuple[list[str], list[int]]]:
    """The words of each run of lines that have some, and the number of each word's line."""
    tokens: list[str] = []
    lines: list[int] = []
    for i, line in enumerate(text.split("\n")):
        if some := words(line):
            tokens += some
            lines += [i] * len(some)
        elif tokens:
            yield tokens, lines
            tokens, lines = [], []
    if tokens:
        yield tokens, lines


def spans(marks: list[int], size: int, reach: int = 30) -> list[tuple[int, int]]:
    """Stretches of words around the marks, joined where they overlap."""
    out: list[list[int]] = []
    for m in marks:
        a, b = max(0, m - reach), min(size, m + reach + 1)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def negatives(docs: DataFrame, bound: int = NEGATIVES) -> list[str]:
    """At most ``bound`` lines: one of each document, the documents of smallest text hash, the line chosen by it too."""
    lines = F.split("text", "\n")
    h = F.xxhash64("text")
    one = docs.where("text is not null").select(F.get(lines, F.pmod(h, F.size(lines)).cast("int")).alias("line"), h.alias("h"))
    return bounded(one, F.col("h"), "line", bound)


FOUND = "array<struct<line:int,family:string,probability:double,alike:double,identifier:string>>"


def statements(model: Model, telling: list[str], text: str) -> list[dict]:
    """All statements of a text in the order of their lines; identifiers are no part of the paragraphs that are classified."""
    low = text.lower()
    found = []
    if "spdx-license-identifier" in low:
        lines = low.split("\n")
        for i, line in enumerate(lines):
            if "spdx-license-identifier" in line:
                found += [{"line": i, "family": f, "probability": 1.0, "alike": 1.0, "identifier": name} for f, name in identifiers(line)]
                lines[i] = IDENTIFIER.sub(" ", line)
        low = "\n".join(lines)
    if any(w in low for w in telling):
        for tokens, lines in paragraphs(low):
            for at, family, probability, alike in model.findings(tokens):
                found.append({"line": lines[at], "family": family, "probability": probability, "alike": alike, "identifier": None})
    return sorted(found, key=lambda x: x["line"])


def with_licences(docs: DataFrame, name: str = "licences", text: str = "text") -> DataFrame:
    """The columns of ``docs`` with the confirmed statements (line number, family, probability, share of the template).

    ``identifier`` is the SPDX identifier, with its version, where the statement is one. A null or empty text has none; a very
    long one is looked at around its telling words alone, blank lines or not; repeated rows get equal results; an empty table
    gives no rows. A column of ``docs`` called like ``name`` is replaced; other names don't clash.
    """
    model = Model(negatives(docs.select(F.col(text).cast("string").alias("text"))))
    sent = docs.sparkSession.sparkContext.broadcast(
        {k: getattr(model, k) for k in ("families", "shared", "sizes", "templates", "names", "feature", "telling", "weights", "scale")}
    )
    (data,) = clear_of(docs, "data")
    given = docs.withColumn(data, F.coalesce(F.col(text).cast("string"), F.lit("")))
    schema = docs.withColumn(name, F.lit(None).cast(FOUND)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Model.__new__(Model)
        judge.__dict__.update(sent.value)
        telling = sorted(judge.telling)
        kind = pa.list_(pa.struct([("line", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("alike", pa.float64()), ("identifier", pa.string())]))
        for batch in batches:
            out = []
            for whole in batch.column(batch.num_columns - 1):
                out.append(statements(judge, telling, whole.as_py()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, kind)], [*batch.schema.names[:-1], name])

    return given.mapInArrow(run, schema)


def scanned(docs: DataFrame) -> DataFrame:
    """For documents (doc_id, text): doc_id, n_statements, families (sorted, joined by commas), first_line, probability."""
    made = with_licences(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    families = F.array_join(F.array_sort(F.array_distinct(F.col("licences.family"))), ",")
    return made.select(
        "doc_id", F.size("licences").cast("long").alias("n_statements"), families.alias("families"),
        F.get("licences", F.lit(0))["line"].alias("first_line"), F.array_max("licences.probability").alias("probability"),
    )


session.ship_with_jobs(__name__)
