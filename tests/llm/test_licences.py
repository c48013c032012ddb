from cratedig.llm import licences
from cratedig.llm.queries import QUERIES
from tests.llm import data

SIGNS = {"CC-BY-NC": "CC BY-NC", "GPL": "GNU General", "Apache": "Apache License", "MIT": "MIT License", "reserved": "All rights reserved"}


def test_query_finds_the_planted_statements(spark):
    sf = "/root/testdata/sf0.01"
    docs = data.documents(sf)
    rows = QUERIES["op5_licence_scan"](spark, sf).collect()
    assert len(rows) == len(docs) and any(r.n_statements for r in rows)
    for r in rows:
        want = sorted(k for k, sign in SIGNS.items() if sign.lower() in docs[r.doc_id].lower())
        assert r.families == ",".join(want)
        if want:
            assert any(s.lower() in docs[r.doc_id].split("\n")[r.first_line].lower() for s in SIGNS.values())


def test_families_and_unknown():
    model = licences.Model([data.prose(i, 25) for i in range(300)])
    for family, texts in licences.TEMPLATES.items():
        for text in texts:
            found = model.judge(f"{data.prose(3, 9)} {text} {data.prose(4, 9)}")
            assert found is not None and found[0] == family, (family, text, found)
    for text in ("", "   ", data.prose(5, 60), "the license of this work is unknown", "rights", "All work under the bridge is free"):
        assert model.judge(text) is None


def test_paragraphs_without_telling_words_cannot_be_confirmed():
    model = licences.Model([" ".join(["all", "rights", "the", "license", "under"] * 3)] * 50)
    for _, grams in model.templates:
        left = [g for g in grams if model.telling.isdisjoint(g.split())]
        assert len(left) < licences.ALIKE * len(grams)


def test_dirty_rows(spark):
    made = licences.with_licences(data.dirty(spark))
    assert made.columns == [*data.dirty(spark).columns, "licences"]
    assert made.count() == len(data.dirty_rows()) and made.where("size(licences) > 0").count() == 0
    assert licences.scanned(data.empty(spark)).count() == 0


def families(model, text):
    return [f[1] for f in model.findings(licences.words(text))]


def test_every_statement_of_a_line_is_found():
    model = licences.Model([data.prose(i, 25) for i in range(300)])
    line = "Released under the MIT License. Licensed under the Apache License, Version 2.0."
    assert families(model, line) == ["MIT", "Apache"]
    assert families(model, f"{line} {data.prose(2, 90)} Licensed under CC BY-NC 4.0. All rights reserved.") == ["MIT", "Apache", "CC-BY-NC", "reserved"]


def test_wrapped_statements(spark):
    texts = [
        "Title\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation",
        "# x\n#\n# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions\n# are met:\n",
        "/*\n * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation, either version 3\n */",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.families, r.first_line) for r in licences.scanned(docs).collect()}
    assert got == {0: ("MIT", 2), 1: ("BSD", 2), 2: ("GPL", 1)}


def test_phrasings_that_are_no_templates():
    model = licences.Model([data.prose(i, 25) for i in range(300)])
    for text, family in (
        ("Licensed under the GNU General Public License, version 3.", "GPL"), ("Distributed under the terms of the GNU General Public License version 2", "GPL"),
        ("MIT License", "MIT"), ("You may use this under the MIT license", "MIT"), ("GNU LESSER GENERAL PUBLIC LICENSE Version 2.1", "LGPL"),
        ("covered by the GNU Affero General Public License v3", "AGPL"), ("Made available under the Eclipse Public License 2.0", "EPL"),
        ("This package uses the ISC license", "ISC"), ("dedicated with CC0 1.0 Universal", "CC0"), ("the 3-clause BSD license applies", "BSD"),
    ):
        assert families(model, text) == [family], (text, families(model, text))


def found(model, text):
    return [(x["family"], x["identifier"]) for x in licences.statements(model, sorted(model.telling), text)]


def test_phrasings_by_family_and_none():
    """Held-out phrasings: none is a template. An opposite or unlisted licence is never reported as an open one."""
    model = licences.Model([data.prose(i, 25) for i in range(400)])
    cases = {
        "Apache": ["Licensed under the Apache License 2.0 (see NOTICE)", "the Apache-2.0 licence", "This file is under the Apache License, Version 2.0, see LICENSE"],
        "MIT": ["License: MIT", "Published under the MIT license", "The MIT License (MIT)", "code is MIT License, docs too"],
        "GPL": ["licensed under GPLv3", "This program is licensed under GPLv2", "under the terms of the GNU General Public License version 2", "the GNU General Public License, v3"],
        "LGPL": ["GNU Lesser General Public License 2.1", "under the GNU Library General Public License version 2"],
        "AGPL": ["GNU Affero General Public License v3", "released under the GNU Affero General Public License"],
        "CC-BY": ["Text is CC BY 4.0", "Content licensed under CC BY 4.0 unless noted", "a Creative Commons Attribution 4.0 International License applies"],
        "CC-BY-SA": ["CC BY-SA 3.0", "articles are CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
        "CC-BY-ND": ["Licensed under CC BY-ND 4.0.", "photos: CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
        "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "data are CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
        "CC-BY-NC-SA": ["Licensed under CC BY-NC-SA 4.0.", "slides CC BY-NC-SA 4.0 only", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
        "CC-BY-NC-ND": ["Licensed under CC BY-NC-ND 4.0.", "CC BY-NC-ND 4.0 applies"],
        "Boost": ["Boost Software License 1.0", "Distributed under the Boost Software License - Version 1.0"],
        "zlib": ["the zlib license", "zlib License terms"],
        "BSD": ["the BSD 3-Clause License", "under a BSD License"], "ISC": ["ISC License"], "EPL": ["Eclipse Public License 2.0"], "MPL": ["Mozilla Public License 2.0"],
        "CC0": ["CC0 1.0 Universal dedication"], "reserved": ["(c) 2020. All rights reserved"],
    }
    for family, texts in cases.items():
        for text in texts:
            assert [f for f, _ in found(model, text)] == [family], (text, found(model, text))
    for text in (*licences.UNLISTED, "Licensed under CC BY-XX", "Artistic License", "under the Sleepycat License", "a license to use the road", "Apache helicopter", "GNU make", "public license plate"):
        assert found(model, text) == [], (text, found(model, text))


def test_identifiers_are_compared_as_a_whole():
    model = licences.Model([data.prose(i, 25) for i in range(300)])
    one = lambda x: found(model, f"// SPDX-License-Identifier: {x}")
    assert one("GPL-2.0-only") == [("GPL", "GPL-2.0-only")] and one("LGPL-2.1-or-later") == [("LGPL", "LGPL-2.1-or-later")]
    assert one("Apache-2.0") == [("Apache", "Apache-2.0")] and one("mit") == [("MIT", "MIT")] and one("CC-BY-NC-SA-4.0") == [("CC-BY-NC-SA", "CC-BY-NC-SA-4.0")]
    assert one("CC-BY-ND-4.0") == [("CC-BY-ND", "CC-BY-ND-4.0")] and one("BSL-1.0") == [("Boost", "BSL-1.0")] and one("GPL-3.0+") == [("GPL", "GPL-3.0+")]
    assert one("Artistic-2.0") == [] and one("MIT-Modern-Variant") == [] and one("CC-BY-NC-XX-4.0") == [] and one("GPL-9.9") == []
    assert one("(MIT OR Apache-2.0)") == [("MIT", "MIT"), ("Apache", "Apache-2.0")]
