import random
import re

import pytest

from tradelens.llm import license as L

MIT = """Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction.

The above copyright notice and this permission notice shall be included in
all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED.
"""


@pytest.mark.parametrize(
    "text, want",
    [
        (MIT, ["MIT"]),
        ("words here.\nReleased under the MIT License.\nmore words", ["MIT"]),
        ("a heading without an end\nLicensed under the Apache License, Version 2.0.\nx", ["Apache-2.0"]),
        ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
        ("x. This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0-only"]),
        ("# SPDX-License-Identifier: Apache-2.0\ncode()", ["Apache-2.0"]),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International Licence.", ["CC-BY-SA-4.0"]),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the\nfollowing conditions are met:\n\nNothing known.", ["BSD"]),
        ("I like my driving license. Permission is nice.", []),
        ("", []),
    ],
)
def test_texts(text, want):
    assert [x for x, _, _ in L.licences(text)[0]] == want


def test_spans_and_gaps():
    text = "aé 😀 b.\nReleased under the MIT License.\n\nend"
    ((_, a, b),), _ = L.licences(text)
    assert text[a:b] == "Released under the MIT License."
    far = "Licensed under the Apache License, Version 2.0. " + "Other. " * 9 + "You may not use this file except in compliance with the License."
    assert L.licences(far)[1] == ["apache-2.0", "apache-comply"]
    assert [x for x, _, _ in L.licences(far)[0]] == ["Apache-2.0"]


def test_every_known_sentence_has_a_critical_word():
    # What the patterns accept is built of their literal parts.
    for name, pattern in L.SENTENCES:
        for branch in pattern.split("|" + L._THIS) if "|" in pattern else [pattern]:
            assert any(c in re.sub(r"[\\?:()]", "", branch) for c in L.CRITICAL), name


def accepted(rng, parsed):
    """A random string that a parsed pattern accepts."""
    out = ""
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            out += chr(arg)
        elif op == "ANY":
            out += rng.choice("xyz")
        elif op == "IN":
            kind, value = rng.choice(arg)
            out += chr(value) if str(kind) == "LITERAL" else chr(value[0])
        elif op == "SUBPATTERN":
            out += accepted(rng, arg[3])
        elif op == "BRANCH":
            out += accepted(rng, rng.choice(arg[1]))
        else:
            assert op in ("MAX_REPEAT", "MIN_REPEAT"), op
            low, high, inner = arg
            out += "".join(accepted(rng, inner) for _ in range(rng.randint(low, min(high, low + 3))))
    return out


def test_every_accepted_sentence_is_found_in_any_layout():
    rng = random.Random(8)
    for name, pattern in L.SENTENCES:
        for _ in range(200):
            words = accepted(rng, re._parser.parse(pattern)).split(" ")
            sentence = " ".join(words)
            if L.normalised(sentence) != sentence:
                continue
            between = [" ", "  "] if name in L.LINES else [" ", "  ", "\n", " \n# "]
            text = words[0] + "".join(rng.choice(between) + rng.choice([w, w.upper()]) for w in words[1:])
            assert L.identify(sentence) and L.known_sentences(text), (name, text)


@pytest.mark.parametrize(
    "text, want",
    [
        ("This dataset is available under CC BY 4.0.", ["CC-BY-4.0"]),
        ("This work is distributed under Creative Commons Attribution 4.0 International.", ["CC-BY-4.0"]),
        ("Published under CC0 1.0 Universal.", ["CC0-1.0"]),
        ("Released under CC-0.", ["CC0"]),
        ("This work is released into the public\ndomain.", ["public-domain"]),
        ("Dedicated to the public  domain.", ["public-domain"]),
    ],
)
def test_notices_without_the_word_licence(text, want):
    assert [x for x, _, _ in L.licences(text)[0]] == want


def test_scan(spark):
    rows = [(1, "Released under the MIT License.", "x"), (2, None, "x"), (3, "", "x"), (1, "Released under the MIT License.", "x"), (None, "w " * 90_000, "x")]
    got = L.scan(spark.createDataFrame(rows, "doc_id long, text string, licences string")).collect()
    assert sorted((r.doc_id or 0, r.licences, r.spans, r.sentences) for r in got) == [
        (0, "", "", ""), (1, "MIT", "MIT:0:31", "mit"), (1, "MIT", "MIT:0:31", "mit"), (2, "", "", ""), (3, "", "", "")
    ]
    assert L.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize(
    "text, want",
    [
        ("This project is licensed under the MIT License - see the LICENSE file for details.", ["MIT"]),
        ("MIT License", ["MIT"]),
        ("The MIT License (MIT)\n\n" + MIT, ["MIT"]),
        ("Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/", ["Apache-2.0"]),
        ("Licensed under the GPLv3.", ["GPL-3.0-only"]),
        ("GNU GPL v3", ["GPL-3.0-only"]),
        ("Released under the LGPL-2.1+.", ["LGPL-2.1-or-later"]),
        ("Distributed under the GNU AGPL v3 or later.", ["AGPL-3.0-or-later"]),
        ("GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n", ["GPL-3.0-only"]),
        ("GNU LESSER GENERAL PUBLIC LICENSE\n\nVersion 2.1, February 1999", ["LGPL-2.1-only"]),
        ("ISC License", ["ISC"]),
        ("This software is available under the zlib license.", ["Zlib"]),
        ("Licensed under the Eclipse Public License v2.0.", ["EPL-2.0"]),
        ("Licensed under the EUPL 1.2.", ["EUPL-1.2"]),
        ("This file is available under the BSD license.", ["BSD"]),
        ("Released under the New BSD License.", ["BSD-3-Clause"]),
        ("// SPDX-License-Identifier: gpl-3.0-or-later", ["GPL-3.0-or-later"]),
        ("# SPDX-License-Identifier: LGPL-2.1-only", ["LGPL-2.1-only"]),
        ("SPDX-License-Identifier: (Apache-2.0 OR MIT) AND GPL-2.0+ WITH Classpath-exception-2.0", ["Apache-2.0", "MIT", "GPL-2.0-or-later"]),
        ("The simple example may replace version 2 of the apache.", []),
        ("Our GNU herd, version 3, ran in June 2007.", []),
    ],
)
def test_names_titles_and_expressions(text, want):
    assert [x for x, _, _ in L.licences(text)[0]] == want


def test_rules_equal_a_plain_reading(spark):
    """The scan against a reading that has no prefilter and tries every rule on
    every place: known sentences as they are, rules by plain search."""
    rng = random.Random(3)
    pieces = [MIT, "MIT License", "Plain words here.", "Licensed under the GPLv3.", "# SPDX-License-Identifier: MIT OR ISC",
              "Apache License\nVersion 2.0, January 2004", "Copyright 2020 A B", "All rights reserved.", "x " * 40 + "."]

    def plain(text):
        ids = []
        for number, (a, b) in enumerate(L.sentences(text)):
            whole = L.identify(text[a:b])
            if whole and not (whole[0] in L.LINES and "\n" in text[a:b].strip()):
                ids.append((*whole, number))
            else:
                ids += [(*got, number) for line in text[a:b].split("\n") if (got := L.identify(line))] if "\n" in text[a:b] else []
        out, i = [], 0
        while i < len(ids):
            for name, rule in L.RULES:
                part = ids[i : i + len(rule)]
                if [p[0] for p in part] == list(rule) and all(y[2] - x[2] <= L.MAX_GAP + 1 for x, y in zip(part, part[1:])):
                    out += L._licences(name, {k: v for p in reversed(part) for k, v in p[1].items()})
                    i += len(rule) - 1
                    break
            i += 1
        return ",".join(dict.fromkeys(out))

    rows = [(i, "\n\n".join(rng.choice(pieces) for _ in range(rng.randint(0, 7)))) for i in range(200)]
    got = {r.doc_id: r.licences for r in L.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: plain(t) for i, t in rows} and sum(map(bool, got.values())) > 100
