"""Licence scan by sentence rules.

A text is cut into sentences: paragraphs (between blank lines) are unwrapped
and split behind ``. ! ? ;`` followed by white space; a sentence that is not
known as a whole is tried line by line, as headings and notices often stand
alone.  A sentence is normalised (lower case, words and dotted numbers only,
comment signs dropped, ``licence`` spelt ``license``) and looked up among known
licence sentences, which give it an identifier.  The sequence of identifiers
is then matched against ordered rules; a rule may have up to ``MAX_GAP``
unknown sentences between its parts, the first rule that fits wins and its
sentences are used up.  Licences go by many names (``GPLv3``, ``GNU GPL v3``,
``New BSD``); a table of names serves notices ("licensed under the ...") and
titles alike.  An SPDX line is parsed as an expression: every licence in it
counts, in order.

Every sentence the patterns accept holds one of ``CRITICAL``'s single words, in
its text as in its normalised form (which only lowers it and drops what stands
between words), so a text without any needs no further look; this loses
nothing.

Defined results: a null or empty text has no licence; repeated rows get the
same result each; only ``doc_id`` and ``text`` are read; an empty table gives no
rows.  Very long texts are read whole, in time proportional to their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_GAP = 3

# Wording of public licences, as patterns over normalised words.
_THIS = r"(?:(?:this|the) (?:work|program|software|file|project|code|library|document|package|article|dataset) is )?"
_UNDER = r"(?:dual )?(?:licensed|released|distributed|available|published|covered) under (?:the terms of )?(?:an? |the )?"
_MORE = r"(?: license)?(?: see .*| which .*| as .*)?"
_V = r"(?: version| v)? ?v?"
#: Names of licences, as patterns over normalised words, and their SPDX ids.
NAMES = [
    ("MIT", r"(?:mit|expat) license"),
    ("ISC", r"isc license"),
    ("Zlib", r"zlib(?: libpng)? license"),
    ("Unlicense", r"unlicense"),
    ("Apache-2.0", r"apache(?: software)?(?: license)?" + _V + r"2(?:\.0)?"),
    ("BSD-3-Clause", r"(?:new|modified|revised) bsd"),
    ("BSD-2-Clause", r"simplified bsd|freebsd license"),
    ("BSD", r"bsd license"),
    ("EPL", r"(?:eclipse public license|epl)" + _V + r"(?P<epl>[12]\.0)"),
    ("EUPL", r"(?:european union public license|eupl)" + _V + r"(?P<eupl>1\.[012])"),
    ("MPL-2.0", r"(?:mozilla public license|mpl)" + _V + r"2(?:\.0)?"),
    ("BSL-1.0", r"boost software license" + _V + r"1\.0"),
    ("GPL", r"(?:gnu )?(?P<letter>[al])?gpl(?: license)?" + _V + r"(?P<number>[123](?:\.[01])?)(?P<upward>(?: or(?: any)? later)?(?: version)?)"),
]
_NAME = "(?:" + "|".join(f"(?P<n{i}>{p})" for i, (_, p) in enumerate(NAMES)) + ")"
SENTENCES = [
    ("spdx", r"spdx license identifier [a-z0-9. ]+"),
    ("apache-title", r"apache license"),
    ("apache-version", r"version 2\.0 january 2004(?: https? .*)?"),
    ("apache-head", r"apache license version 2\.0 january 2004(?: https? .*)?"),
    ("gpl-title", r"gnu (?P<kind>lesser |affero )?general public license"),
    ("gpl-version", r"version (?P<version>[123](?:\.[01])?) (?:[0-9]{1,2} )?(?:june|february|november) [0-9]{4}"),
    ("gpl-head", r"gnu (?P<kind>lesser |affero )?general public license version (?P<version>[123](?:\.[01])?) (?:[0-9]{1,2} )?(?:june|february|november) [0-9]{4}"),
    ("mit", _THIS + _UNDER + r"(?:mit|expat) license"),
    ("mit-grant", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files.*"),
    ("mit-notice", r"the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions of the software"),
    ("as-is", r"(?:the|this) software is provided (?:by the .{1,60} )?as is.*without warranty of any kind.*|this software is provided by .{1,80} as is and any express or implied warranties.*"),
    ("no-liability", r"in no event shall .{1,120} be liable for any .*"),
    ("apache-2.0", _THIS + _UNDER + r"apache license version 2(?:\.0)?(?: the license)?"),
    ("apache-comply", r"you may not use this file except in compliance with the license"),
    ("apache-obtain", r"you may obtain a copy of the license at.*"),
    ("apache-basis", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis.*"),
    ("apache-see", r"see the license for the specific language governing permissions and limitations under the license"),
    ("bsd", _THIS + _UNDER + r"(?P<clauses>[234]) clause bsd license|" + _THIS + _UNDER + r"bsd (?P<clauses2>[234]) clause license"),
    ("bsd-use", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-source", r"(?:1 |a )?redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-binary", r"(?:2 |b )?redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-endorse", r"(?:3 |c )?neither the name of .{1,120} may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("isc-grant", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted.*"),
    ("gpl", _THIS + _UNDER + r"gnu (?P<kind>lesser |affero )?general public license (?:version|v) ?(?P<version>[123](?:\.[01])?)(?P<later> or (?:at your option )?any later version)?"),
    ("gpl-free", r"this (?:program|library|file) is free software you can redistribute it and or modify it under the terms of the gnu (?P<kind>lesser |affero )?general public license as published by the free software foundation either version (?P<version>[123](?:\.[01])?) of the license or at your option (?P<later>any later version)"),
    ("gpl-hope", r"this (?:program|library|file) is distributed in the hope that it will be useful but without any warranty.*"),
    ("gpl-copy", r"you should have received a copy of the gnu (?:lesser |affero )?general public license along with this (?:program|library|file).*"),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public license v ?2\.0|" + _THIS + _UNDER + r"mozilla public license (?:version|v) ?2\.0"),
    ("cc", _THIS + _UNDER + r"(?:creative commons (?:license )?)?(?:cc (?P<terms>by(?: nc)?(?: sa| nd)?|zero)|cc ?(?P<zero>0)) ?(?P<version>[1-4]\.[0-9])?(?: (?:international|universal|unported))?(?: license)?"),
    ("cc-name", _THIS + _UNDER + r"creative commons (?P<terms>attribution(?: noncommercial| non commercial)?(?: sharealike| share alike| noderivatives| no derivatives)?) (?P<version>[1-4]\.[0-9])(?: (?:international|unported))?(?: license)?"),
    ("public-domain", r"this is free and unencumbered software released into the public domain|" + _THIS + r"(?:released into|dedicated to|in) the public domain"),
    ("named", _THIS + _UNDER + _NAME + _MORE),
    ("title", r"(?:the )?" + _NAME + r"(?: license)?(?: (?:mit|isc|zlib))?"),
    ("reserved", r"(?:copyright .{0,80} )?all rights reserved"),
    ("copyright", r"(?:c )?copyright (?:c )?(?:[0-9]{4}.{0,80}|.{1,60} [0-9]{4})"),
]
#: Ordered: longer sequences stand before those they begin with.
RULES = [
    ("MIT", ("title", "copyright", "mit-grant", "mit-notice", "as-is", "no-liability")),
    ("MIT", ("title", "copyright", "mit-grant", "mit-notice", "as-is")),
    ("MIT", ("title", "mit-grant", "mit-notice", "as-is")),
    ("{spdx}", ("spdx",)),
    ("{named}", ("named",)),
    ("{named}", ("title",)),
    ("Apache-2.0", ("apache-title", "apache-version")),
    ("Apache-2.0", ("apache-head",)),
    ("{gpl}", ("gpl-title", "gpl-version")),
    ("{gpl}", ("gpl-head",)),
    ("MIT", ("mit-grant", "mit-notice", "as-is", "no-liability")),
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit",)),
    ("ISC", ("isc-grant", "as-is")),
    ("ISC", ("isc-grant",)),
    ("Apache-2.0", ("apache-2.0", "apache-comply", "apache-obtain", "apache-basis", "apache-see")),
    ("Apache-2.0", ("apache-2.0", "apache-comply", "apache-obtain")),
    ("Apache-2.0", ("apache-2.0",)),
    ("BSD-3-Clause", ("bsd-use", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-use", "bsd-source", "bsd-binary")),
    ("BSD", ("bsd-use",)),
    ("BSD-{clauses}-Clause", ("bsd",)),
    ("{gpl}", ("gpl-free", "gpl-hope", "gpl-copy")),
    ("{gpl}", ("gpl-free", "gpl-hope")),
    ("{gpl}", ("gpl-free",)),
    ("{gpl}", ("gpl",)),
    ("MPL-2.0", ("mpl-2.0",)),
    ("{cc}", ("cc",)),
    ("{cc}", ("cc-name",)),
    ("public-domain", ("public-domain",)),
    ("proprietary", ("reserved",)),
]
CRITICAL = ("licen", "permission", "redistribution", "copyright", "warrant", "liable", "domain", "reserved", "commons", "cc",
            "gpl", "epl", "mpl", "apache", "bsd", "eupl", "gnu", "version")
#: Sentences that never go on in the next line.
LINES = ("spdx", "copyright", "reserved")
# End of the fixed values.

_TABLE = [(name, re.compile(pattern)) for name, pattern in SENTENCES]
_WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
_PLUS = re.compile(r"(?<=[0-9])\+")
_END = re.compile(r"[.!?;](?=\s)|\n[ \t]*(?=\n)")
#: SPDX ids in their own spelling; others stay as written.
SPDX_IDS = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-1.1", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause",
    "BSD-4-Clause", "BSL-1.0", "CC-BY-3.0", "CC-BY-4.0", "CC-BY-SA-3.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC-BY-NC-SA-4.0",
    "CC-BY-ND-4.0", "CC0-1.0", "CDDL-1.0", "EPL-1.0", "EPL-2.0", "EUPL-1.1", "EUPL-1.2", "GPL-1.0-only", "GPL-1.0-or-later",
    "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.0-only", "LGPL-2.0-or-later",
    "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MIT-0", "MPL-1.1", "MPL-2.0", "NCSA",
    "OFL-1.1", "PostgreSQL", "Python-2.0", "Unlicense", "WTFPL", "Zlib",
)
_SPELT = {x.lower(): x for x in SPDX_IDS}
_EXPRESSION = re.compile(r"(?i)spdx-licen[sc]e-identifier:?\s*([A-Za-z0-9.+() -]+)")
_CC = {"attribution": "by", "noncommercial": "nc", "sharealike": "sa", "noderivatives": "nd"}


def normalised(sentence: str) -> str:
    low = _PLUS.sub(" or later ", sentence.lower())
    return " ".join(_WORD.findall(low)).replace("licence", "license")


def spdx_licences(expression: str) -> list[str]:
    """The licences of an SPDX expression, in order; what follows ``WITH`` is an
    exception and none of them.  ``GPL-2.0`` and ``GPL-2.0+`` are old spellings."""
    out, skip = [], False
    for word in re.findall(r"[A-Za-z0-9.+-]+", expression):
        if word.upper() in ("AND", "OR", "WITH"):
            skip = word.upper() == "WITH"
            continue
        if not skip:
            later, name = word.endswith("+"), word.rstrip("+.")
            if re.fullmatch(r"(?i)[al]?gpl-[0-9.]+", name):
                name += "-or-later" if later else "-only"
            out.append(_SPELT.get(name.lower(), name))
        skip = False
    return out


def _may_hold(low: str) -> bool:
    return any(c in low for c in CRITICAL)


def identify(sentence: str) -> tuple[str, dict] | None:
    """Identifier and variable parts of a known sentence."""
    words = normalised(sentence)
    if not _may_hold(words):
        return None
    for name, pattern in _TABLE:
        m = pattern.fullmatch(words)
        if m:
            parts = {k: v for k, v in m.groupdict().items() if v}
            return name, parts | {"expression": sentence} if name == "spdx" else parts
    return None


def _licences(name: str, parts: dict) -> list[str]:
    """What a rule's licence is, given the variable parts of its sentences."""
    if name == "{spdx}":
        found = _EXPRESSION.search(parts["expression"])
        return spdx_licences(found[1]) if found else []
    if name == "{named}":
        return [_named(parts)]
    return [_licence(name, parts)]


def _named(parts: dict) -> str:
    name = next(n for i, (n, _) in enumerate(NAMES) if f"n{i}" in parts)
    if name == "EPL":
        return f"EPL-{parts['epl']}"
    if name == "EUPL":
        return f"EUPL-{parts['eupl']}"
    if name == "GPL":
        kind, version = parts.get("letter", "").upper() + "GPL", parts["number"]
        later = "later" in parts.get("upward", "")
        return f"{kind}-{version if '.' in version else version + '.0'}-{'or-later' if later else 'only'}"
    return name


def _licence(name: str, parts: dict) -> str:
    if name == "{gpl}":
        kind = {"lesser": "LGPL", "affero": "AGPL"}.get(parts.get("kind", "").strip(), "GPL")
        version = parts["version"] if "." in parts["version"] else parts["version"] + ".0"
        return f"{kind}-{version}-{'or-later' if 'later' in parts else 'only'}"
    if name == "{cc}":
        words = parts.get("terms", "zero").replace("non commercial", "noncommercial").replace("share alike", "sharealike").replace("no derivatives", "noderivatives").split()
        terms = "-".join(_CC.get(w, w) for w in words).upper()
        version = parts.get("version", "")
        return f"CC0{'-' + version if version else ''}" if terms == "ZERO" else f"CC-{terms}{'-' + version if version else ''}"
    return name.format(clauses=parts.get("clauses") or parts.get("clauses2"))


def sentences(text: str) -> Iterator[tuple[int, int]]:
    """Begin and end of each sentence."""
    at = 0
    for m in _END.finditer(text):
        yield at, m.end()
        at = m.end()
    if at < len(text):
        yield at, len(text)


def _trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    part = text[a:b]
    return a + len(part) - len(part.lstrip()), b - len(part) + len(part.rstrip())


def known_sentences(text: str) -> list[tuple[str, dict, int, int, int]]:
    """Identifier, variables, begin, end and sentence number, in order."""
    if not _may_hold(text.lower()):
        return []
    out = []
    for number, (a, b) in enumerate(sentences(text)):
        part = text[a:b]
        if not _may_hold(part.lower()):
            continue
        got = identify(part)
        if got and not (got[0] in LINES and "\n" in part.strip()):
            out.append((*got, *_trimmed(text, a, b), number))
            continue
        if "\n" in part:
            at = a
            for line in part.split("\n"):
                got = identify(line)
                if got:
                    out.append((*got, *_trimmed(text, at, at + len(line)), number))
                at += len(line) + 1
    return out


def licences(text: str, max_gap: int = MAX_GAP) -> tuple[list[tuple[str, int, int]], list[str]]:
    """Licences with their spans, and all identifiers, in order."""
    known, out, i = known_sentences(text), [], 0
    while i < len(known):
        for name, ids in RULES:
            part = known[i : i + len(ids)]
            if tuple(p[0] for p in part) != ids:
                continue
            if all(b[4] - a[4] <= max_gap + 1 for a, b in zip(part, part[1:], strict=False)):
                parts = {k: v for p in reversed(part) for k, v in p[1].items()}
                out += [(x, part[0][2], part[-1][3]) for x in _licences(name, parts)]
                i += len(ids)
                break
        else:
            i += 1
    return out, [k[0] for k in known]


def scan(docs: DataFrame, max_gap: int = MAX_GAP) -> DataFrame:
    """``doc_id, licences`` (distinct, in order), ``spans``
    (``licence:start:end``, code points) and ``sentences`` (identifiers),
    comma-joined, of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [licences(t or "", max_gap) for t in batch.column(1).to_pylist()]
            columns = [
                [",".join(dict.fromkeys(name for name, _, _ in found)) for found, _ in got],
                [",".join(f"{name}:{a}:{b}" for name, a, b in found) for found, _ in got],
                [",".join(ids) for _, ids in got],
            ]
            arrays = [batch.column(0), *(pa.array(c, pa.string()) for c in columns)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "licences", "spans", "sentences"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, licences string, spans string, sentences string")
