"""Licences by rules over the sentences of a text.

Wrapped lines are joined: marks of comments before a line are taken off, and a single line
break is a space. A sentence ends at a full stop, exclamation or question mark or semicolon
before white space (but for abbreviations that go on in lower case), at an empty line, before an item of a list, and around an SPDX tag. A
sentence that is not known is looked at by its parts between colons, and a part that is not
known by its lines, as headings and notices often end without a mark.

Sentences are normalised: A-Z in lower case, anything but letters, digits, dots and plus
signs a space, American spelling, no subject ("this project is"), one verb for "released
under the terms of" and its like, any holder's name the same. Known ones get their
identifier; others are a gap. The sequence of a text is then matched against the rules in
their order: the first rule takes all its occurrences out of the sequence, then the next,
so that longer statements come before the single sentences they contain. Sentences of a
rule have to follow each other without a gap. Last, a sentence ``L:part`` that no rule has
taken stands for the licence L alone.

Native expressions only, no shuffle: sentences and rules are fixed tables. Texts without
one of the words that all known sentences have are not cut. Null and empty texts have no
sentence. Every row is judged for itself; texts are used whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Identifiers of licences.
IDENTIFIERS = """
    0BSD AFL-3.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause
    BSL-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0
    ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.2 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later ISC
    LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0 MPL-1.1 MPL-2.0
    MS-PL MulanPSL-2.0 NCSA ODbL-1.0 OFL-1.1 PostgreSQL PSF-2.0 Python-2.0 Unlicense UPL-1.0 WTFPL Zlib
""".split()
# Names in full, with the version as it is written there.
NAMES = [
    ("AGPL-3.0", "gnu affero general public license", "3"),
    ("Apache-2.0", "apache license", "2.0"),
    ("Artistic-2.0", "artistic license", "2.0"),
    ("BSL-1.0", "boost software license", "1.0"),
    ("CC-BY-4.0", "creative commons attribution", "4.0 international license"),
    ("CC-BY-SA-4.0", "creative commons attribution sharealike", "4.0 international license"),
    ("CC-BY-NC-4.0", "creative commons attribution noncommercial", "4.0 international license"),
    ("CC0-1.0", "cc0", "1.0 universal"),
    ("EPL-1.0", "eclipse public license", "1.0"),
    ("EPL-2.0", "eclipse public license", "2.0"),
    ("GPL-2.0", "gnu general public license", "2"),
    ("GPL-3.0", "gnu general public license", "3"),
    ("LGPL-2.1", "gnu lesser general public license", "2.1"),
    ("LGPL-3.0", "gnu lesser general public license", "3"),
    ("MPL-2.0", "mozilla public license", "2.0"),
]
# Sentences of public licence texts and notices.
TEXTS = {
    "MIT:grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "MIT-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "MIT-warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "MIT-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "ISC:grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "ISC-warranty": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "BSD-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "BSD-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "BSD-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "BSD-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "Apache-2.0:grant": "licensed under the apache license version 2.0 the license",
    "Apache-2-comply": "you may not use this file except in compliance with the license",
    "GPL-free": "this program is free software",
    "MPL-2.0:form": "this source code form is subject to the terms of the mozilla public license v 2.0",
    "EPL-2.0:grant": "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 which is available at https www.eclipse.org legal epl 2.0",
    "EPL-1.0:grant": "this program and the accompanying materials are made available under the terms of the eclipse public license v1.0 which accompanies this distribution",
    "Zlib-warranty": "this software is provided as is without any express or implied warranty",
    "Zlib:grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "BSL-1.0:grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    "CC0-1.0:dedication": "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
    "Unlicense:free": "this is free and unencumbered software released into the public domain",
}
# Licences by sequences of sentences, in the order in which they are tried.
RULES = [
    ("MIT", ["MIT:grant", "MIT-notice", "MIT-warranty", "MIT-liability"]),
    ("MIT", ["MIT:named", "MIT:grant"]),
    ("MIT", ["MIT:grant", "MIT-notice"]),
    ("ISC", ["ISC:grant", "ISC-warranty"]),
    ("BSD-3-Clause", ["BSD-grant", "BSD-source", "BSD-binary", "BSD-names"]),
    ("BSD-2-Clause", ["BSD-grant", "BSD-source", "BSD-binary"]),
    ("Apache-2.0", ["Apache-2.0:grant", "Apache-2-comply"]),
    *[(f"{g}-{x}", ["GPL-free", f"{g}-{x}:grant"]) for g in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for x in ("or-later", "only")],
]
ALONE = "<([^<>:]+):[^<>]*>"
# Every known sentence has one of these.
ANCHORS = "(?i)licen|copyright|permission|redistribut|warrant|unencumbered|software|spdx|(?:released|distributed|available|published|provided)[^A-Z]+under"
SHORTEST = 4  # what is shorter is the number of a clause and no gap
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# How a text is laid out anew before it is cut: line ends, marks of comments, items of lists, abbreviations, tags.
LAYOUT = [
    (r"\x0D\x0A?|[\x0B\x0C]", "\n", "\n"),
    (r"""\n[\x20\x09]*(?:<!--|--+|[/*#%;>"]+)[\x20\x09]*""", "\n", "\n"),
    (r"\n[\x20\x09]*(?:[0-9]{1,2}[.)]|\([0-9a-z]\)|[a-z][.)]|[-•])[\x20\x09]+", "\n\n", "\n\n"),
    (r"\b((?i:inc|ltd|llc|corp|co|v))\.([\x20\x09\n]+[a-z0-9])", "$1$2", "\\1\\2"),
    (r"(?i)(SPDX[A-Z-]*:[^\n]*)", "\n\n$1\n\n", "\n\n\\1\n\n"),
]
CUT = r"[.!?;]+[\x20\x09\n]+|\n[\x20\x09]*\n[\x20\x09\n]*"
COLON = r":[\x20\x09\n]+"
# How a sentence in lower case is normalised, in this order.
FOLDS = [
    ("[^a-z0-9.+]+", " "),
    ("licence", "license"),
    ("^[ .]+|[ .]+$", ""),
    ("^(?:this|the|our|all|it)(?: [a-z]+){0,5}? (?:is|are) ", ""),
    ("^(?:distributed|released|available|made available|published|provided) under ", "licensed under "),
    ("^licensed under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?", "licensed under "),
    ("^neither the name of (?:[a-z0-9.+]+ ){1,12}?nor the names of its contributors ", "neither the name of the copyright holder nor the names of its contributors "),
]


def _folded(sentence: str) -> str:
    sentence = sentence.lower()
    for pattern, new in FOLDS:
        sentence = re.sub(pattern, new, sentence)
    return sentence


def _sentences() -> dict[str, str]:
    """Normalised sentences with their identifiers; those by a rule before those of ``TEXTS``."""
    told = {}
    for name in IDENTIFIERS:
        told |= {f"spdx license identifier {name}": f"{name}:spdx", f"spdx {name}": f"{name}:spdx"}
        told |= {f"licensed under {name}": f"{name}:named", f"licensed under {name} license": f"{name}:named"}
    for name, long, version in NAMES:
        for form in ("{} version {}", "{} v{}", "{} v {}", "{} {}"):
            told["licensed under " + form.format(long, version)] = f"{name}:named"
        if "GPL" in name:
            start, by = f"you can redistribute it and or modify it under the terms of the {long}", "as published by the free software foundation"
            told[f"{start} {by} either version {version} of the license or at your option any later version"] = f"{name}-or-later:grant"
            told[f"{start} version {version} {by}"] = f"{name}-only:grant"
            told[f"{start} {by} version {version} of the license"] = f"{name}-only:grant"
            told[f"licensed under {long} version {version} or later"] = f"{name}-or-later:named"
    told |= {text: name for name, text in TEXTS.items()}
    return {_folded(text): name for text, name in told.items()}


SENTENCES = _sentences()


def normalised(sentence: Column) -> Column:
    out = F.translate(sentence, UPPER, LOWER)
    for pattern, new in FOLDS:
        out = F.regexp_replace(out, pattern, new)
    return out


def recognised(text: Column) -> Column:
    """Sequence of a text: ``<id>`` for each known sentence, ``<->`` for others in a row."""
    known = F.create_map(*[F.lit(x) for s, k in SENTENCES.items() for x in (s, f"<{k}>")])
    laid = F.concat(F.lit("\n"), text)
    for pattern, new, _ in LAYOUT:
        laid = F.regexp_replace(laid, pattern, new)

    def line(x: Column) -> Column:
        plain = normalised(x)
        return F.coalesce(F.try_element_at(known, plain), F.when(F.length(plain) >= SHORTEST, "<->").otherwise(""))

    def part(x: Column) -> Column:
        return F.coalesce(F.try_element_at(known, normalised(x)), F.array_join(F.transform(F.split(x, "\n", -1), line), ""))

    def sentence(x: Column) -> Column:
        return F.coalesce(F.try_element_at(known, normalised(x)), F.array_join(F.transform(F.split(x, COLON, -1), part), ""))

    told = F.array_join(F.transform(F.split(laid, CUT, -1), sentence), "")
    return F.regexp_replace(told, "(?:<->)+", "<->")


def find_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row ``key``, the known ``sentences`` and the ``licenses`` in order, and how many sentences no rule took."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    sequence = F.when(F.rlike(body, F.lit(ANCHORS)), recognised(body)).otherwise("")
    rows = docs.select(F.col(f"`{key}`"), sequence.alias("__sequence"))
    left = F.col("__sequence")
    for name, rule in RULES:
        left = F.replace(left, F.lit("".join(f"<{s}>" for s in rule)), F.lit(f"{{{name}}}"))
    rows = rows.withColumn("__left", F.regexp_replace(left, ALONE, "{$1}"))
    every = lambda c, p: F.regexp_extract_all(F.col(c), F.lit(p), F.lit(1))
    return rows.select(
        F.col(f"`{key}`"),
        F.array_join(every("__sequence", "<([^<>-][^<>]*)>"), ",").alias("sentences"),
        F.array_join(F.array_distinct(every("__left", r"\{([^{}]*)\}")), ",").alias("licenses"),
        F.size(every("__left", "<([^<>-][^<>]*)>")).cast("long").alias("n_left"),
    )


def license_sql() -> str:
    """The same for DuckDB: sentences, parts and lines as rows that are joined with the known ones."""
    escape = lambda x: "'" + x.replace("'", "''") + "'"
    known = ", ".join(f"('{s}', '<{k}>')" for s, k in SENTENCES.items())
    left = "sequence"
    for name, rule in RULES:
        left = f"replace({left}, '{''.join(f'<{s}>' for s in rule)}', '{{{name}}}')"
    laid = "chr(10) || text"
    for pattern, _, new in LAYOUT:
        laid = f"regexp_replace({laid}, {escape(pattern)}, {escape(new)}, 'g')"

    def plain(x: str) -> str:
        out = f"translate({x}, '{UPPER}', '{LOWER}')"
        for pattern, new in FOLDS:
            out = f"regexp_replace({out}, {escape(pattern)}, {escape(new)}, 'g')"
        return out

    def cut(x: str, at: str) -> str:
        return f"unnest(string_split_regex({x}, {escape(at)})) AS {{}}, generate_subscripts(string_split_regex({x}, {escape(at)}), 1) AS {{}}"

    return f"""
WITH rows AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
laid AS (SELECT r, {laid} AS text FROM rows WHERE regexp_matches(text, '{ANCHORS}')),
known(s, id) AS (VALUES {known}),
sentences AS (SELECT r, {cut("text", CUT).format("x", "i")} FROM laid),
parts AS (SELECT r, i, x, {cut("x", COLON).format("y", "j")} FROM sentences),
lines AS (SELECT r, i, j, x, y, {cut("y", chr(10)).format("z", "k")} FROM parts),
plain AS (SELECT r, i, j, k, {plain("x")} AS x, {plain("y")} AS y, {plain("z")} AS z FROM lines),
told AS (
    SELECT r, string_agg(CASE
        WHEN a.id IS NOT NULL THEN CASE WHEN j = 1 AND k = 1 THEN a.id ELSE '' END
        WHEN b.id IS NOT NULL THEN CASE WHEN k = 1 THEN b.id ELSE '' END
        WHEN c.id IS NOT NULL THEN c.id
        WHEN length(z) >= {SHORTEST} THEN '<->' ELSE '' END, '' ORDER BY i, j, k) AS sequence
    FROM plain LEFT JOIN known a ON x = a.s LEFT JOIN known b ON y = b.s LEFT JOIN known c ON z = c.s GROUP BY r
),
taken AS (SELECT doc_id, regexp_replace(coalesce(sequence, ''), '(?:<->)+', '<->', 'g') AS sequence FROM rows LEFT JOIN told USING (r)),
matched AS (SELECT doc_id, sequence, regexp_replace({left}, '{ALONE}', '{{\\1}}', 'g') AS remains FROM taken),
found AS (SELECT *, regexp_extract_all(remains, '\\{{([^{{}}]*)\\}}', 1) AS names FROM matched)
SELECT doc_id, array_to_string(regexp_extract_all(sequence, '<([^<>-][^<>]*)>', 1), ',') AS sentences,
    coalesce(array_to_string(list_filter(names, lambda x, k: list_position(names, x) = k), ','), '') AS licenses,
    CAST(len(regexp_extract_all(remains, '<([^<>-][^<>]*)>', 1)) AS BIGINT) AS n_left
FROM found
"""
