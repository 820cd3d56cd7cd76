"""Licence scans by sentence rules, in Spark expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices, as words and digits in lower case.
SENTENCES = {
    1: "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    2: "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    3: "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    4: "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    5: "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    6: "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    7: "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    8: "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    9: "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    10: "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    11: "this is free and unencumbered software released into the public domain",
    12: "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    13: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    14: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    15: "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    16: "this source code form is subject to the terms of the mozilla public license v",
    17: "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    18: "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    20: "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    21: "boost software license version 1 0",
}
# Short notices that name a licence by themselves.
NOTICES = {
    "Apache-2.0": ("licensed under the apache license version 2 0", "spdx license identifier apache 2 0"),
    "MIT": ("released under the mit license", "licensed under the mit license", "this project is licensed under the mit license", "spdx license identifier mit"),
    "GPL-3.0": ("this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3", "spdx license identifier gpl 3 0 only", "spdx license identifier gpl 3 0 or later"),
    "GPL-2.0": ("this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2", "spdx license identifier gpl 2 0 only", "spdx license identifier gpl 2 0 or later"),
    "MPL-2.0": ("licensed under the mozilla public license version 2 0", "spdx license identifier mpl 2 0"),
    "BSD-2-Clause": ("licensed under the bsd 2 clause license", "spdx license identifier bsd 2 clause"),
    "BSD-3-Clause": ("licensed under the bsd 3 clause license", "spdx license identifier bsd 3 clause"),
    "ISC": ("licensed under the isc license", "spdx license identifier isc"),
}
# Each rule is a licence and the sentences it has, in order, with no other known one between.
RULES = (
    ("MIT", (1, 2, 3)),
    ("BSD-3-Clause", (4, 5, 6, 7)),
    ("BSD-2-Clause", (4, 5, 6, 8)),
    ("ISC", (9, 10)),
    ("Unlicense", (11, 12)),
    ("GPL-2.0", (13, 15)),
    ("GPL-3.0", (14, 15)),
    ("MPL-2.0", (16, 17)),
    ("Apache-2.0", (18, 20)),
    ("BSL-1.0", (21,)),
)


def _creative_commons() -> dict[str, tuple[str, ...]]:
    """Notices of the licence family, by its rule: parts, then version."""
    out = {}
    for parts in ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd"):
        for version in ("3 0", "4 0"):
            name = f"cc {parts} {version}"
            out[f"CC-{parts.upper().replace(' ', '-')}-{version.replace(' ', '.')}"] = (f"licensed under {name}", f"this work is licensed under {name}", f"spdx license identifier {name}")
    return out


def known() -> tuple[dict[str, int], list[tuple[str, tuple[int, ...]]]]:
    """Sentence -> identifier, and all rules: those of texts first, then one for each notice."""
    ids, rules = {s: i for i, s in SENTENCES.items()}, list(RULES)
    for name, notices in chain(NOTICES.items(), _creative_commons().items()):
        for notice in notices:
            ids[notice] = len(ids) + 100
            rules.append((name, (ids[notice],)))
    return ids, rules


# A known sentence has one of these words; a text without any has none, however its case.
HINT = "(?i)licen[sc]e|software|permission|redistribut|warrant|mozilla|mpl"
UNIT = "\x01"


def _units(text: Column, lines: bool) -> Column:
    """A text's units: up to the end of a sentence; and up to that of a line, or of a paragraph."""
    marked = F.regexp_replace(text, r"([.!?])[ \t\f\r\n]+", "$1" + UNIT)
    return F.split(F.regexp_replace(marked, r"\n" if lines else r"\n[ \t\f\r]*\n", UNIT), UNIT, -1)


def _normal(unit: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(unit, r"[^A-Za-z0-9]+", " ")))


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, license, first_sentence, n_sentences): one row for each licence recognised in a document.

    The whole text is cut into sentences, once with line breaks as ends and once
    with wrapped lines joined. Each sentence, reduced to lower-case words, is looked
    up; the identifiers found, in order, are matched against the rules. A rule
    holds where its identifiers stand one after another with no other known
    sentence between them; unknown text may lie between. ``first_sentence`` is the
    unit in which the licence is first complete from, counted from 0 (by lines
    if that way found it), ``n_sentences`` the length of the longest rule that held.

    No shuffle: each document is scanned by itself. Null or empty text: no rows.
    Rows that repeat an id, and those of a null id, share their licences. Empty
    table: no rows.
    """
    ids, rules = known()
    lookup = F.create_map(*(F.lit(x) for pair in ids.items() for x in pair))
    names = sorted({name for name, _ in rules})
    hinted = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).filter(F.col("text").rlike(HINT))
    ways = hinted.select("doc_id", F.explode(F.array(*(F.struct(F.lit(i).alias("way"), _units(F.col("text"), i == 0).alias("units")) for i in (0, 1)))).alias("u")).select("doc_id", "u.*")
    seen = F.transform("units", lambda x, i: F.struct(F.try_element_at(lookup, _normal(x)).alias("id"), i.alias("at")))
    ways = ways.select("doc_id", "way", F.filter(seen, lambda s: s["id"].isNotNull()).alias("seen")).filter(F.size("seen") > 0)
    ways = ways.select("doc_id", "way", "seen", F.concat(F.lit(","), F.array_join(F.transform("seen", lambda s: s["id"].cast("string")), ","), F.lit(",")).alias("sequence"))

    def held(rule: tuple[int, ...]) -> Column:
        wanted = "," + ",".join(map(str, rule)) + ","
        before = F.substring_index("sequence", wanted, 1)  # a comma stands before each identifier
        place = F.length(before) - F.length(F.replace(before, F.lit(","), F.lit("")))
        return F.when(F.contains("sequence", F.lit(wanted)), F.struct(F.lit(len(rule)).alias("n"), F.get(F.col("seen"), place)["at"].alias("at")))

    found = F.array(*(F.struct(F.lit(names.index(name)).alias("name"), held(rule).alias("held")) for name, rule in rules))
    matches = ways.select("doc_id", "way", F.explode(F.filter(found, lambda m: m["held"].isNotNull())).alias("m"))
    matches = matches.select("doc_id", "way", F.element_at(F.array(*map(F.lit, names)), F.col("m.name") + 1).alias("license"), F.col("m.held.n").alias("n"), F.col("m.held.at").alias("at"))
    best = matches.groupBy("doc_id", "license").agg(F.min(F.struct((-F.col("n")).alias("n"), "way", "at")).alias("b"))
    return best.select("doc_id", "license", F.col("b.at").alias("first_sentence"), (-F.col("b.n")).alias("n_sentences"))


def sql() -> str:
    """The same in SQL."""
    ids, rules = known()
    sentences = ", ".join(f"({i}, '{s}')" for s, i in ids.items())
    wanted = ", ".join(f"('{name}', ',{','.join(map(str, rule))},', {len(rule)})" for name, rule in rules)
    space = r"[ \t\f\r]*"
    return f"""
WITH known(id, sentence) AS (VALUES {sentences}), rules(license, wanted, n) AS (VALUES {wanted}),
ways AS (
  SELECT doc_id, w AS way, string_split(regexp_replace(regexp_replace(text, '([.!?])[ \\t\\f\\r\\n]+', '\\1' || chr(1), 'g'),
    CASE WHEN w = 0 THEN '\\n' ELSE '\\n{space}\\n' END, chr(1), 'g'), chr(1)) AS units
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents WHERE regexp_matches(text, '{HINT}')), range(2) AS t(w)),
u AS (SELECT doc_id, way, unnest(units) AS unit, unnest(range(len(units))) AS place FROM ways),
seen AS (SELECT doc_id, way, place, id FROM u JOIN known ON sentence = trim(lower(regexp_replace(unit, '[^A-Za-z0-9]+', ' ', 'g')))),
s AS (SELECT doc_id, way, list(place ORDER BY place) AS places, ',' || string_agg(CAST(id AS VARCHAR), ',' ORDER BY place) || ',' AS sequence FROM seen GROUP BY doc_id, way),
m AS (
  SELECT doc_id, way, license, n, places[len(split_part(sequence, wanted, 1)) - len(replace(split_part(sequence, wanted, 1), ',', '')) + 1] AS place
  FROM s JOIN rules ON contains(sequence, wanted)),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id, license ORDER BY n DESC, way, place) AS k FROM m)
SELECT doc_id, license, CAST(place AS INT) AS first_sentence, n AS n_sentences FROM b WHERE k = 1
"""
