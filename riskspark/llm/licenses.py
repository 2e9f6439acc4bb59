"""Licence recognition by known sentences and ordered rules over their identifiers."""

from __future__ import annotations

import re
from collections import Counter
from functools import cache

from pyspark.sql import Column, DataFrame, functions as F

from riskspark.llm import license_table
from riskspark.llm.common import id_and_text, materialize

# Sentences of public licence texts and of common notices, by identifier.
SENTENCES = {
    "mit-title": "MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-keep": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "mit-released": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-advert": "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "bsd-product": "This product includes software developed by",
    "bsd-name-other": "Neither the name of",
    "bsd-name-rest": "nor the names of its contributors may be used to endorse or promote products",
    "bsd-name": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "apache-under": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-obtain": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-free": "This program is free software;",
    "gpl2-modify": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;",
    "gpl2-version": "either version 2 of the License, or (at your option) any later version.",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl2-work": "This work is licensed under the GNU General Public License, version 2.",
    "mpl-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense-domain": "This is free and unencumbered software released into the public domain.",
    "cc-by": "Licensed under CC BY 4.0.",
    "cc-by-sa": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "cc-by-nd": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-sa": "Licensed under CC BY-NC-SA 4.0.",
    "cc-zero": "Licensed under CC0 1.0.",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-apache": "SPDX-License-Identifier: Apache-2.0",
    "spdx-gpl3": "SPDX-License-Identifier: GPL-3.0-only",
    "rights-reserved": "All rights reserved.",
}
# Licence and the identifiers that show it, in order. Earlier rules go first and
# take their sentences with them, so a full text is not also reported as its part.
RULES: list[tuple[str | None, list[str]]] = [
    ("MIT", ["mit-grant", "mit-keep", "mit-warranty", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-keep", "mit-warranty"]),
    ("MIT", ["mit-released"]),
    ("MIT", ["mit-licensed"]),
    ("MIT", ["spdx-mit"]),
    ("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-product", "bsd-name"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name"]),
    # a name such as "Example, Inc." ends the sentence early
    ("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-product", "bsd-name-other", "bsd-name-rest"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name-other", "bsd-name-rest"]),
    (None, ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name-other"]),  # a third clause of unknown wording
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("ISC", ["isc-grant"]),
    ("Apache-2.0", ["apache-under", "apache-comply", "apache-obtain"]),
    ("Apache-2.0", ["apache-under", "apache-comply"]),
    ("Apache-2.0", ["apache-notice"]),
    ("Apache-2.0", ["spdx-apache"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("GPL-2.0-or-later", ["gpl2-free", "gpl2-modify", "gpl2-version"]),
    ("GPL-3.0-only", ["gpl3-work"]),
    ("GPL-3.0-only", ["spdx-gpl3"]),
    ("GPL-2.0-only", ["gpl2-work"]),
    ("MPL-2.0", ["mpl-subject"]),
    ("Unlicense", ["unlicense-domain"]),
    ("CC-BY-4.0", ["cc-by"]),
    ("CC-BY-SA-4.0", ["cc-by-sa"]),
    ("CC-BY-NC-4.0", ["cc-by-nc"]),
    ("CC-BY-ND-4.0", ["cc-by-nd"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa"]),
    ("CC0-1.0", ["cc-zero"]),
    ("all-rights-reserved", ["rights-reserved"]),
]
# Lines that are a sentence however they end.
OWN_LINE = r"(?im)^[ \t/*#-]*((?:copyright|\(c\)|spdx-license-identifier|(?:the )?mit license(?: \(mit\))?)\b[^\n]*)$"
SPLIT = r"(?<=[.!?;])\s+|(?<=:)[ \t]*\n\s*|\n[ \t]*\n\s*|\x01\s*"
GAP = 2  # unknown sentences allowed between two sentences of a rule


# the expression of an identifier line, without what closes a comment
EXPRESSION = r"(?im)^[^a-z\n]*spdx-license-identifier[ \t]*:[ \t]*([^\s*>][^\n]*?)[ \t]*(?:\*+/|-->|#+\}|\*\))?[ \t\r]*$"
SPDX = r"(?is)^[^a-z]*spdx-license-identifier\s*:(.*)$"
WINDOWS = 3  # places of a full text, of three sentences each, that show it


AND_LATER = r"(?<=[0-9])[+](?![0-9a-z+])"  # "GPLv2+"


def normalise(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", re.sub(AND_LATER, " or later", sentence.lower())).strip()


def _normalised(c: Column) -> Column:
    c = F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), AND_LATER, " or later"), "[^a-z0-9]+", " "))
    for pattern, plain in license_table.FIELDS:
        c = F.regexp_replace(c, pattern, plain)
    return c


def _identifiers(c: Column) -> Column:
    """One sentence per identifier of an SPDX expression; other sentences as they are."""
    parts = F.split(F.regexp_replace(F.regexp_extract(c, SPDX, 1), r"[+](?=[\s)]|$)", "-or-later"), r"(?i)\s+(?:and|or|with)\s+")
    return F.when(c.rlike(SPDX), F.transform(parts, lambda p: F.concat(F.lit("SPDX-License-Identifier: "), p))).otherwise(F.array(c))


def sentences(text: Column) -> Column:
    """Normalised sentences in order; bare numbers and letters of lists are no sentences."""
    marked = F.regexp_replace(F.concat(text, F.lit("\n")), OWN_LINE, "\x01$1\x01")
    split = F.flatten(F.transform(F.split(marked, SPLIT), _identifiers))
    return F.filter(F.transform(split, _normalised), lambda s: F.length(s) > 2)


def plain_sentences(text: str) -> list[str]:
    """``sentences`` of a licence text, without Spark."""
    marked = re.sub(OWN_LINE, "\x01\\1\x01", text + "\n")
    return [n for part in re.split(SPLIT, marked) if len(n := license_table.canonical(normalise(part))) > 2]


@cache
def knowledge() -> tuple[dict[str, str], list[tuple[str | None, list[str]]]]:
    """Normalised sentence -> identifier, and all rules: those above, then the licence table."""
    known = {license_table.canonical(normalise(s)): k for k, s in SENTENCES.items()}
    rules = list(RULES)
    seen = {tuple(ids) for _, ids in rules}

    def add(name: str | None, parts: list[str], label: str) -> None:
        ids = [known.setdefault(license_table.canonical(normalise(p)), f"{label}-{len(known)}") for p in parts]
        if tuple(ids) not in seen:
            seen.add(tuple(ids))
            rules.append((name, ids))

    for name, parts in license_table.notices():
        add(name, parts, name.lower())
    for spdx in license_table.spdx_ids():
        name = license_table.current(spdx)
        add(name, ["SPDX-License-Identifier: " + spdx.replace("+", "-or-later")], "spdx-" + spdx.lower())
        if not spdx.endswith(("+", "-or-later", "-only")):
            later = spdx + "-or-later" if name != spdx else spdx + "+"
            add(later, [f"SPDX-License-Identifier: {spdx}-or-later"], f"spdx-{spdx.lower()}-or-later")
    full = {name: plain_sentences(text) for name, text in license_table.texts().items()}
    holders = Counter(s for parts in full.values() for s in set(parts))
    for name, parts in full.items():
        for s in parts:
            if s.count(" ") >= 3:  # headings and broken-off words also stand in other prose
                known.setdefault(s, f"{name.lower()}-text-{len(known)}")
        # neighbours that no other text and no notice holds
        own = [i for i in range(len(parts) - 2) if all(
            holders[s] == 1 and "-text-" in known.get(s, "") for s in parts[i : i + 3])]
        for k in range(min(WINDOWS, len(own))):
            i = own[k * (len(own) - 1) // max(1, WINDOWS - 1)]
            add(license_table.current(name), parts[i : i + 3], name.lower())
    # longer rules of the table before their parts
    table = rules[len(RULES):]
    return known, RULES + sorted(table, key=lambda r: -len(r[1]))


def licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: dict[str, str] | None = None,
             rules: list[tuple[str, list[str]]] | None = None, gap: int = GAP) -> DataFrame:
    """Per document: doc_id, n_sentences, n_known, sentence_ids (comma-joined, in order),
    licenses (distinct, sorted, comma-joined) and expressions (those of identifier lines as they stand, with
    operators and exceptions; distinct, sorted).

    Sentences end at ``.!?;`` before white space, at a colon that ends its line, at blank lines, and around copyright and
    identifier lines; they compare by lower-case ASCII letters and digits only. A rule matches
    where its identifiers follow one another with at most ``gap`` other sentences between two
    neighbours. The sentence table is a constant of the library, so its broadcast is bounded; each
    identifier of an SPDX expression counts as a sentence.

    Null and empty texts have no sentences; repeated rows are reported each; null ids stay
    null; an empty table gives no rows; extra columns are ignored.
    """
    spark = docs.sparkSession
    held, all_rules = knowledge()
    if known is not None:
        held = {license_table.canonical(normalise(s)): k for k, s in known.items()}
    rules = all_rules if rules is None else rules
    # a sentence that is a rule of its own and in no other needs no order
    uses = Counter(i for _, ids in rules for i in ids)
    alone = {ids[0]: name for name, ids in rules if len(ids) == 1 and uses[ids[0]] == 1}
    rules = [r for r in rules if len(r[1]) > 1 or r[1][0] not in alone]
    table = spark.createDataFrame([(s, k, alone.get(k)) for s, k in held.items()], "sentence string, sid string, alone string")
    split = id_and_text(docs, id_col, text_col).select(
        "doc_id", F.xxhash64("doc_id", "text").alias("row"), sentences(F.col("text")).alias("s"),
        F.array_sort(F.array_distinct(F.regexp_extract_all("text", F.lit(EXPRESSION), 1))).alias("expressions"))
    marker = F.array(F.struct(F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("sentence")))
    numbered = F.transform(F.col("s"), lambda s, i: F.struct(i.alias("pos"), s.alias("sentence")))
    found = materialize(
        split.select("doc_id", "row", F.size("s").alias("n_sentences"), "expressions", F.inline(F.concat(marker, numbered)))
        .withColumn("expressions", F.when(F.col("pos") == -1, F.col("expressions")))  # on the marker row alone
        .join(F.broadcast(table), "sentence", "left").where("sid IS NOT NULL OR pos = -1").drop("sentence"),
        "license-sentences")
    # one marker row per input row; of repeated rows each sentence counts once
    per = (found.where("pos >= 0").select("doc_id", "row", "pos", "sid", "alone").distinct()
           .groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "sid", "alone"))).alias("hits")))
    joined_ids = F.aggregate("hits", F.struct(F.lit("").alias("seq"), F.lit(-1).alias("last")), lambda acc, h: F.struct(
        F.concat(acc["seq"], F.when((acc["last"] >= 0) & (h["pos"] - acc["last"] > gap + 1), " | ").otherwise(""),
                 F.lit(" "), h["sid"], F.lit(" ")).alias("seq"),
        h["pos"].alias("last")))
    # each identifier between blanks of its own, so that neighbours are matched apart
    start = F.struct(joined_ids["seq"].alias("seq"), F.array().cast("array<string>").alias("found"))
    tried = F.array(*[F.struct(F.lit(name).cast("string").alias("name"), F.lit("".join(f" {i} " for i in ids)).alias("ids")) for name, ids in rules])
    matched = F.aggregate(tried, start, lambda acc, rule: F.struct(
        F.when(F.contains(acc["seq"], rule["ids"]), F.replace(acc["seq"], rule["ids"], F.lit(" | "))).otherwise(acc["seq"]).alias("seq"),
        F.when(F.contains(acc["seq"], rule["ids"]), F.array_append(acc["found"], rule["name"])).otherwise(acc["found"]).alias("found")))
    per = per.select(F.col("row").alias("r"), F.col("doc_id").alias("d"), F.col("hits.sid").alias("ids"),
                     F.filter(F.concat(matched["found"], F.col("hits.alone")), F.isnotnull).alias("found"))
    documents = found.where("pos = -1")
    return documents.join(per, (F.col("row") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("d")), "left").select(
        "doc_id", F.col("n_sentences").cast("long").alias("n_sentences"),
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_known"),
        F.coalesce(F.array_join("ids", ","), F.lit("")).alias("sentence_ids"),
        F.coalesce(F.array_join(F.array_sort(F.array_distinct("found")), ","), F.lit("")).alias("licenses"),
        "expressions")
