import random
import re

import pytest

from riskspark.llm import license_table
from riskspark.llm.licenses import GAP, SENTENCES, knowledge, licenses, normalise, plain_sentences

DDL = "doc_id long, text string, sid string, pos string"
MIT = ("MIT License\n\nCopyright (c) 2020 Foo Bar\n\n" + SENTENCES["mit-grant"].replace(", ", ",\n", 4) + "\n\n"
       + SENTENCES["mit-keep"] + "\n\n" + SENTENCES["mit-warranty"] + " " + SENTENCES["mit-liability"])
BSD = ("Copyright 2019 X. All rights reserved.\n" + SENTENCES["bsd-grant"] + "\n1. " + SENTENCES["bsd-source"] + "\n2. "
       + SENTENCES["bsd-binary"])
CASES = [
    (1, MIT, "MIT"),
    (2, BSD, "BSD-2-Clause,all-rights-reserved"),
    (3, BSD + "\n3. " + SENTENCES["bsd-name"], "BSD-3-Clause,all-rights-reserved"),
    (4, None, ""),
    (5, "", ""),
    (6, "hello.\nAll rights reserved.\nx y z. Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0,all-rights-reserved"),
    (7, "# spdx-license-identifier: MIT\nfoo", "MIT"),
    (8, SENTENCES["apache-under"] + "\n" + SENTENCES["apache-comply"] + "\n" + SENTENCES["apache-obtain"], "Apache-2.0"),
    (9, "We discuss the MIT License and the Apache License, Version 2.0 here.", ""),
    # in the wrong order, and with too much between
    (10, SENTENCES["bsd-binary"] + " " + SENTENCES["bsd-source"] + " " + SENTENCES["bsd-grant"], ""),
    (11, SENTENCES["apache-under"] + " One here. Two here. Three here. " + SENTENCES["apache-comply"], ""),
    (12, SENTENCES["apache-under"] + " One here. Two here. " + SENTENCES["apache-comply"], "Apache-2.0"),
    (13, "Released under the MIT License.\n" * 300, "MIT"),
    (None, "a b. released under THE mit license!", "MIT"),
]


def test_rules(spark):
    df = spark.createDataFrame([(i, t, "s", "p") for i, t, _ in CASES] + [(6, CASES[5][1], "s", "p")], DDL)
    got = licenses(df).collect()
    assert sorted((str(r.doc_id), r.licenses) for r in got) == sorted([(str(i), x) for i, _, x in CASES] + [("6", CASES[5][2])])
    by = {r.doc_id: r for r in got}
    assert by[1].sentence_ids == "mit-title,mit-grant,mit-keep,mit-warranty,mit-liability" and by[1].n_known == 5
    assert by[6].n_known == 2 and by[13].n_sentences == 300 and by[4].n_sentences == 0


def test_own_knowledge_and_empty_table(spark):
    df = spark.createDataFrame([(1, "Alpha beta. Gamma delta.")], "doc_id long, text string")
    got = licenses(df, known={"a": "alpha beta", "g": "gamma delta"}, rules=[("AG", ["a", "g"]), ("G", ["g"])]).first()
    assert got.licenses == "AG" and got.sentence_ids == "a,g"
    assert licenses(spark.createDataFrame([], DDL)).count() == 0


@pytest.mark.parametrize(("text", "want"), [("A  b,C!", "a b c"), ("", ""), ("É x", "x")])
def test_normalise(text, want):
    assert normalise(text) == want


LESSER = ("This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\n"
          "License as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.")
REAL = [
    (BSD + "\n3. Neither the name of Example, Inc. nor the names of its contributors may be used to endorse or promote "
     "products derived from this software without specific prior written permission.", "BSD-3-Clause,all-rights-reserved"),
    (BSD + "\n3. Neither the name of Example may appear anywhere.", "all-rights-reserved"),
    ("// SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"),
    ("# SPDX-License-Identifier: GPL-2.0", "GPL-2.0-only"),
    ("# SPDX-License-Identifier: GPL-2.0+", "GPL-2.0-or-later"),
    ("# SPDX-License-Identifier: (MIT OR Apache-2.0)", "Apache-2.0,MIT"),
    ("SPDX-License-Identifier: AGPL-3.0-or-later", "AGPL-3.0-or-later"),
    (LESSER, "LGPL-2.1-or-later"),
    (LESSER.replace("Lesser", "Affero").replace("2.1", "3").replace("library", "program"), "AGPL-3.0-or-later"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", "CC-BY-NC-ND-4.0"),
    ("Licensed under the Eclipse Public License 2.0.", "EPL-2.0"),
    ("Licensed under CC BY-SA 3.0.", "CC-BY-SA-3.0"),
]


def test_real_forms(spark):
    got = licenses(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(REAL)], "doc_id long, text string")).collect()
    assert [r.licenses for r in sorted(got)] == [w for _, w in REAL]


def test_full_texts_and_all_identifiers(spark):
    texts, ids = license_table.texts(), license_table.spdx_ids()
    rows = [(n, t) for n, t in texts.items()] + [("id " + i, "SPDX-License-Identifier: " + i) for i in ids]
    got = {r.doc_id: r for r in licenses(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert [n for n in texts if license_table.current(n) not in got[n].licenses.split(",")] == []
    assert [n for n, x in texts.items() if got[n].n_known < sum(s.count(" ") >= 3 for s in plain_sentences(x))] == []
    assert [i for i in ids if got["id " + i].licenses != license_table.current(i)] == []


def test_headings_of_full_texts_are_no_licence_sentences(spark):
    got = licenses(spark.createDataFrame([(1, "Preamble. See below. And so on. We read it.")], "doc_id long, text string")).first()
    assert (got.n_known, got.licenses) == (0, "")


GNU3 = ("{} is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.")
FORMS = [
    (GNU3.format("Foo Bar"), "GPL-3.0-or-later"),
    (GNU3.format("GNU Emacs").replace("Foundation, either", "Foundation; either").replace("version 3", "version 2"), "GPL-2.0-or-later"),
    ('Licensed under the MIT License (the "License");\nyou may go.', "MIT"),
    ("This code is MIT licensed.", "MIT"),
    ("MIT licensed.", "MIT"),
    ("released under the terms of the GNU GPL v3", "GPL-3.0-only"),
    ("All files in this folder are released under the terms and conditions of the GPLv2+.", "GPL-2.0-or-later"),
    ("The source code is available under LGPL 2.1 or later.", "LGPL-2.1-or-later"),
    ("Frobnicate is distributed under the New BSD Licence.", "BSD-3-Clause"),
    ("Our plugin is made available under an Apache 2.0 license.", "Apache-2.0"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"),
    # no statements of a licence
    ("This code is not licensed under the MIT License.", ""),
    ("The law of this state is licensed under pressure.", ""),
    ("They ask whether code under the MIT License may be sold.", ""),
    ("GNU is free software, is it not?", ""),
]


def test_leads_names_and_definitions(spark):
    got = licenses(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(FORMS)], "doc_id long, text string")).collect()
    assert [(FORMS[r.doc_id][0], r.licenses) for r in sorted(got)] == FORMS


def test_expressions_are_kept(spark):
    text = ("// SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH Classpath-exception-2.0)\n/* SPDX-License-Identifier: ISC */\n"
            "<!-- spdx-license-identifier: 0BSD -->\r\nSPDX-License-Identifier:\n# SPDX-License-Identifier: ISC")
    got = licenses(spark.createDataFrame([(1, text), (2, None), (3, "none")], "doc_id long, text string")).collect()
    assert {r.doc_id: r.expressions for r in got} == {
        1: ["(MIT OR GPL-2.0-only WITH Classpath-exception-2.0)", "0BSD", "ISC"], 2: [], 3: []}


def plain(text):
    """Sentences of the identifier lines apart, then each rule in turn over lists of identifiers."""
    known, rules = knowledge()
    parts = []
    for s in plain_sentences_raw(text or ""):
        m = re.match(r"(?is)[^a-z]*spdx-license-identifier\s*:(.*)", s)
        if m:
            line = re.sub(r"[+](?=[\s)]|$)", "-or-later", m[1])
            parts += ["SPDX-License-Identifier: " + p for p in re.split(r"(?i)\s+(?:and|or|with)\s+", line)]
        else:
            parts.append(s)
    seen = [n for p in parts if len(n := license_table.canonical(normalise(p))) > 2]
    runs, last = [], None
    for i, s in enumerate(seen):
        if s in known:
            if last is None or i - last > GAP + 1:
                runs.append([])
            runs[-1].append(known[s])
            last = i
    ids, found = [i for run in runs for i in run], set()
    for name, want in rules:
        hit, left = False, []
        for run in runs:
            at = start = 0
            while at + len(want) <= len(run):
                if run[at : at + len(want)] == want:
                    hit = True
                    left.append(run[start:at])
                    at = start = at + len(want)
                else:
                    at += 1
            left.append(run[start:])
        if hit:
            runs = left
            found |= {name} - {None}
    return len(seen), ids, ",".join(sorted(found))


def plain_sentences_raw(text):
    from riskspark.llm.licenses import OWN_LINE, SPLIT

    return re.split(SPLIT, re.sub(OWN_LINE, "\x01\\1\x01", text + "\n"))


def test_rules_match_a_plain_matcher(spark):
    rng = random.Random(4)
    pieces = [t for _, t, _ in CASES if t] + [t for t, _ in REAL + FORMS]
    pieces += [s if s[-1] in ".:;" else s + "." for s in SENTENCES.values()] + ["One here.", "Two there.", "\n\n", "Copyright 2020 X"]
    rows = [(i, rng.choice([" ", "\n"]).join(rng.choices(pieces, k=rng.randint(1, 14)))) for i in range(400)]
    got = {r.doc_id: r for r in licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        n, ids, want = plain(text)
        r = got[i]
        assert (r.n_sentences, r.sentence_ids, r.licenses) == (n, ",".join(ids), want), text
