"""The licence table: SPDX identifiers, short notices by family and version, full texts."""

from __future__ import annotations

import re
from functools import cache
from importlib.resources import files

# Who is licensed: "this ..." or "all ...", "the" with a word for a work, or a name of one word.
_WORK = (r"(?:software|code|program|library|project|work|works|package|module|file|files|document|documentation|repository|content|contents"
         r"|source|sources|text|data|dataset|material|materials|plugin|application|tool|framework|font|fonts)")
_WHO = rf"(?:(?:(?:this|all|our) (?:[0-9a-z]++ ){{0,4}}?|the (?:[0-9a-z]++ ){{0,2}}?{_WORK} |[0-9a-z]++ )(?:is|are) )"
_VERB = "(?:licensed|released|distributed|published|provided|shared|available|made available)"

#: (pattern over normalised sentences, what it stands for): forms with a variable name field.
FIELDS = [
    (r"^(?:[0-9a-z]++ ){1,12}?(?:is|are) free software\b", "this program is free software"),
    # one lead for all: "licensed under" and the name of the licence
    (rf"^{_WHO}?{_VERB} under (?:the )?(?:(?:terms|conditions|terms and conditions)(?: and conditions)? of )?(?:the |an? )?", "licensed under "),
    (rf"^{_WHO}?((?:[0-9a-z]++ ){{0,4}}[0-9a-z]++) licensed$", "licensed under $1"),
    # a definition in brackets; in the notice of this one the definition is part of the sentence known
    (r"^(licensed under (?!apache license version 2 0 the license).*) the licen[cs]e$", "$1"),
    (r"^(licensed under .*)\blicence\b", "$1license"),
    (r"\bhttps\b", "http"),
    (r"^[0-9a-z] (redistributions (?:of|in)|neither the name|all advertising)\b", "$1"),
    (r"^neither the names? of .*\bendorse or promote\b.*$",
     "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
     "products derived from this software without specific prior written permission"),
    (r"^neither the names? of (?!the copyright holder nor the names of its contributors may be used to endorse).*$", "neither the name of"),
    (r"^nor the names? of .*\bendorse or promote\b.*$", "nor the names of its contributors may be used to endorse or promote products"),
    (r"^this product includes software developed by .*$", "this product includes software developed by"),
    (r"^in no event shall .* be liable for any claim damages or other liability whether in an action of contract tort or otherwise "
     r"arising from out of or in connection with the software or the use or other dealings in the software$",
     "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action "
     "of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
]
GNU = [("GPL", "GNU General Public License", ("1", "2", "3")), ("LGPL", "GNU Lesser General Public License", ("2.1", "3")),
       ("LGPL", "GNU Library General Public License", ("2",)), ("AGPL", "GNU Affero General Public License", ("3",))]
CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
      "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
CC_PORT = {"1.0": "Generic", "2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}
NAMED = {"MIT": ["MIT License", "MIT", "MIT (Expat) License", "Expat License"],
         "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache 2.0", "Apache License v2.0",
                        "Apache License, Version 2", "Apache License v2", "Apache-2.0 License", "Apache 2 License", "Apache 2"],
         "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "Mozilla Public License v2.0", "MPL 2.0", "MPL v2.0",
                     "MPLv2", "MPL-2.0 License"],
         "EPL-1.0": ["Eclipse Public License - v 1.0", "Eclipse Public License v1.0", "Eclipse Public License 1.0", "EPL 1.0"],
         "EPL-2.0": ["Eclipse Public License - v 2.0", "Eclipse Public License v2.0", "Eclipse Public License 2.0", "EPL 2.0"],
         "ISC": ["ISC License", "ISC"], "Zlib": ["zlib License", "zlib"], "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
         "BSD-2-Clause": ["BSD 2-Clause License", "BSD 2-Clause", "2-Clause BSD License", "Simplified BSD License"],
         "BSD-3-Clause": ["BSD 3-Clause License", "BSD 3-Clause", "3-Clause BSD License", "New BSD License", "Modified BSD License"],
         "Unlicense": ["Unlicense"], "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal License"]}


def canonical(sentence: str) -> str:
    for pattern, plain in FIELDS:
        sentence = re.sub(pattern, plain.replace("$1", r"\1"), sentence)
    return sentence


@cache
def spdx_ids() -> tuple[str, ...]:
    return tuple((files("riskspark.llm") / "license_texts" / "spdx_ids.txt").read_text().split())


def current(spdx: str) -> str:
    """The identifier in force for a deprecated GNU one."""
    if re.match(r"(GPL|LGPL|AGPL|GFDL)-[0-9.]+\+?$", spdx):
        return spdx[:-1] + "-or-later" if spdx.endswith("+") else spdx + "-only"
    return spdx


def notices() -> list[tuple[str, list[str]]]:
    """Licence and the sentences of a short notice of it, in order. Leads and subjects have one form here;
    ``FIELDS`` maps all others to it."""
    out: list[tuple[str, list[str]]] = []
    lead = "Licensed under the {}."
    for spdx, names in NAMED.items():
        out += [(spdx, [lead.format(n)]) for n in names]
    for family, name, versions in GNU:
        for v in versions:
            whole = v if "." in v else v + ".0"
            full = f"{family}-{whole}"
            free, may = "This program is free software", f"you can redistribute it and/or modify it under the terms of the {name}"
            by = "as published by the Free Software Foundation"
            for version in (f"version {v} of the License", f"version {v}"):
                later = f"either {version}, or (at your option) any later version."
                out += [(full + "-or-later", [f"{free}: {may} {by}, {later}"]),
                        (full + "-or-later", [f"{free}: {may} {by};", later]),
                        (full + "-or-later", [f"{free};", f"{may} {by};", later]),
                        (full + "-or-later", [f"{free};", f"{may} {by}, {later}"]),
                        (full + "-only", [f"{free}: {may} {by}, {version}."]),
                        (full + "-only", [f"{free}: {may} {by};", f"{version}."]),
                        (full + "-only", [f"{free};", f"{may} {by}, {version}."]),
                        (full + "-only", [f"{free};", f"{may} {by};", f"{version}."])]
            out += [(full + "-only", [f"{free};", f"{may} {form} {by}."]) for form in (f"version {v}", f"version {v} only")]
            short = [name] if "Library" in name else [name, f"GNU {family}", family, f"{name} ({family})"]
            forms = [f"{n}{sign}{number}" for n in short for number in dict.fromkeys((v, whole))
                     for sign in (" version ", " v", " ", "v")]
            for form in dict.fromkeys(forms):
                for end in ("", " license"):
                    out += [(full + "-only", [lead.format(f"{form}{only}{end}")]) for only in ("", " only")]
                    out += [(full + "-or-later", [lead.format(f"{form}{more}{end}")])
                            for more in (" or later", " or newer", " or any later version", " or (at your option) any later version")]
    for code, name in CC.items():
        for v, port in CC_PORT.items():
            forms = [f"CC {code} {v}", f"CC-{code}-{v}", f"Creative Commons {name} {v} {port} License", f"Creative Commons {name} {v} {port}",
                     f"Creative Commons {name} {v} License", f"Creative Commons {name} {v} {port} License (CC {code} {v})",
                     f"Creative Commons {name} {v} {port} (CC {code} {v}) License"]
            out += [(f"CC-{code}-{v}", [lead.format(f)]) for f in forms]
    out += [
        ("Zlib", ["This software is provided 'as-is', without any express or implied warranty.",
                  "In no event will the authors be held liable for any damages arising from the use of this software.",
                  "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"]),
        ("EPL-2.0", ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"]),
        ("EPL-1.0", ["All rights reserved.", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"]),
    ]
    return out


def texts() -> dict[str, str]:
    folder = files("riskspark.llm") / "license_texts"
    return {f.name[:-4]: f.read_text() for f in sorted(folder.iterdir(), key=lambda f: f.name) if f.name.endswith(".txt") and f.name != "spdx_ids.txt"}
