"""License scans by sentence rules (operator 8), in DataFrame functions only.

A text is read twice: line by line, and with single line ends as spaces, for
licence texts that are wrapped.  Its sentences are normalised (lower case, runs
of anything but a-z and 0-9 as one blank) and mapped to the identifiers of known
licence sentences, which are those of SENTENCES and all notices, titles and SPDX
lines that NAMES gives rise to; the sequence of identifiers is then matched against
ordered licence rules, each of which allows up to two other known sentences in between.

Every known sentence holds one of the words in HINTS, so texts without them
are passed over by one regular expression; this drops no match.

Edge cases: null and empty texts have no sentences and no licences; repeated
rows get a row each; whole texts are scanned, however long.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and the orders in which they form a notice.
SENTENCES = {
    "apache2.name": "Licensed under the Apache License, Version 2.0",
    "apache2.use": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License',
    "apache2.basis": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    "apache2.see": "See the License for the specific language governing permissions and limitations under the License",
    "mit.name": "Released under the MIT License",
    "mit.grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software',
    "mit.keep": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit.warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT',
    "gpl3.name": "This work is licensed under the GNU General Public License, version 3",
    "gpl3.grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl.hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "gpl.see": "See the GNU General Public License for more details",
    "bsd.grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd.grant1": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1",
    "bsd.source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd.binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd.name": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "ccbync4.name": "Licensed under CC BY-NC 4.0",
    "ccby4.name": "Licensed under CC BY 4.0",
    "spdx.apache2": "SPDX-License-Identifier: Apache-2.0",
    "spdx.mit": "SPDX-License-Identifier: MIT",
}
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
SENTENCES |= {
    "isc.grant": f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies",
    "0bsd.grant": _ISC,
    "isc.warranty": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS',
    "unlicense.free": "This is free and unencumbered software released into the public domain",
    "unlicense.see": "For more information, please refer to <https://unlicense.org>",
    "mpl2.form": "This Source Code Form is subject to the terms of the Mozilla Public License, v",  # '. 2.0' begins a sentence of its own
    "mpl11.use": 'The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not use this file except in compliance with the License',
    "bsl.grant": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following',
    "zlib.warranty": "This software is provided 'as-is', without any express or implied warranty",
    "zlib.alter": "This notice may not be removed or altered from any source distribution",
    "cc0.waive": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "cc0.authors": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
    "epl1.made": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "epl2.made": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "bsd4.ad": "All advertising materials mentioning features or use of this software must display the following acknowledgement",
}
#: Licence -> its wordings in notices, and its SPDX identifiers; in wordings {v} stands for every usual form of the version.
NAMES: dict[str, tuple[list[str], list[str]]] = {
    "0BSD": (["Zero-Clause BSD License", "BSD Zero Clause License", "0BSD License", "0BSD"], ["0BSD"]),
    "AGPL-3.0": (["GNU Affero General Public License{v3}", "GNU AGPL{v3}", "AGPL{v3}", "AGPLv3"], ["AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"]),
    "Apache-2.0": (["Apache License{v2.0}", "Apache License{v2}", "Apache{v2.0} License", "Apache{v2} License", "Apache{v2.0}"], ["Apache-2.0", "Apache-2.0 WITH LLVM-exception"]),
    "Artistic-2.0": (["Artistic License{v2.0}"], ["Artistic-2.0"]),
    "BSD-2-Clause": (["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "FreeBSD License", 'BSD 2-Clause "Simplified" License', "BSD-2-Clause"], ["BSD-2-Clause"]),
    "BSD-3-Clause": (["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "Revised BSD License", 'BSD 3-Clause "New" or "Revised" License', "BSD-3-Clause"], ["BSD-3-Clause"]),
    "BSD-4-Clause": (["BSD 4-Clause License", "4-Clause BSD License", "Original BSD License"], ["BSD-4-Clause"]),
    "BSL-1.0": (["Boost Software License{v1.0}", "Boost Software License", "Boost License"], ["BSL-1.0"]),
    "CC0-1.0": (["CC0", "CC0{v1.0}", "CC0{v1.0} Universal", "Creative Commons Zero{v1.0} Universal", "Creative Commons CC0{v1.0} Universal", "CC0{v1.0} Universal License", "Creative Commons Zero License"], ["CC0-1.0"]),
    "CDDL-1.0": (["Common Development and Distribution License{v1.0}", "CDDL{v1.0}"], ["CDDL-1.0"]),
    "EPL-1.0": (["Eclipse Public License{v1.0}", "EPL{v1.0}"], ["EPL-1.0"]),
    "EPL-2.0": (["Eclipse Public License{v2.0}", "EPL{v2.0}"], ["EPL-2.0"]),
    "EUPL-1.2": (["European Union Public Licence{v1.2}", "European Union Public License{v1.2}", "EUPL{v1.2}"], ["EUPL-1.2"]),
    "GPL-2.0": (["GNU General Public License{v2}", "GNU General Public License{v2.0}", "GNU GPL{v2}", "GPL{v2}", "GPL{v2.0}"], ["GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-2.0-only WITH Classpath-exception-2.0", "GPL-2.0 WITH Linux-syscall-note"]),
    "GPL-3.0": (["GNU General Public License{v3}", "GNU General Public License{v3.0}", "GNU GPL{v3}", "GPL{v3}", "GPL{v3.0}"], ["GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"]),
    "ISC": (["ISC License", "ISC"], ["ISC"]),
    "LGPL-2.0": (["GNU Library General Public License{v2}", "LGPL{v2.0}"], ["LGPL-2.0", "LGPL-2.0-only", "LGPL-2.0-or-later"]),
    "LGPL-2.1": (["GNU Lesser General Public License{v2.1}", "GNU LGPL{v2.1}", "LGPL{v2.1}"], ["LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later"]),
    "LGPL-3.0": (["GNU Lesser General Public License{v3}", "GNU LGPL{v3}", "LGPL{v3}", "LGPL{v3.0}"], ["LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"]),
    "MIT": (["MIT License", "MIT License (MIT)", "MIT licence", "Expat License", "MIT"], ["MIT"]),
    "MIT-0": (["MIT No Attribution License", "MIT-0 License", "MIT No Attribution"], ["MIT-0"]),
    "MPL-1.1": (["Mozilla Public License{v1.1}", "MPL{v1.1}"], ["MPL-1.1"]),
    "MPL-2.0": (["Mozilla Public License{v2.0}", "MPL{v2.0}"], ["MPL-2.0"]),
    "MS-PL": (["Microsoft Public License"], ["MS-PL"]),
    "OFL-1.1": (["SIL Open Font License{v1.1}"], ["OFL-1.1"]),
    "PostgreSQL": (["PostgreSQL License"], ["PostgreSQL"]),
    "Unlicense": (["Unlicense", "Unlicense License"], ["Unlicense"]),
    "WTFPL": (["WTFPL", "Do What The Fuck You Want To Public License"], ["WTFPL"]),
    "Zlib": (["zlib License", "zlib/libpng License"], ["Zlib"]),
}
for _v in ("3.0", "4.0"):
    for _k, _words in {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}.items():
        _long = f"Creative Commons {_words} {_v}"
        NAMES[f"CC-{_k}-{_v}"] = ([f"CC {_k} {_v}", f"CC {_k} {_v} License", _long, f"{_long} License", f"{_long} International License", f"{_long} International", f"{_long} Unported License"], [f"CC-{_k}-{_v}"])

#: What precedes a name in a notice.
NOTICES = [f"{made} under" for made in ("licensed", "released", "distributed", "available", "published", "made available")]
NOTICES += [f"{made} under the terms of" for made in ("licensed", "released", "distributed")]
NOTICES += [f"this {thing} is {made} under" for thing in ("project", "software", "work", "program", "library", "code", "file") for made in ("licensed", "released")]
#: What may follow it after "this project is licensed under ...".
TAILS = ["see the LICENSE file for details", "see LICENSE for details", "see the LICENSE.md file for details", "see the [LICENSE](LICENSE) file for details", "see the [LICENSE.md](LICENSE.md) file for details"]
#: Licences whose SPDX identifiers are also known in pairs, joined by OR or AND.
PAIRED = ["Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "EPL-2.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense", "Zlib"]

# Grants of the GNU licences: for programs, libraries and the like, either version or a later one, or that version alone.
for _k, _name, _v in (("gpl2", "General", "2"), ("gpl3", "General", "3"), ("lgpl2", "Library General", "2"), ("lgpl21", "Lesser General", "2.1"), ("lgpl3", "Lesser General", "3"), ("agpl3", "Affero General", "3")):
    for _x in ("program", "library", "software", "file"):
        _free = f"This {_x} is free software: you can redistribute it and/or modify it under the terms of the GNU {_name} Public License"
        for _n, _how in enumerate((f"as published by the Free Software Foundation, either version {_v} of the License, or (at your option) any later version", f"as published by the Free Software Foundation, version {_v} of the License", f"as published by the Free Software Foundation, version {_v}", f"version {_v} as published by the Free Software Foundation", f"version {_v} only, as published by the Free Software Foundation")):
            _sentence = f"{_free} {_how}"
            if _sentence != SENTENCES["gpl3.grant"]:
                SENTENCES[f"{_k}.grant.{_x}{_n}"] = _sentence

RULES = [
    ("Apache-2.0", ["apache2.name"]),
    ("Apache-2.0", ["apache2.use", "apache2.basis", "apache2.see"]),
    ("Apache-2.0", ["spdx.apache2"]),
    ("BSD-2-Clause", ["bsd.source", "bsd.binary"]),
    ("BSD-2-Clause", ["bsd.grant", "bsd.binary"]),
    ("BSD-3-Clause", ["bsd.source", "bsd.binary", "bsd.name"]),
    ("BSD-3-Clause", ["bsd.grant", "bsd.binary", "bsd.name"]),
    ("CC-BY-4.0", ["ccby4.name"]),
    ("CC-BY-NC-4.0", ["ccbync4.name"]),
    ("GPL-3.0", ["gpl3.name"]),
    ("GPL-3.0", ["gpl3.grant", "gpl.hope", "gpl.see"]),
    ("MIT", ["mit.name"]),
    ("MIT", ["mit.grant", "mit.warranty"]),
    ("MIT", ["mit.keep", "mit.warranty"]),
    ("MIT", ["spdx.mit"]),
    ("GPL-3.0", ["gpl3.grant"]),
    ("ISC", ["isc.grant"]),
    ("0BSD", ["0bsd.grant", "isc.warranty"]),
    ("Unlicense", ["unlicense.free"]),
    ("Unlicense", ["unlicense.see"]),
    ("MPL-2.0", ["mpl2.form"]),
    ("MPL-1.1", ["mpl11.use"]),
    ("BSL-1.0", ["bsl.grant"]),
    ("Zlib", ["zlib.warranty", "zlib.alter"]),
    ("CC0-1.0", ["cc0.waive"]),
    ("CC0-1.0", ["cc0.authors"]),
    ("EPL-1.0", ["epl1.made"]),
    ("EPL-2.0", ["epl2.made"]),
    ("BSD-4-Clause", ["bsd.source", "bsd.binary", "bsd4.ad"]),
    ("BSD-4-Clause", ["bsd.grant", "bsd.binary", "bsd4.ad"]),
]
for _k, _licence in (("gpl2", "GPL-2.0"), ("gpl3", "GPL-3.0"), ("lgpl2", "LGPL-2.0"), ("lgpl21", "LGPL-2.1"), ("lgpl3", "LGPL-3.0"), ("agpl3", "AGPL-3.0")):
    RULES += [(_licence, [i]) for i in SENTENCES if i.startswith(f"{_k}.grant.")]
HINTS = "licen|copyright|warrant|redistribut|granted|domain|altered|advertising|gpl|(?:^|[^a-z0-9])(?:mit|isc|bsd|0bsd|cc|cc0|mpl|epl|cddl|eupl|wtfpl|apache|creative|do what)"
SPLIT = "[.!?]+(?:[ \t\r\n]+|\\z)|\n+"
GAP = 2


def normal(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def _wordings(name: str) -> list[str]:
    """``name`` with each usual form of its version: 'X 2', 'X v2', 'Xv2', 'X version 2', 'X, Version 2', with 'or later'."""
    m = re.fullmatch(r"(.*)\{v([0-9.]+)\}(.*)", name)
    if m is None:
        return [name]
    head, v, tail = m.groups()
    forms = [f"{head} {v}{tail}", f"{head} v{v}{tail}", *([] if "icense" in head else [f"{head}v{v}{tail}"]), *([] if tail else [f"{head} version {v}"])]
    return forms + ([f"{forms[0]} or later", f"{forms[1]} or later", f"{head} version {v} or later"] if "G" in head else [])


def _known() -> tuple[dict[str, str], list[tuple[str, list[str]]]]:
    """Normalised sentence -> identifier for all known sentences, and the rules."""
    out: dict[str, str] = {}
    rules = list(RULES)
    for licence, (names, spdx) in NAMES.items():
        stem = re.sub("[^a-z0-9]", "", licence.lower())
        rules += [(licence, [f"notice.{stem}"]), (licence, [f"title.{stem}"]), (licence, [f"spdx.{stem}"])]
        for name in dict.fromkeys(normal(w) for n in names for w in _wordings(n)):
            short = "licen" not in name
            for the in ("the ", "") if short else ("the ", "a ") if name.startswith("creative") else ("the ",):
                for before in NOTICES:
                    out[f"{before} {the}{name}"] = f"notice.{stem}"
                for tail in TAILS:
                    out[normal(f"this project is licensed under {the}{name} {tail}")] = f"notice.{stem}"
            out |= {f"{label} {name}": f"title.{stem}" for label in ("license", "licence")}
            if not short:
                out |= {f"{the}{name}": f"title.{stem}" for the in ("", "the ")} | {f"licensed under {name}": f"notice.{stem}"}
        for x in spdx:
            out[normal(f"SPDX-License-Identifier: {x}")] = f"spdx.{stem}"
    for a in PAIRED:
        for b in PAIRED:
            if a != b:
                ident = "spdx." + ".".join(sorted(re.sub("[^a-z0-9]", "", x.lower()) for x in (a, b)))
                rules += [(x, [ident]) for x in (a, b) if (x, [ident]) not in rules]
                for x in NAMES[a][1]:
                    for y in NAMES[b][1]:
                        for how in ("OR", "AND"):
                            out[normal(f"SPDX-License-Identifier: ({x} {how} {y})")] = ident
    out |= {normal(v): k for k, v in SENTENCES.items()}
    return out, rules


def _patterns() -> dict[str, str]:
    """Licence -> one regular expression over ',id,id,...,'."""
    out: dict[str, list[str]] = {}
    for name, ids in _known()[1]:
        between = f",(?:[^,]+,){{0,{GAP}}}"
        out.setdefault(name, []).append("," + between.join(re.escape(i) for i in ids) + ",")
    return {k: "|".join(v) for k, v in out.items()}


#: Slots of the hash table of known sentences, each a short list of them.
SLOTS = 8192


def _slots() -> list[str]:
    """``sentence:id,...`` of the known sentences of each slot, which is their CRC-32 modulo SLOTS."""
    out: list[list[str]] = [[] for _ in range(SLOTS)]
    for k, v in _known()[0].items():
        out[zlib.crc32(k.encode()) % SLOTS].append(f"{k}:{v}")
    return [",".join(x) for x in out]


def _ids(text: Column, hit: Column) -> Column:
    """Identifiers of the known sentences of ``text``, in order."""
    table = F.split(F.lit("\n".join(_slots())), "\n")  # folded once; an array, so that a slot is found by its number
    parts = F.filter(F.split(text, SPLIT), lambda s: s.rlike(HINTS))
    plain = F.transform(parts, lambda s: F.trim(F.regexp_replace(s, "[^a-z0-9]+", " ")))
    slot = lambda s: F.get(table, (F.crc32(s) % SLOTS).cast("int"))
    known = F.transform(plain, lambda s: F.try_element_at(F.str_to_map(slot(s), F.lit(","), F.lit(":")), s))
    return F.when(hit, F.filter(known, lambda x: x.isNotNull())).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences, sentence_ids, wrapped_ids, licenses for every row of ``docs``; no shuffle.

    ``n_sentences`` counts known sentences of the line-wise reading; lists are comma-joined.
    """
    low = docs.select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("t"))
    hit = F.col("t").rlike(HINTS)
    read = low.select("doc_id", _ids(F.col("t"), hit).alias("a"), _ids(F.regexp_replace("t", "[ \t\r]*\n[ \t\r]*(?!\n)", " "), hit).alias("b"))
    line = lambda c: F.concat(F.lit(","), F.concat_ws(",", c), F.lit(","))
    found = F.array_compact(F.array(*[F.when(line("a").rlike(p) | line("b").rlike(p), F.lit(k)) for k, p in sorted(_patterns().items())]))
    return read.select(
        "doc_id",
        F.size("a").cast("long").alias("n_sentences"),
        F.concat_ws(",", "a").alias("sentence_ids"),
        F.concat_ws(",", "b").alias("wrapped_ids"),
        F.concat_ws(",", found).alias("licenses"),
    )


def oracle_sql() -> str:
    """The same in DuckDB."""
    table = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in _known()[0].items()) + "}"
    split = SPLIT.replace("\t", "\\t").replace("\r", "\\r").replace("\n", "\\n")
    ids = lambda t: f"""list_filter(list_transform(list_filter(string_split_regex({t}, '{split}'), lambda s: regexp_matches(s, '{HINTS}')),
        lambda s: ({table})[trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g'))]), lambda x: x IS NOT NULL)"""  # noqa: E731
    # No look-ahead here: line ends that stand alone become blanks, others stay.
    wrapped = "replace(regexp_replace(regexp_replace(t, '[ \\t\\r]*(\\n[ \\t\\r]*)*\\n[ \\t\\r]*\\n', chr(1) || chr(10), 'g'), '[ \\t\\r]*\\n[ \\t\\r]*', ' ', 'g'), chr(1) || ' ', ' ' || chr(10))"
    tests = ", ".join(f"CASE WHEN regexp_matches(sa, '{p}') OR regexp_matches(sb, '{p}') THEN '{k}' END" for k, p in sorted(_patterns().items()))
    return f"""
WITH d AS (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents),
i AS (SELECT doc_id, {ids('t')} AS a, {ids(wrapped)} AS b FROM d),
j AS (SELECT *, ',' || array_to_string(a, ',') || ',' AS sa, ',' || array_to_string(b, ',') || ',' AS sb FROM i)
SELECT doc_id, CAST(len(a) AS BIGINT) AS n_sentences, array_to_string(a, ',') AS sentence_ids, array_to_string(b, ',') AS wrapped_ids,
  array_to_string(list_filter([{tests}], lambda x: x IS NOT NULL), ',') AS licenses
FROM j"""
