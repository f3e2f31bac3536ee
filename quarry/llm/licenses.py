"""Licence scans by sentence rules: sentences are normalised and mapped to
identifiers of known licence sentences; a document's identifier sequence is
then matched against ordered licence rules.

DataFrame expressions only. The known sentences are a fixed list of a few
dozen entries (``SENTENCES``), so the map is a literal in the plan; a
document never leaves its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Identifier -> sentence as published in the licence or its notice; fixed values.
SENTENCES = {
    "mit.name": "The MIT License (MIT)",
    "mit.notice": "Released under the MIT License.",
    "mit.notice2": "Licensed under the MIT License.",
    "mit.grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
                 "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                 "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
                 "furnished to do so, subject to the following conditions:",
    "mit.keep": "The above copyright notice and this permission notice shall be included in all copies or substantial "
                "portions of the Software.",
    "apache2.notice": "Licensed under the Apache License, Version 2.0.",
    "apache2.notice2": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                       "except in compliance with the License.",
    "apache2.copy": "You may obtain a copy of the License at",
    "gpl3.notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl.notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                  "General Public License as published by the Free Software Foundation, either version 3 of the "
                  "License, or (at your option) any later version.",
    "gpl.warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
                    "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "bsd.grant": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                 "provided that the following conditions are met:",
    "bsd.name": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                "promote products derived from this software without specific prior written permission.",
    "ccbync4.notice": "Licensed under CC BY-NC 4.0.",
    "ccby4.notice": "Licensed under CC BY 4.0.",
    "reserved": "All rights reserved.",
    "mit.title": "MIT License",
    "mit.title2": "The MIT License",
    "apache2.title": "Apache License Version 2.0, January 2004",
    "gpl2.title": "GNU General Public License Version 2, June 1991",
    "gpl3.title": "GNU General Public License Version 3, 29 June 2007",
    "lgpl21.title": "GNU Lesser General Public License Version 2.1, February 1999",
    "lgpl3.title": "GNU Lesser General Public License Version 3, 29 June 2007",
    "agpl3.title": "GNU Affero General Public License Version 3, 19 November 2007",
    "mpl2.notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl2.title": "Mozilla Public License Version 2.0",
    "bsd.source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                  "following disclaimer.",
    "bsd.binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                  "following disclaimer in the documentation and/or other materials provided with the distribution.",
    "isc.grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                 "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc.grant2": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is "
                  "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "unlicense.grant": "This is free and unencumbered software released into the public domain.",
    "cc0.title": "CC0 1.0 Universal",
    "ccby4.title": "Creative Commons Attribution 4.0 International",
    "ccbysa4.title": "Creative Commons Attribution-ShareAlike 4.0 International",
    "ccbync4.title": "Creative Commons Attribution-NonCommercial 4.0 International",
    "zlib.warranty": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib.grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter "
                  "it and redistribute it freely, subject to the following restrictions:",
    "apache2.basis": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
                     "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache2.see": "See the License for the specific language governing permissions and limitations under the License.",
}
#: As SENTENCES, with a holder's name of up to ten words at the mark.
HELD = {
    "bsd.name": "Neither the name of * may be used to endorse or promote products derived from this software without specific "
                "prior written permission.",
    "cc0.waiver": "To the extent possible under law, * waived all copyright and related or neighboring rights to *",
}
#: Licence -> its names in notices, as ``normal`` gives them; "licence", "the" and "version" may stand around them.
NAMES = {
    "MIT": "mit|expat|mit x11|mit expat", "Apache-2.0": "apache 2 0|apache v2|apache v2 0|apache 2|asl 2 0",
    "GPL-2.0": "gnu gpl 2|gnu gpl v2|gplv2|gpl v2|gpl 2 0|gpl 2|gnu general public 2|gnu general public v2|gnu general public 2 0",
    "GPL-3.0": "gnu gpl 3|gnu gpl v3|gplv3|gpl v3|gpl 3 0|gpl 3|gnu general public 3|gnu general public v3|gnu general public v3 0|gnu general public 3 0",
    "LGPL-2.1": "gnu lgpl 2 1|lgplv2 1|lgpl v2 1|lgpl 2 1|gnu lesser general public 2 1|gnu lesser general public v2 1",
    "LGPL-3.0": "gnu lgpl 3|gnu lgpl v3|lgplv3|lgpl v3|lgpl 3 0|lgpl 3|gnu lesser general public 3|gnu lesser general public v3|gnu lesser general public 3 0",
    "AGPL-3.0": "gnu agpl 3|gnu agpl v3|agplv3|agpl v3|agpl 3 0|agpl 3|gnu affero general public 3|gnu affero general public v3|gnu affero general public 3 0",
    "MPL-2.0": "mozilla public 2 0|mozilla public v2 0|mozilla public v 2 0|mpl 2 0|mpl v2|mpl 2",
    "BSD-2-Clause": "bsd 2 clause|2 clause bsd|simplified bsd|freebsd", "BSD-3-Clause": "bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd",
    "ISC": "isc", "Zlib": "zlib", "Unlicense": "unlicense", "BSL-1.0": "boost software 1 0", "EPL-2.0": "eclipse public 2 0|eclipse public v2 0|eclipse public v 2 0|epl 2 0",
    "CC0-1.0": "cc0|cc0 1 0|cc0 1 0 universal|creative commons zero 1 0|creative commons cc0|creative commons cc0 1 0 universal",
    "CC-BY-4.0": "cc by 4 0|creative commons attribution 4 0|creative commons attribution 4 0 international",
    "CC-BY-SA-4.0": "cc by sa 4 0|creative commons attribution sharealike 4 0|creative commons attribution sharealike 4 0 international",
    "CC-BY-SA-3.0": "cc by sa 3 0|creative commons attribution sharealike 3 0|creative commons attribution sharealike 3 0 unported",
    "CC-BY-NC-4.0": "cc by nc 4 0|creative commons attribution noncommercial 4 0|creative commons attribution noncommercial 4 0 international",
    "CC-BY-ND-4.0": "cc by nd 4 0|creative commons attribution noderivatives 4 0|creative commons attribution noderivatives 4 0 international",
}
#: Licence -> sentence identifiers that must occur in this order (others may stand between); first rules are the most specific.
RULES = (
    ("MIT", ("mit.grant", "mit.keep")),
    ("MIT", ("mit.name",)),
    ("MIT", ("mit.notice",)),
    ("MIT", ("mit.notice2",)),
    ("Apache-2.0", ("apache2.notice2", "apache2.copy")),
    ("Apache-2.0", ("apache2.notice",)),
    ("GPL-3.0-or-later", ("gpl.notice", "gpl.warranty")),
    ("GPL-3.0", ("gpl3.notice",)),
    ("BSD-3-Clause", ("bsd.grant", "bsd.name")),
    ("CC-BY-NC-4.0", ("ccbync4.notice",)),
    ("CC-BY-4.0", ("ccby4.notice",)),
    ("All-rights-reserved", ("reserved",)),
    ("MIT", ("mit.title",)),
    ("MIT", ("mit.title2",)),
    ("Apache-2.0", ("apache2.title",)),
    ("GPL-2.0", ("gpl2.title",)),
    ("GPL-3.0", ("gpl3.title",)),
    ("GPL-3.0-or-later", ("gpl.notice",)),
    ("LGPL-2.1", ("lgpl21.title",)),
    ("LGPL-3.0", ("lgpl3.title",)),
    ("AGPL-3.0", ("agpl3.title",)),
    ("MPL-2.0", ("mpl2.notice",)),
    ("MPL-2.0", ("mpl2.title",)),
    ("ISC", ("isc.grant",)),
    ("ISC", ("isc.grant2",)),
    ("Unlicense", ("unlicense.grant",)),
    ("CC0-1.0", ("cc0.title",)),
    ("CC0-1.0", ("cc0.waiver",)),
    ("CC-BY-4.0", ("ccby4.title",)),
    ("CC-BY-SA-4.0", ("ccbysa4.title",)),
    ("CC-BY-NC-4.0", ("ccbync4.title",)),
    ("Zlib", ("zlib.grant",)),
    ("Apache-2.0", ("apache2.basis", "apache2.see")),
)
#: As RULES, for texts where the licence named third is not found.
SHORTER = (("BSD-2-Clause", ("bsd.grant", "bsd.source", "bsd.binary"), "BSD-3-Clause"),)
#: Ends of sentences, and line breaks, where one may end, in the marked text.
_END, _LINE = "\ue000", "\ue001"
#: What may stand between two words of a sentence: a line break, or a mark that another edition of it has.
_GAP = rf"(?:\x20[{_END}{_LINE}])*\x20"
_SUBJECT = r"(?:(?:this|the|our|all) (?:\w+ ){1,4}?(?:is|are) (?:dual )?|it is |is )?"
_UNDER = r"(?:dual )?(?:re)?(?:licensed|released|distributed|published|provided|available|made available|covered|shared|offered) (?:to you )?under (?:the )?(?:terms (?:and conditions )?of )?(?:the |a |an )?"
_GNU = (r"(?:this|the) (?:\w+ ){1,3}(?:is|are) free software you can redistribute (?:it|them) and or modify (?:it|them) under the terms of the gnu "
        r"(general|lesser general|library general|affero general) public license as published by the free software foundation "
        r"(?:either )?version (\d)(?: ([01]))?(?: of the license)?( or at your option any later version)?(?: only)?")
_SPDX = r"(?i:SPDX-License-Identifier):[\x20\t]*(\(*[A-Za-z0-9][A-Za-z0-9.+-]*\)*(?:[\x20\t]+(?:AND|OR|WITH)[\x20\t]+\(*[A-Za-z0-9][A-Za-z0-9.+-]*\)*)*)"
#: Every known sentence holds one of these, on one line.
_ANCHORS = "licen[cs]|permission|permitted|redistrib|rights|warrant|under|unencumbered|software|endorse|option|creative|cc0|copyright"


def normal(sentence: Column) -> Column:
    """Lower case (A-Z), runs of other characters than letters, marks and digits as one space, trimmed."""
    lowered = F.translate(sentence, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(lowered, r"[^\p{L}\p{M}\p{N}]+", " "))


def _normal(s: str) -> str:
    kept = "".join(c if c.isalnum() else " " for c in s.lower())
    return " ".join(kept.split())


def _marked(text: Column) -> Column:
    """The text as ``normal`` gives it, with marks where sentences end and lines break; comment marks are gone.

    A sentence ends at . ! ? : ; with white space behind and at a line without letters and digits."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    marked = F.regexp_replace(lowered, r"(?m)^[\x20\t]*(?:dnl|rem)\b", "")
    marked = F.regexp_replace(marked, r"(?<=[.!?:;])[\x20\x09-\x0D]+", f" {_END} ")
    marked = F.regexp_replace(marked, rf"\n[^\p{{L}}\p{{M}}\p{{N}}\n{_END}]*(?=\n)", f" {_END} ")
    marked = F.regexp_replace(marked, "\n", f" {_LINE} ")
    return F.concat(F.lit(f"{_END} "), F.trim(F.regexp_replace(marked, rf"[^\p{{L}}\p{{M}}\p{{N}}{_END}{_LINE}]+", " ")), F.lit(f" {_END}"))


def recognise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              sentences: dict[str, str] = SENTENCES, rules=RULES) -> DataFrame:
    """One row per input row: ``doc_id, sentence_ids`` (array, in text order)
    and ``licences`` (array, sorted, each once).

    A sentence stands between ends of sentences or lines and may be wrapped
    over lines behind comment marks. Known sentences may be split by the
    sentence rule; each part has an identifier ``name/part`` and the rules
    ask for the parts in order. Notices ('This file is released under the
    MIT License.', 'License: MIT', 'MIT licensed', the GNU headers) have ``notice/LICENCE`` for each of up to four
    licences they list. The identifiers of SPDX lines, as written there, stand last as
    ``spdx/LICENCE``. Null or empty text: empty arrays. Null and repeated
    ids and rows stay; other input columns are not carried; an empty table gives an empty result; ties cannot occur, as
    sentences stand in text order and licences in that of their names."""
    import re

    parts, order, known = {}, {}, {}
    for name, s in sentences.items():
        split = [p for p in (_normal(x) for x in re.split(r"\n|(?<=[.!?:;])\s+", s)) if p]
        for i, p in enumerate(split):
            parts.setdefault(p, f"{name}/{i}")
        order[name] = [parts[p] for p in split]
        known.setdefault(" ".join(split), " ".join(order[name]))
    known = parts | known
    held = {}
    for name, s in HELD.items():
        held[name] = " ".join(_normal(x) if x != "*" else r"\w+(?: \w+){0,9}?" for x in re.split(r"(\*)", s) if x)
        order.setdefault(name, [f"{name}/0"])  # the same identifier as a sentence of this name
    names = {n: licence for licence, all_names in NAMES.items() for n in all_names.split("|")}
    one_name = "|".join(sorted((f"{n}" for n in names), key=len, reverse=True))
    # "licence" and "version" may stand inside a name, before its number
    loose = re.sub(r" (?=v?\d)", " (?:licen[cs]e )?(?:version )?", one_name)
    later = r"(?: or (?:any )?(?:later|newer)(?: versions?)?)?"
    each = rf"(?:{loose})(?: licen[cs]es?)?{later}"
    # up to four licences in one notice
    many = rf"(?:either )?(?:of )?(?:the |a )?(?:{each})(?: (?:and|or|and or)(?: the| a| either| under)* (?:{each})){{0,3}}(?: licen[cs]es?)?(?: at your (?:option|choice))?"
    notice = (rf"(?:(?:{_SUBJECT}{_UNDER}|licen[cs]e(?: is)? (?:{_END} )?(?:the )?)({many})(?: see (?:\w+ ){{0,6}}(?:details|information|licen[cs]e))?"
              rf"|{_SUBJECT}({many}) licen[cs]ed)")
    whole = sorted((re.escape(p).replace(r"\ ", " ") for p in known), key=len, reverse=True)
    gaps = "|".join([*whole, *held.values(), _GNU, notice]).replace(" ", _GAP)
    pattern = rf"(?<=[{_END}{_LINE}]\x20)(?:{gaps})(?=\x20[{_END}{_LINE}])"
    ids_of = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    licence_of = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    gnu_of = F.create_map(*[F.lit(x) for kv in (("general", "GPL"), ("lesser general", "LGPL"), ("library general", "LGPL"), ("affero general", "AGPL"))
                            for x in kv])

    def identified(m):
        gnu = F.concat(F.lit("notice/"), F.element_at(gnu_of, F.regexp_extract(m, _GNU, 1)), F.lit("-"), F.regexp_extract(m, _GNU, 2), F.lit("."),
                       F.when(F.regexp_extract(m, _GNU, 3) == "", "0").otherwise(F.regexp_extract(m, _GNU, 3)),
                       F.when(F.regexp_extract(m, _GNU, 4) == "", "").otherwise("-or-later"))
        block = F.concat(F.regexp_extract(m, f"^{notice}$", 1), F.regexp_extract(m, f"^{notice}$", 2))

        def one(found):
            name = F.regexp_replace(F.regexp_extract(found, f"^({loose})", 1), r" licen[cs]e(?= )| version(?= )", "")
            licence = F.element_at(licence_of, name)
            return F.concat(F.lit("notice/"), licence, F.when(licence.contains("GPL") & found.rlike(" or (?:any )?(?:later|newer)"), "-or-later").otherwise(""))

        listed = F.array_join(F.transform(F.regexp_extract_all(block, F.lit(each), F.lit(0)), one), " ")
        return F.coalesce(F.element_at(ids_of, m), *[F.when(m.rlike(f"^{r}$"), f"{n}/0") for n, r in held.items()],
                          F.when(m.rlike(f"^{_GNU}$"), gnu), F.when(listed != "", listed))

    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"))
    found = F.regexp_extract_all(_marked(F.col("_text")), F.lit(pattern), F.lit(0))
    df = df.withColumn("_found", F.when(F.col("_text").rlike(f"(?i){_ANCHORS}"), found).otherwise(F.array().cast("array<string>")))
    tags = F.flatten(F.transform(F.regexp_extract_all("_text", F.lit(_SPDX), F.lit(1)), lambda x: F.regexp_extract_all(
        F.regexp_replace(x, r"\bWITH[\x20\t]+\S+|\b(?:AND|OR)\b", " "), F.lit("[A-Za-z0-9][A-Za-z0-9.+-]*"), F.lit(0))))
    df = df.withColumn("_tags", F.when(F.col("_text").contains("-"), tags).otherwise(F.array().cast("array<string>")))

    # a mark at the end of "License:" belongs to its pattern, others are gaps
    plain = F.transform("_found", lambda m: F.regexp_replace(F.regexp_replace(m, f" {_LINE}", ""), f"(?<!^licen[cs]e) {_END}", ""))
    ids = F.flatten(F.transform(F.filter(F.transform(plain, lambda m: F.coalesce(identified(m), identified(F.regexp_replace(m, f" {_END}", "")))),
                                         lambda i: i.isNotNull()), lambda i: F.split(i, " ")))
    df = df.select("doc_id", F.concat(ids, F.transform("_tags", lambda t: F.concat(F.lit("spdx/"), t))).alias("sentence_ids"))
    df = df.withColumn("_seq", F.concat(F.lit(" "), F.array_join("sentence_ids", " "), F.lit(" ")))

    def in_order(wanted):
        return F.col("_seq").rlike(" " + "(?:.* )?".join(re.escape(i) + " " for n in wanted for i in order[n]))

    hits = [F.when(in_order(wanted), F.lit(licence)) for licence, wanted in rules]
    named = F.transform(F.filter("sentence_ids", lambda i: i.rlike("^(?:notice|spdx)/")), lambda i: F.substring_index(i, "/", -1))
    df = df.withColumn("_hits", F.concat(F.array_compact(F.array(*hits)), named))
    more = [F.when(in_order(wanted) & ~F.array_contains("_hits", but), F.lit(licence)) for licence, wanted, but in SHORTER]
    found = F.array_sort(F.array_distinct(F.concat("_hits", F.array_compact(F.array(*more)))))
    return df.select("doc_id", "sentence_ids", found.alias("licences"))
