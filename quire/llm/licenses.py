"""License scans by sentence-rule recognition, with built-in expressions only.

A text is cut into sentences, each is normalised (A-Z lower-cased, every other run of characters
than letters and digits one space) and looked up among known license sentences, those of full
licenses as they are published included; what is unknown is dropped.  Lines end a sentence, too, but
a known sentence may run over any number of them.  The sequence of identifiers left is matched against the license rules in order, the
more specific before the more general, and a matched stretch is used up.  It is one projection over
the documents: neither join nor shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Sentence = tuple[str, str]
#: Identifier and text of the known sentences; the text is normalised as documents are.
SENTENCES: tuple[Sentence, ...] = (
    ("CC-BY-NC-4", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4", "Licensed under CC BY-SA 4.0"),
    ("GPL-3-ref", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-2-ref", "This work is licensed under the GNU General Public License, version 2"),
    ("Apache-2-ref", "Licensed under the Apache License, Version 2.0"),
    ("Apache-not-except", "You may not use this file except in compliance with the License"),
    ("Apache-copy-at", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-as-is", "See the License for the specific language governing permissions and limitations under the License"),
    ("MIT-ref", "Released under the MIT License"),
    ("MIT-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT-notice", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("as-is", "The software is provided \"as is\", without warranty of any kind"),
    ("BSD-redistribution", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-source", "Redistributions of source code must retain the above copyright notice"),
    ("BSD-binary", "Redistributions in binary form must reproduce the above copyright notice"),
    ("BSD-endorse", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse products"),
    ("GPL-free", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("GPL-no-warranty", "This program is distributed in the hope that it will be useful, but without any warranty"),
)
#: License and the identifiers that make it, in the order of the trials.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Apache-2.0", ("Apache-2-ref", "Apache-not-except", "Apache-copy-at", "Apache-as-is")),
    ("BSD-3-Clause", ("BSD-redistribution", "BSD-source", "BSD-binary", "BSD-endorse")),
    ("BSD-2-Clause", ("BSD-redistribution", "BSD-source", "BSD-binary")),
    ("MIT", ("MIT-grant", "MIT-notice", "as-is")),
    ("MIT", ("MIT-grant", "MIT-notice")),
    ("GPL", ("GPL-free", "GPL-no-warranty")),
    ("GPL", ("GPL-free",)),
    ("GPL-3.0", ("GPL-3-ref",)),
    ("GPL-2.0", ("GPL-2-ref",)),
    ("Apache-2.0", ("Apache-2-ref",)),
    ("MIT", ("MIT-ref",)),
    ("CC-BY-NC-4.0", ("CC-BY-NC-4",)),
    ("CC-BY-SA-4.0", ("CC-BY-SA-4",)),
    ("CC-BY-4.0", ("CC-BY-4",)),
)
#: Sentences of the full licenses, as published and with the usual variants; a list's number or a
#: heading that a text without line feeds leaves at a sentence's end is part of a variant.
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions"
)
_MIT_NOTICE = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"
_MIT_NOTICE_NEXT = "The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the Software"
_MIT_AS_IS = "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement"
_MIT_LIABLE = (
    "In no event shall the {} be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, "
    "arising from, out of or in connection with the software or the use or other dealings in the software"
)
_BSD_MET = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
_BSD_SOURCE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"
_BSD_BINARY = (
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution"
)
_BSD_ENDORSE = "may be used to endorse or promote products derived from this software without specific prior written permission"
_BSD_AS_IS = (
    "This software is provided by the {} \"as is\" and any express or implied warranties, including, but not limited to, "
    "the implied warranties of merchantability and fitness for a particular purpose are disclaimed"
)
_BSD_LIABLE = (
    "In no event shall the {} be liable for any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services; "
    "loss of use, data, or profits; or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or otherwise) "
    "arising in any way out of the use of this software, even if advised of the possibility of such damage"
)
_APACHE_REF = "Licensed under the Apache License, Version 2.0 (the \"License\")"
_APACHE_EXCEPT = "you may not use this file except in compliance with the License"
_APACHE_AT = "You may obtain a copy of the License at {}://www.apache.org/licenses/LICENSE-2.0"
_APACHE_UNLESS = (
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
    "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"
)
_GPL_FREE = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"
_GPL_WARRANTY = "This program is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose"
_HOLDERS = ("copyright holder", "copyright holders", "copyright owner", "author", "authors", "regents")
_GNU_TERMS = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} General Public License as published by the Free Software Foundation, {}"
_ISC_GRANT = "Permission to use, copy, modify, and{} distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"
_ISC_AS_IS = "The software is provided \"as is\" and {} disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"
_ISC_LIABLE = (
    "In no event shall {} be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use, data or profits, "
    "whether in an action of contract, negligence or other tortious action, arising out of or in connection with the use or performance of this software"
)
_MPL_COPY = "If a copy of the MPL was not distributed with this file, You can obtain one at {}://mozilla.org/MPL/2.0/"
_CC = {"": "CC-BY-4.0", "-ShareAlike": "CC-BY-SA-4.0", "-NonCommercial": "CC-BY-NC-4.0", "-NoDerivatives": "CC-BY-ND-4.0", "-NonCommercial-ShareAlike": "CC-BY-NC-SA-4.0", "-NonCommercial-NoDerivatives": "CC-BY-NC-ND-4.0"}
FULL_SENTENCES: tuple[Sentence, ...] = (
    *[
        (f"{key}-free-{n}", _GNU_TERMS.format(kind, which.format(n)))
        for key, kind, versions in (("LGPL", "Lesser", ("2.1", "3")), ("LGPL", "Library", ("2",)), ("AGPL", "Affero", ("3",)))
        for n in versions
        for which in ("either version {} of the License, or (at your option) any later version", "version {} of the License", "version {}")
    ],
    *[("LGPL-copy", f"You should have received a copy of the GNU Lesser General Public License along with this {x}{end}") for x in ("library", "program") for end in ("", "; if not, see http://www.gnu.org/licenses/", "; if not, see https://www.gnu.org/licenses/")],
    ("AGPL-copy", "You should have received a copy of the GNU Affero General Public License along with this program"),
    *[("ISC-grant", _ISC_GRANT.format(x)) for x in ("/or", "")],
    *[(key, text.format(who)) for key, text in (("ISC-as-is", _ISC_AS_IS), ("ISC-liable", _ISC_LIABLE)) for who in ("the author", "the authors", "isc")],
    ("MPL-ref", "This Source Code Form is subject to the terms of the Mozilla Public License, v"),
    *[("MPL-copy", _MPL_COPY.format(x)) for x in ("http", "https")],
    ("Unlicense-free", "This is free and unencumbered software released into the public domain"),
    ("Zlib-grant", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1"),
    ("Zlib-grant", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    *[(f"CC-{name}", f"This work is licensed under {a} Creative Commons Attribution{more} 4.0 International License") for more, name in _CC.items() for a in ("a", "the")],
    *[(f"SPDX-{name}", f"SPDX-License-Identifier: {name}") for name in ("MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-or-later", "Unlicense", "Zlib")],
    ("MIT-grant", _MIT_GRANT),
    ("MIT-grant-notice", f"{_MIT_GRANT}: {_MIT_NOTICE}"),
    ("MIT-grant-notice", f"{_MIT_GRANT}: {_MIT_NOTICE_NEXT}"),
    ("MIT-notice", _MIT_NOTICE_NEXT),
    ("as-is", _MIT_AS_IS),
    ("as-is", _MIT_AS_IS.replace("noninfringement", "non-infringement")),
    *[("MIT-liable", _MIT_LIABLE.format(who)) for who in ("authors or copyright holders", "author or copyright holders", "authors or copyright holder", "copyright holders", "authors")],
    *[("BSD-redistribution", f"{_BSD_MET}{end}") for end in ("", ": 1", ": a")],
    *[("BSD-source", f"{n}{_BSD_SOURCE}{end}") for n in ("", "1 ", "a ") for end in ("", "; and")],
    *[("BSD-binary", f"{n}{_BSD_BINARY}{end}") for n in ("", "2 ", "b ") for end in ("", "; and")],
    *[("BSD-endorse", f"{n}Neither the name of the copyright holder nor the names of its contributors {_BSD_ENDORSE}") for n in ("", "3 ", "c ")],
    *[("BSD-endorse", f"The name of the {who} may not be used to endorse or promote products derived from this software without specific prior written permission") for who in ("author", "authors", "copyright holder")],
    *[("BSD-as-is", _BSD_AS_IS.format(f"{who}{more}")) for who in _HOLDERS for more in ("", " and contributors", " or contributors")],
    *[("BSD-liable", _BSD_LIABLE.format(f"{who}{more}")) for who in _HOLDERS for more in ("", " or contributors", " and contributors")],
    ("Apache-2-ref", _APACHE_REF),
    ("Apache-2-head", f"{_APACHE_REF}; {_APACHE_EXCEPT}"),
    ("Apache-2-head", f"Licensed under the Apache License, Version 2.0; {_APACHE_EXCEPT}"),
    *[("Apache-copy-at", _APACHE_AT.format(p) + end) for p in ("http", "https") for end in ("", " " + _APACHE_UNLESS)],
    ("Apache-copy-at", _APACHE_AT.format("https").replace("www.", "")),
    ("Apache-unless", _APACHE_UNLESS),
    *[
        ("GPL-free", f"{_GPL_FREE} as published by the Free Software Foundation, {which}")
        for n in "23"
        for which in (f"either version {n} of the License, or (at your option) any later version", f"version {n} of the License", f"version {n}", f"either version {n} of the License")
    ],
    ("GPL-no-warranty", _GPL_WARRANTY),
    *[("GPL-copy", f"You should have received a copy of the GNU General Public License along with this program{end}") for end in ("", "; if not, see http://www.gnu.org/licenses/", "; if not, see https://www.gnu.org/licenses/")],
)
#: Rules with the sentences that only the full licenses have; they go before RULES.
FULL_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    *[
        ("Apache-2.0", (*head, "Apache-copy-at", *unless, "Apache-as-is"))
        for head in (("Apache-2-ref", "Apache-not-except"), ("Apache-2-head",))
        for unless in (("Apache-unless",), ())
        if unless or head == ("Apache-2-head",)
    ],
    ("Apache-2.0", ("Apache-2-head",)),
    *[
        (name, ("BSD-redistribution", "BSD-source", "BSD-binary", *endorse, "BSD-as-is", *liable))
        for name, endorse in (("BSD-3-Clause", ("BSD-endorse",)), ("BSD-2-Clause", ()))
        for liable in (("BSD-liable",), ())
    ],
    *[
        ("MIT", (*grant, *rest))
        for grant in (("MIT-grant", "MIT-notice"), ("MIT-grant-notice",))
        for rest in (("as-is", "MIT-liable"), ("as-is",), ())
        if rest == ("as-is", "MIT-liable") or grant == ("MIT-grant-notice",)
    ],
    ("GPL", ("GPL-free", "GPL-no-warranty", "GPL-copy")),
    *[
        (name, (key, *rest))
        for name, key, copy in (("LGPL-2.0", "LGPL-free-2", "LGPL-copy"), ("LGPL-2.1", "LGPL-free-2.1", "LGPL-copy"), ("LGPL-3.0", "LGPL-free-3", "LGPL-copy"), ("AGPL-3.0", "AGPL-free-3", "AGPL-copy"))
        for rest in (("GPL-no-warranty", copy), ("GPL-no-warranty",), ())
    ],
    *[("ISC", ("ISC-grant", *rest)) for rest in (("ISC-as-is", "ISC-liable"), ("ISC-as-is",), ())],
    ("MPL-2.0", ("MPL-ref", "MPL-copy")),
    ("MPL-2.0", ("MPL-ref",)),
    ("Unlicense", ("Unlicense-free",)),
    ("Zlib", ("Zlib-grant",)),
    *[(name, (f"CC-{name}",)) for name in _CC.values()],
    *[(key.removeprefix("SPDX-"), (key,)) for key, _ in FULL_SENTENCES if key.startswith("SPDX-")],
)
#: Names that licensors put in: pattern on the normalised text, and what stands for it above.
NAMES: tuple[Sentence, ...] = (
    ("neither the name of (?:[a-z0-9LS]+ ){1,16}?nor (?:L )*the (?:L )*names (?:L )*of (?:L )*(?:its|their|the|any) (?:L )*contributors ", "neither the name of the copyright holder nor the names of its contributors "),
    ("(?<=[SL] )(?:[a-z0-9]+ ){1,8}?is (?:L )*free (?:L )*software (?:L )*you (?:L )*can ", "this program is free software you can "),
    ("(?<=[SL] )(?:[a-z0-9]+ ){1,8}?is (?:L )*distributed (?:L )*in (?:L )*the (?:L )*hope ", "this program is distributed in the hope "),
    ("general (?:L )*public (?:L )*license (?:L )*along (?:L )*with (?:[a-z0-9L]+ ){1,8}?(?=[SL] |if not see)", "general public license along with this program "),
)
#: Nearly every known sentence holds one of these; texts without any anchor of the sentences need not be cut.
ANCHORS = ("licen", "permission", "redistribut", "warrant", "endorse", "software")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Between sentences: their closing marks before white space or the end.
BOUNDARY = r"[.!?]+(?:[ \t\r]+|(?=\n)|$)"


def normalised(sentence: str) -> str:
    """A known sentence in the form in which texts are looked up."""
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in sentence.lower()).split())


def anchors_of(sentences: tuple[Sentence, ...]) -> list[str]:
    """Strings of which every sentence holds one: of ``ANCHORS`` those that occur, of any other sentence its longest word."""
    plain = [normalised(sentence) for _, sentence in sentences]
    rest = {max(x.split(), key=len) for x in plain if x and not any(a in x for a in ANCHORS)}
    return [a for a in ANCHORS if any(a in x for x in plain)] + sorted(rest)


def known_sentences(text: Column, sentences: tuple[Sentence, ...] = SENTENCES + FULL_SENTENCES) -> Column:
    """Identifiers of a text's known sentences, in order; none for a null text."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    # in the lower-cased text, S stands for the end of a sentence and L for that of a line
    marked = F.replace(F.regexp_replace(lower, BOUNDARY, " S "), F.lit("\n"), F.lit(" L "))
    clean = F.concat(F.lit("S "), F.trim(F.regexp_replace(marked, "[^a-z0-9SL]+", " ")), F.lit(" S"))
    for pattern, name in NAMES:
        clean = F.regexp_replace(clean, pattern, name)
    table = {normalised(sentence): key for key, sentence in sentences}
    over_lines = "|".join(k.replace(" ", " (?:L )*") for k in sorted(table, key=len, reverse=True))
    units = F.regexp_extract_all(clean, F.lit(f"(?<=[SL] )(?:{over_lines})(?= [SL])"), F.lit(0))
    keys = F.create_map(*[F.lit(x) for item in table.items() for x in item])
    found = F.transform(units, lambda s: F.element_at(keys, F.replace(s, F.lit(" L"), F.lit(""))))
    return F.when(lower.rlike("|".join(anchors_of(sentences))), found).otherwise(F.array().cast("array<string>"))


def matched_licenses(identifiers: Column, rules: tuple[tuple[str, tuple[str, ...]], ...] = FULL_RULES + RULES) -> Column:
    """(left, found): the identifiers that no rule used, as one string, and the licenses in rule order."""
    table = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f"<{k}>" for k in keys)).alias("keys")) for name, keys in rules])
    start = F.struct(F.array_join(F.transform(identifiers, lambda k: F.concat(F.lit("<"), k, F.lit(">"))), "").alias("left"), F.array().cast("array<string>").alias("found"))

    def tried(state: Column, rule: Column) -> Column:
        fits = F.contains(state["left"], rule["keys"])
        return F.struct(
            F.when(fits, F.replace(state["left"], rule["keys"], F.lit("|"))).otherwise(state["left"]).alias("left"),
            F.when(fits, F.array_union(state["found"], F.array(rule["name"]))).otherwise(state["found"]).alias("found"),
        )

    return F.aggregate(table, start, tried)


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_known, sentences and licenses (both comma-joined) and n_unused.

    ``sentences`` are the known ones in order, ``licenses`` each license once, in rule order, and
    n_unused the known sentences that no rule used.  A known sentence may be wrapped, in a comment, too,
    if its lines begin with other marks than letters and digits.  The query's SQL knows SENTENCES and
    RULES alone, each sentence on one line.  Null and empty texts have none; texts of any length are
    read whole; repeated rows come out as often as they came in; other columns are ignored; an empty
    table gives no rows.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), known_sentences(F.col("text")).alias("ids"))
    matched = known.select("doc_id", "ids", F.when(F.size("ids") > 0, matched_licenses(F.col("ids"))).alias("m"))
    return matched.select(
        "doc_id", F.size("ids").cast("long").alias("n_known"), F.array_join("ids", ",").alias("sentences"),
        F.coalesce(F.array_join("m.found", ","), F.lit("")).alias("licenses"),
        F.coalesce(F.regexp_count("m.left", F.lit("<")), F.lit(0)).cast("long").alias("n_unused"),
    )
