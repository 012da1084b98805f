"""Licence recognition: sentences to identifiers, identifier sequences to licences.

A text is cut into sentences twice, with its line breaks as spaces (wrapped
licence texts) and as boundaries (one-line notices). Normalised sentences that
are known get an identifier; a licence is found where its identifiers follow
each other in order, with at most ``MAX_GAP`` other sentences, known or not, in
between; sentences further apart are taken to be of different texts. The longest
rule wins: what it matched is taken out before a rule that is its beginning is
tried. A reservation of all rights counts only without a licence beside it. Names in
SPDX-License-Identifier lines are read one by one, however they are combined.

Everything is one projection over built-in functions: no shuffle. Null and empty
texts have no sentence; an empty table gives an empty result. Very long texts are read
whole. Repeated rows get equal results. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

MAX_GAP = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Sentences of published licences and notices, lower case, runs of other characters as one space.
SENTENCES = {
    "reserved": "all rights reserved",
    "apache_short": "licensed under the apache license version 2 0",
    "apache_header": "licensed under the apache license version 2 0 the license",
    "apache_comply": "you may not use this file except in compliance with the license",
    "apache_copy": "you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
                   "applicable law or agreed to in writing software distributed under the license is distributed on an "
                   "as is basis without warranties or conditions of any kind either express or implied",
    "apache_see": "see the license for the specific language governing permissions and limitations under the license",
    "mit_short": "released under the mit license",
    "mit_under": "licensed under the mit license",
    "mit_this": "this project is licensed under the mit license",
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                 "associated documentation files the software to deal in the software without restriction including "
                 "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies "
                 "of the software and to permit persons to whom the software is furnished to do so subject to the "
                 "following conditions the above copyright notice and this permission notice shall be included in all "
                 "copies or substantial portions of the software",
    "mit_warranty": "the software is provided as is without warranty of any kind express or implied including but not "
                    "limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit_liability": "in no event shall the authors or copyright holders be liable for any claim damages or other "
                     "liability whether in an action of contract tort or otherwise arising from out of or in connection "
                     "with the software or the use or other dealings in the software",
    "isc_grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
                 "hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc_warranty": "the software is provided as is and the author disclaims all warranties with regard to this software "
                    "including all implied warranties of merchantability and fitness",
    "bsd_grant": "redistribution and use in source and binary forms with or without modification are permitted provided "
                 "that the following conditions are met 1",
    "bsd_joint": "redistribution and use in source and binary forms with or without modification are permitted provided that "
                 "the following conditions are met redistributions of source code must retain the above copyright notice "
                 "this list of conditions and the following disclaimer",
    "bsd_source": "redistributions of source code must retain the above copyright notice this list of conditions and the "
                  "following disclaimer",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and "
                  "the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd_names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                 "promote products derived from this software without specific prior written permission",
    "gpl3_work": "this work is licensed under the gnu general public license version 3",
    "gpl3_under": "licensed under the gnu general public license version 3",
    "gpl2_program": "this program is free software",
    "gpl2_terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
                  "the free software foundation",
    "gpl2_version": "either version 2 of the license or at your option any later version",
    "lgpl_library": "this library is free software",
    "lgpl_terms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as "
                  "published by the free software foundation",
    "lgpl21_version": "either version 2 1 of the license or at your option any later version",
    "gpl3_version": "either version 3 of the license or at your option any later version",
    "agpl_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero "
                 "general public license as published by the free software foundation either version 3 of the license or at "
                 "your option any later version",
    "epl2_terms": "this program and the accompanying materials are made available under the terms of the eclipse public "
                  "license 2 0 which is available at https www eclipse org legal epl 2 0",
    "epl2_terms_plain": "this program and the accompanying materials are made available under the terms of the eclipse public "
                        "license 2 0 which is available at http www eclipse org legal epl 2 0",
    "gpl_title": "gnu general public license",
    "lgpl_title": "gnu lesser general public license",
    "agpl_title": "gnu affero general public license",
    "gpl2_date": "version 2 june 1991",
    "gpl3_date": "version 3 29 june 2007",
    "lgpl21_date": "version 2 1 february 1999",
    "agpl3_date": "version 3 19 november 2007",
    "apache_title": "apache license",
    "apache_date": "version 2 0 january 2004",
    "mpl_title": "mozilla public license version 2 0",
    "epl_title": "eclipse public license v 2 0",
    "cc0_title": "cc0 1 0 universal",
    "gpl_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                "general public license as published by the free software foundation either version 3 of the license or "
                "at your option any later version",
    "gpl_hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl_without": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl_see": "see the gnu general public license for more details",
    "mpl_terms": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl_copy": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "cc_by": "licensed under cc by 4 0",
    "cc_by_sa": "licensed under cc by sa 4 0",
    "cc_by_nc": "licensed under cc by nc 4 0",
    "cc0": "this work is released under cc0 1 0",
    "unlicense_free": "this is free and unencumbered software released into the public domain",
    "unlicense_anyone": "anyone is free to copy modify publish use compile sell or distribute this software either in "
                        "source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
}


@dataclass(frozen=True)
class Rule:
    """A licence whose sentences follow each other in this order."""

    license: str
    sentences: tuple[str, ...]


#: Ordered licence rules; a licence may have several.
RULES = (
    Rule("Apache-2.0", ("apache_short",)),
    Rule("Apache-2.0", ("apache_header", "apache_comply")),
    Rule("MIT", ("mit_short",)),
    Rule("MIT", ("mit_under",)),
    Rule("MIT", ("mit_this",)),
    Rule("MIT", ("mit_grant", "mit_warranty")),
    Rule("ISC", ("isc_grant", "isc_warranty")),
    Rule("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    Rule("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_names")),
    Rule("BSD-2-Clause", ("bsd_joint", "bsd_binary")),
    Rule("BSD-3-Clause", ("bsd_joint", "bsd_binary", "bsd_names")),
    Rule("GPL-2.0", ("gpl2_program", "gpl2_terms", "gpl2_version")),
    Rule("GPL-2.0", ("gpl_title", "gpl2_date")),
    Rule("LGPL-2.1", ("lgpl_library", "lgpl_terms", "lgpl21_version")),
    Rule("LGPL-2.1", ("lgpl_title", "lgpl21_date")),
    Rule("LGPL-3.0", ("lgpl_library", "lgpl_terms", "gpl3_version")),
    Rule("LGPL-3.0", ("lgpl_title", "gpl3_date")),
    Rule("AGPL-3.0", ("agpl_free",)),
    Rule("AGPL-3.0", ("agpl_title", "agpl3_date")),
    Rule("EPL-2.0", ("epl2_terms",)),
    Rule("EPL-2.0", ("epl2_terms_plain",)),
    Rule("EPL-2.0", ("epl_title",)),
    Rule("Apache-2.0", ("apache_title", "apache_date")),
    Rule("MPL-2.0", ("mpl_title",)),
    Rule("CC0-1.0", ("cc0_title",)),
    Rule("GPL-3.0", ("gpl_title", "gpl3_date")),
    Rule("GPL-3.0", ("gpl3_work",)),
    Rule("GPL-3.0", ("gpl3_under",)),
    Rule("GPL-3.0", ("gpl_free", "gpl_hope", "gpl_without", "gpl_see")),
    Rule("MPL-2.0", ("mpl_terms", "mpl_copy")),
    Rule("CC-BY-4.0", ("cc_by",)),
    Rule("CC-BY-SA-4.0", ("cc_by_sa",)),
    Rule("CC-BY-NC-4.0", ("cc_by_nc",)),
    Rule("CC0-1.0", ("cc0",)),
    Rule("Unlicense", ("unlicense_free", "unlicense_anyone")),
    Rule("Proprietary", ("reserved",)),
)

#: Licences that count only where no other is found.
ALONE = ("Proprietary",)

#: Identifiers of the SPDX licence list, and the licence that each means here.
SPDX = {
    "apache-2.0": "Apache-2.0", "mit": "MIT", "isc": "ISC", "bsd-2-clause": "BSD-2-Clause", "bsd-3-clause": "BSD-3-Clause",
    "gpl-2.0": "GPL-2.0", "gpl-2.0-only": "GPL-2.0", "gpl-2.0-or-later": "GPL-2.0", "gpl-2.0+": "GPL-2.0",
    "gpl-3.0": "GPL-3.0", "gpl-3.0-only": "GPL-3.0", "gpl-3.0-or-later": "GPL-3.0", "gpl-3.0+": "GPL-3.0",
    "lgpl-2.1": "LGPL-2.1", "lgpl-2.1-only": "LGPL-2.1", "lgpl-2.1-or-later": "LGPL-2.1", "lgpl-2.1+": "LGPL-2.1",
    "lgpl-3.0": "LGPL-3.0", "lgpl-3.0-only": "LGPL-3.0", "lgpl-3.0-or-later": "LGPL-3.0", "lgpl-3.0+": "LGPL-3.0",
    "agpl-3.0": "AGPL-3.0", "agpl-3.0-only": "AGPL-3.0", "agpl-3.0-or-later": "AGPL-3.0", "agpl-3.0+": "AGPL-3.0",
    "mpl-2.0": "MPL-2.0", "epl-2.0": "EPL-2.0", "cc-by-4.0": "CC-BY-4.0", "cc-by-sa-4.0": "CC-BY-SA-4.0",
    "cc-by-nc-4.0": "CC-BY-NC-4.0", "cc0-1.0": "CC0-1.0", "unlicense": "Unlicense",
}
#: The rest of a line after the tag, in Java's and RE2's syntax; its names are runs of `SPDX_NAME`.
SPDX_LINE = r"SPDX-License-Identifier:([^\n\r]*)"
SPDX_BETWEEN = r"[^a-z0-9.+-]+"


def longer(rules: tuple[Rule, ...] = RULES) -> dict[tuple[str, ...], list[Rule]]:
    """For each rule's sentences the rules that go on after them."""
    return {r.sentences: [x for x in rules if len(x.sentences) > len(r.sentences) and x.sentences[:len(r.sentences)] == r.sentences]
            for r in rules}


def beaten_by(rules: tuple[Rule, ...] = RULES) -> list[tuple[str, str]]:
    """(licence, licence of a rule that goes on after one of its rules)."""
    found = longer(rules)
    return sorted({(r.license, x.license) for r in rules for x in found[r.sentences] if x.license != r.license})


def sequence_pattern(rule: Rule) -> str:
    """Regex of the rule over a sequence such as ``,mit_grant,-,mit_warranty,``."""
    return "," + (",([^,]+,){0,%d}" % MAX_GAP).join(rule.sentences) + ","


def sentences(text: Column, wrapped: bool) -> Column:
    """Normalised sentences; line breaks are spaces if ``wrapped``, else boundaries."""
    t = F.regexp_replace(text, r"[\x20\x09-\x0D]*\n[\x20\x09-\x0D]*", " ") if wrapped else text
    parts = F.split(F.regexp_replace(t, r"([.!?;])[\x20\x09-\x0D]+", "$1\n"), "\n", -1)
    return F.transform(parts, lambda s: F.btrim(F.regexp_replace(F.translate(s, UPPER, LOWER), "[^a-z0-9]+", " ")))


def identifiers(text: Column, wrapped: bool, known: dict[str, str] = SENTENCES) -> Column:
    """Identifiers of the non-empty sentences in order, ``-`` for an unknown one."""
    names = F.create_map(*[F.lit(x) for k, v in known.items() for x in (v, k)])
    return F.transform(F.filter(sentences(text, wrapped), lambda s: s != ""),
                       lambda s: F.coalesce(F.try_element_at(names, s), F.lit("-")))


def spdx(text: Column) -> Column:
    """Known names in the text's SPDX lines, as licences."""
    names = F.create_map(*[F.lit(x) for k, v in SPDX.items() for x in (k, v)])
    lines = F.regexp_extract_all(text, F.lit(SPDX_LINE), F.lit(1))
    words = F.flatten(F.transform(lines, lambda x: F.split(F.translate(x, UPPER, LOWER), SPDX_BETWEEN)))
    return F.filter(F.transform(words, lambda w: F.try_element_at(names, w)), lambda x: x.isNotNull())


def recognise(docs: DataFrame, rules: tuple[Rule, ...] = RULES, known: dict[str, str] = SENTENCES, text: str = "text",
              key: str = "doc_id") -> DataFrame:
    """One row per document: key, ``n_known`` (known sentences, the larger of both cuts) and ``licenses`` (sorted)."""
    t = F.coalesce(F.col(text), F.lit(""))
    after = longer(rules)

    def matches(sequence: Column, rule: Rule) -> Column:
        for x in after[rule.sentences]:
            sequence = F.regexp_replace(sequence, sequence_pattern(x), ",")
        return sequence.rlike(sequence_pattern(rule))

    def judge(ids: Column) -> Column:
        sequence = F.concat(F.lit(","), F.array_join(ids, ","), F.lit(","))
        found = let(sequence, lambda s: F.array_distinct(F.filter(
            F.array(*[F.when(matches(s, r), F.lit(r.license)) for r in rules]), lambda x: x.isNotNull())))
        n = F.size(F.filter(ids, lambda x: x != "-"))
        none = F.array().cast("array<string>")
        return F.struct(n.cast("long").alias("n"), F.when(n > 0, found).otherwise(none).alias("found"))

    views = docs.select(F.col(key), *[let(identifiers(t, w, known), judge).alias(v) for v, w in (("a", True), ("b", False))],
                        spdx(t).alias("named"))
    # A cut that shows the longer licence and not the shorter one tells that the other cut's shorter one is its beginning.
    whole = F.array_union("a.found", "b.found")
    for short, long in beaten_by(rules):
        only_long = [F.array_contains(v, long) & ~F.array_contains(v, short) for v in ("a.found", "b.found")]
        whole = F.when(only_long[0] | only_long[1], F.array_remove(whole, short)).otherwise(whole)
    every = views.select(F.col(key), F.greatest("a.n", "b.n").alias("n_known"), F.array_union(whole, F.col("named")).alias("all"))
    others = F.filter("all", lambda x: ~x.isin(*ALONE))
    return every.select(key, "n_known", F.array_sort(F.when(F.size(others) > 0, others).otherwise(F.col("all"))).alias("licenses"))
