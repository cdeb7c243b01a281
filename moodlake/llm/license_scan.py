"""Licence scanning by sentence rules, in DataFrame expressions only.

A text is cut into sentences, each is normalised (a sentence may run over line
ends and comment marks), and known licence sentences become identifiers.  The identifiers of a document, in order, are matched
against licence rules, which are sequences of identifiers in order of
precedence: a rule takes its sentences out of the sequence, so that a later,
more general rule does not count them again.  (The method of sentence-based
licence identification; German, Manabe and Inoue, 2010.)

There is no shuffle: every document is scanned where it is read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known licence sentences, normalised (lower case, words only).
# Each holds one of TRIGGERS.
SENTENCES = {
    "agpl-notice": ["this program is licensed under the gnu affero general public license version 3",
                    "licensed under the gnu affero general public license version 3"],
    "all-rights": ["all rights reserved"],
    "apache-asis": ["unless required by applicable law or agreed to in writing software distributed under the license "
                    "is distributed on an as is basis without warranties or conditions of any kind either express or "
                    "implied"],
    "apache-comply": ["you may not use this file except in compliance with the license"],
    "apache-limits": ["see the license for the specific language governing permissions and limitations under the "
                      "license"],
    "apache-notice": ["licensed under the apache license version 2 0",
                      "licensed under the apache license version 2 0 the license"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions "
                   "and the following disclaimer in the documentation and or other materials provided with the "
                   "distribution"],
    "bsd-endorse": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                    "or promote products derived from this software without specific prior written permission"],
    "bsd-grant": ["redistribution and use in source and binary forms with or without modification are permitted "
                  "provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and "
                   "the following disclaimer"],
    "cc0-notice": ["to the extent possible under law the author has waived all copyright and related or neighboring "
                   "rights to this work", "released under cc0 1 0 license", "licensed under cc0 1 0"],
    "cc-by-notice": ["licensed under cc by 4 0",
                     "this work is licensed under a creative commons attribution 4 0 international license"],
    "cc-by-nc-notice": ["licensed under cc by nc 4 0",
                        "this work is licensed under a creative commons attribution noncommercial 4 0 international "
                        "license"],
    "cc-by-sa-notice": ["licensed under cc by sa 4 0",
                        "this work is licensed under a creative commons attribution sharealike 4 0 international "
                        "license"],
    "gpl-hope": ["this program is distributed in the hope that it will be useful but without any warranty"],
    "gpl2-notice": ["this work is licensed under the gnu general public license version 2",
                    "licensed under the gnu general public license version 2"],
    "gpl3-notice": ["this work is licensed under the gnu general public license version 3",
                    "licensed under the gnu general public license version 3"],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is "
                  "hereby granted provided that the above copyright notice and this permission notice appear in all "
                  "copies"],
    "mit-condition": ["the above copyright notice and this permission notice shall be included in all copies or "
                      "substantial portions of the software"],
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and "
                  "associated documentation files the software to deal in the software without restriction including "
                  "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
                  "copies of the software and to permit persons to whom the software is furnished to do so subject to "
                  "the following conditions"],
    "mit-notice": ["released under the mit license", "licensed under the mit license"],
    "mpl2-notice": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "unlicense-notice": ["this is free and unencumbered software released into the public domain license"],
}

# Licence and the identifiers that stand one after another, most specific first.
RULES = [
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("Apache-2.0", ["apache-notice", "apache-comply", "apache-asis", "apache-limits"]),
    ("Apache-2.0", ["apache-notice"]),
    ("MIT", ["mit-grant", "mit-condition"]),
    ("MIT", ["mit-notice"]),
    ("ISC", ["isc-grant"]),
    ("AGPL-3.0", ["agpl-notice", "gpl-hope"]),
    ("AGPL-3.0", ["agpl-notice"]),
    ("GPL-2.0", ["gpl2-notice", "gpl-hope"]),
    ("GPL-2.0", ["gpl2-notice"]),
    ("GPL-3.0", ["gpl3-notice", "gpl-hope"]),
    ("GPL-3.0", ["gpl3-notice"]),
    ("MPL-2.0", ["mpl2-notice"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-notice"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-notice"]),
    ("CC-BY-4.0", ["cc-by-notice"]),
    ("CC0-1.0", ["cc0-notice"]),
    ("Unlicense", ["unlicense-notice"]),
    ("Proprietary", ["all-rights"]),
]

# Sentences of the published texts that scan_sql() does not have, normalised alike.
GNU = "you can redistribute it and or modify it under the terms of the gnu {} as published by the free software foundation"
VERSION = "either version {} of the license or at your option any later version"
PUBLISHED = {
    "agpl-notice": [GNU.format("affero general public license") + " " + VERSION.format("3")],
    "agpl-terms": [GNU.format("affero general public license")],
    "bsd-advert": ["all advertising materials mentioning features or use of this software must display the following "
                   "acknowledgement"],
    "bsd-endorse": ["the name of the author may not be used to endorse or promote products derived from this software without "
                    "specific prior written permission"],
    "cc0-notice": ["to the extent possible under law the person who associated cc0 with this work has waived all copyright and "
                   "related or neighboring rights to this work", "cc0 1 0 universal"],
    "cc-by-notice": ["this work is licensed under the creative commons attribution 4 0 international license",
                     "this work is licensed under cc by 4 0"],
    "cc-by-nc-notice": ["this work is licensed under the creative commons attribution noncommercial 4 0 international license",
                        "this work is licensed under cc by nc 4 0"],
    "cc-by-sa-notice": ["this work is licensed under the creative commons attribution sharealike 4 0 international license",
                        "this work is licensed under cc by sa 4 0"],
    "gnu-2": [VERSION.format("2")],
    "gnu-2-1": [VERSION.format("2 1")],
    "gnu-3": [VERSION.format("3")],
    "gpl-hope": ["this library is distributed in the hope that it will be useful but without any warranty"],
    "gpl-terms": [GNU.format("general public license")],
    "gpl2-notice": [GNU.format("general public license") + " " + VERSION.format("2"),
                    GNU.format("general public license version 2")],
    "gpl3-notice": [GNU.format("general public license") + " " + VERSION.format("3"),
                    GNU.format("general public license version 3")],
    "lgpl-terms": [GNU.format("lesser general public license")],
    "lgpl2-1-notice": [GNU.format("lesser general public license") + " " + VERSION.format("2 1"),
                       GNU.format("lesser general public license version 2 1")],
    "lgpl3-notice": [GNU.format("lesser general public license") + " " + VERSION.format("3"),
                     GNU.format("lesser general public license version 3")],
    "mit-notice": ["the mit license mit", "licensed under the terms of the mit license",
                   "released under the terms of the mit license", "this project is licensed under the mit license",
                   "this software is released under the mit license", "distributed under the mit license"],
    "unlicense-notice": ["this is free and unencumbered software released into the public domain"],
}

# As RULES, where a notice is published in two sentences.
PUBLISHED_RULES = [(name, [terms, version, *hope]) for name, terms, version in (
    ("AGPL-3.0", "agpl-terms", "gnu-3"), ("GPL-2.0", "gpl-terms", "gnu-2"), ("GPL-3.0", "gpl-terms", "gnu-3"),
    ("LGPL-2.1", "lgpl-terms", "gnu-2-1"), ("LGPL-3.0", "lgpl-terms", "gnu-3")) for hope in (["gpl-hope"], [])]
PUBLISHED_RULES += [(name, [notice, *hope]) for name, notice in (("LGPL-2.1", "lgpl2-1-notice"), ("LGPL-3.0", "lgpl3-notice"))
                    for hope in (["gpl-hope"], [])]

# The names of an SPDX line that stand for a licence; 'GPL-2.0+' is normalised to 'gpl 2 0'.
SPDX = {name: [name] for name in dict.fromkeys(name for name, _ in [*RULES, *PUBLISHED_RULES]) if name != "Proprietary"}
for _name in SPDX:
    if "GPL" in _name:
        SPDX[_name] = [_name, f"{_name}-only", f"{_name}-or-later"]
PUBLISHED |= {f"spdx-{name}": ["spdx license identifier " + re.sub("[^a-z0-9]+", " ", form.lower()) for form in forms]
              for name, forms in SPDX.items()}
PUBLISHED_RULES += [(name, [f"spdx-{name}"]) for name in SPDX]

KNOWN = {name: SENTENCES.get(name, []) + PUBLISHED.get(name, []) for name in [*SENTENCES, *PUBLISHED]}
# the clause on advertising tells the oldest form from the shorter ones that its sentences hold; else the new rules
# take the identifiers that the old ones leave
BSD_4 = ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advert"]
ALL_RULES = [("BSD-4-Clause", [*BSD_4, "bsd-endorse"]), ("BSD-4-Clause", BSD_4), *RULES, *PUBLISHED_RULES]

# A text without any of these (in lower case) has no known sentence.  Each lies within one word,
# so that it stands in the raw text however the words are parted.
TRIGGERS = ("license", "redistribution", "reserved", "copyright", "warranty", "permission", "cc0", "unencumbered", "advertising")
WHITE = r"\x20\x09-\x0D"
SPDX_MARK = "SPDX-License-Identifier "
# from the mark, or from where the last match on the same line ended, to the next one, however long the line is
ON_SPDX_LINE = rf"((?:{SPDX_MARK}|\G(?!^))[^\x0A-\x0D]*?)"
# the holder's name in the last clause of the BSD licence, and what the known sentence has for it
HOLDER = r"neither[ ~]the[ ~]names?[ ~]of[ ~][a-z0-9 ~]+?[ ~]nor[ ~]the[ ~]names[ ~]of[ ~](?:its|any|their)[ ~]contributors"
ANY_HOLDER = "neither the name of the copyright holder nor the names of its contributors"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def written(text: Column) -> Column:
    """The words of a text in lower case, one blank between two words.  A line
    end is a tilde; a closing mark that white space follows, or a blank line (also
    one of comment marks only), is a bar: there a sentence has to end."""
    # of an SPDX line each licence is a sentence; the point of 'v. 2.0' ends none
    spdx = F.regexp_replace(text, r"(?i)\bSPDX-License-Identifier:[\x20\x09(]*", SPDX_MARK)
    spdx = F.regexp_replace(spdx, rf"(?i){ON_SPDX_LINE}[\x20\x09]+WITH[\x20\x09]+[A-Z0-9.+-]+", "$1")
    spdx = F.regexp_replace(spdx, rf"(?i){ON_SPDX_LINE}[\x20\x09)]+(?:OR|AND)[\x20\x09(]+", "$1\n\n" + SPDX_MARK)
    whole = F.when(text.rlike("(?i)SPDX-License-Identifier:"), spdx).otherwise(text)
    whole = F.regexp_replace(whole, rf"(?i)\bv\.[{WHITE}]+(?=[0-9])", "v ")
    cut = F.regexp_replace(whole, rf"([.!?;:])[{WHITE}]+", "$1\n\n")
    lines = F.regexp_replace(F.translate(cut, UPPER, LOWER), r"\x0D\x0A|[\x0B-\x0D]", "\n")
    lines = F.regexp_replace(lines, r"(?m)^[\x20\x09]*(?:rem|dnl)(?=[\x20\x09])", "")
    words = F.trim(F.regexp_replace(lines, r"[^a-z0-9\x0A]+", " "))
    ends = F.regexp_replace(F.regexp_replace(words, r" ?\x0A ?", "\n"), r"\x0A{2,}", "|")
    return F.concat(F.lit("|"), F.regexp_replace(F.translate(ends, "\n", "~"), HOLDER, ANY_HOLDER), F.lit("|"))


def sentence_ids(text: Column) -> Column:
    """The identifiers of the known sentences of a text, in order: each begins
    where a line or a sentence does, ends where one does, and may run over
    line ends between."""
    pairs = [(s, name) for name, forms in KNOWN.items() for s in forms]
    known = F.create_map(*[F.lit(x) for pair in pairs for x in pair])
    # of two sentences with one beginning the longer is taken
    longest = sorted((s for s, _ in pairs), key=len, reverse=True)
    pattern = "(?<=[|~])(?:" + "|".join(s.replace(" ", "[ ~]") for s in longest) + ")(?=[|~])"
    return F.transform(F.regexp_extract_all(written(text), F.lit(pattern), F.lit(0)),
                       lambda s: F.element_at(known, F.translate(s, "~", " ")))


def match_rules(ids: Column) -> Column:
    """A struct of the licences found (each once, in order of the rules) and
    the identifiers that no rule took, as text."""
    barred = F.concat(F.lit("|"), F.array_join(ids, "|"), F.lit("|"))
    # between two identifiers stands one bar for each, so that neighbours can both be matched
    start = F.struct(F.array().cast("array<string>").alias("licenses"), F.replace(barred, F.lit("|"), F.lit("||")).alias("rest"))
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f"|{i}|" for i in sequence)).alias("sequence"))
                      for name, sequence in ALL_RULES])

    def apply(state, rule):
        rest = F.replace(state["rest"], rule["sequence"], F.lit("|-|"))
        return F.struct(F.when(rest != state["rest"], F.array_union(state["licenses"], F.array(rule["name"])))
                        .otherwise(state["licenses"]).alias("licenses"), rest.alias("rest"))

    return F.aggregate(rules, start, apply)


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, licenses (names joined by ', ', empty if
    none), n_sentences (known sentences) and sentence_ids (joined by ' ').

    A null text is empty and has no licence; whole texts are scanned; repeated
    rows and null doc_ids give a row each; other columns are left out,
    whatever their names; an empty table gives none."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    low = F.translate(body, UPPER, LOWER)
    triggered = F.lit(False)
    for word in TRIGGERS:
        triggered = triggered | low.contains(word)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"),
                       F.when(triggered, sentence_ids(body)).otherwise(F.array().cast("array<string>")).alias("ids"))
    return rows.select("doc_id", F.array_join(match_rules(F.col("ids"))["licenses"], ", ").alias("licenses"),
                       F.size("ids").cast("long").alias("n_sentences"), F.array_join("ids", " ").alias("sentence_ids"))


def scan_sql() -> str:
    """The scan as DuckDB SQL over `documents`, one step for each rule.  It cuts
    at every line end and has neither PUBLISHED nor PUBLISHED_RULES: of a
    sentence that runs over lines, and of those, it finds nothing."""
    known = ", ".join(f"('{s}', '{name}')" for name, forms in SENTENCES.items() for s in forms)
    steps, last = [], "r0"
    for i, (name, sequence) in enumerate(RULES, 1):
        written = "".join(f"|{x}|" for x in sequence)
        steps.append(f"r{i} as (select * replace (replace(rest, '{written}', '|-|') as rest, "
                     f"case when contains(rest, '{written}') and not list_contains(licenses, '{name}') "
                     f"then list_append(licenses, '{name}') else licenses end as licenses) from {last})")
        last = f"r{i}"
    return rf"""
with known(sentence, id) as (values {known}),
lines as (select row_number() over () as row, doc_id,
                 string_split_regex(regexp_replace(coalesce(text, ''), '([.!?;:])[\x20\x09-\x0D]+', '\1' || chr(10), 'g'),
                                    '[\x0A-\x0D]+') as parts from documents),
cut as (select row, unnest(parts) as s, generate_subscripts(parts, 1) as at from lines),
found as (select c.row, list(k.id order by c.at) as ids from cut c
          join known k on k.sentence = regexp_replace(trim(regexp_replace(translate(c.s, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g')),
                                                 '^{HOLDER.replace("[ ~]", " ").replace("[a-z0-9 ~]", "[a-z0-9 ]")}', '{ANY_HOLDER}')
          group by c.row),
r0 as (select l.doc_id, coalesce(f.ids, []::varchar[]) as ids, []::varchar[] as licenses,
              replace('|' || array_to_string(coalesce(f.ids, []::varchar[]), '|') || '|', '|', '||') as rest
       from lines l left join found f on l.row = f.row),
{", ".join(steps)}
select doc_id, array_to_string(licenses, ', ') as licenses, len(ids) as n_sentences,
       array_to_string(ids, ' ') as sentence_ids from {last}"""


assert all(t.isalnum() for t in TRIGGERS)
assert all(any(t in s for t in TRIGGERS) for forms in KNOWN.values() for s in forms)
assert all(re.fullmatch("[a-z0-9 ]+", s) for forms in KNOWN.values() for s in forms)
