"""License scan: sentence rules over normalised sentences.

A text is cut into sentences (at line ends and after . ! ? ; : before white space); sentences
are normalised (lower case, straight quotes, only letters, digits, dots inside numbers and
hyphens, one space). Known licence sentences have identifiers; a sentence may run over several
lines, so a known sentence is looked for from each sentence start over as many following pieces
as it needs. The document's sequence of identifiers is then matched against the licence rules:
each rule is an ordered list of identifiers of which ``GAP`` other known sentences may lie
between neighbours. A rule that matches whole gives a licence span; if several rules start at
the same sentence, the longest wins; spans of different rules may lie inside each other only if
they share no sentence.

Defined results: null and empty texts have no sentences; a rule that matches in part gives no
licence but its sentences stay in ``sentences``; repeated rows each get their own result;
offsets are code points.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, table

GAP = 3

#: Known licence sentences (identifier, text) and rules (licence, identifiers in order).
SENTENCES = [
    ("mit-notice", "Released under the MIT License"),
    ("mit-notice-2", "Licensed under the MIT License"),
    ("mit-notice-3", "This project is licensed under the MIT License"),
    ("mit-title", "The MIT License"),
    ("mit-title-2", "MIT License"),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("mit-keep", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("as-is", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"),
    ("isc-grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd-grant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-1", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd-2", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("bsd-3", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-notice", "Licensed under the BSD License"),
    ("apache-notice", "Licensed under the Apache License, Version 2.0"),
    ("apache-notice-2", "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    ("apache-comply", "you may not use this file except in compliance with the License"),
    ("apache-copy", "You may obtain a copy of the License at"),
    ("apache-as-is", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("gpl3-notice", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl2-notice", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl-free", "This program is free software"),
    ("gpl3-terms", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("gpl2-terms", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("gpl-hope", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"),
    ("lgpl-notice", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("agpl-notice", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("mpl-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0"),
    ("cc-by-nc-nd", "Licensed under CC BY-NC-ND 4.0"),
    ("cc0", "Licensed under CC0 1.0"),
    ("cc-by-long", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
RULES = [
    ("MIT", ["mit-notice"]), ("MIT", ["mit-notice-2"]), ("MIT", ["mit-notice-3"]), ("MIT", ["mit-grant", "mit-keep", "as-is"]),
    ("MIT", ["mit-title", "mit-grant", "mit-keep", "as-is"]), ("MIT", ["mit-title-2", "mit-grant", "mit-keep", "as-is"]),
    ("ISC", ["isc-grant"]),
    ("BSD", ["bsd-notice"]), ("BSD-2-Clause", ["bsd-grant", "bsd-1", "bsd-2"]), ("BSD-3-Clause", ["bsd-grant", "bsd-1", "bsd-2", "bsd-3"]),
    ("Apache-2.0", ["apache-notice"]), ("Apache-2.0", ["apache-notice-2", "apache-comply", "apache-copy", "apache-as-is"]),
    ("GPL-3.0", ["gpl3-notice"]), ("GPL-2.0", ["gpl2-notice"]), ("GPL-3.0-or-later", ["gpl-free", "gpl3-terms"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl2-terms"]), ("GPL-3.0-or-later", ["gpl-free", "gpl3-terms", "gpl-hope"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl2-terms", "gpl-hope"]),
    ("LGPL-3.0", ["lgpl-notice"]), ("AGPL-3.0", ["agpl-notice"]), ("MPL-2.0", ["mpl-notice"]),
    ("CC-BY-4.0", ["cc-by"]), ("CC-BY-SA-4.0", ["cc-by-sa"]), ("CC-BY-NC-4.0", ["cc-by-nc"]), ("CC-BY-ND-4.0", ["cc-by-nd"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa"]), ("CC-BY-NC-ND-4.0", ["cc-by-nc-nd"]), ("CC0-1.0", ["cc0"]), ("CC-BY-4.0", ["cc-by-long"]),
    ("Unlicense", ["unlicense"]),
]

_PIECE = re.compile(r"[^\n.!?;:]+(?:[.!?;:]+(?!\s|\Z)[^\n.!?;:]*)*")
_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


def normal_words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class SentenceRules:
    """Known sentences by their first two words, and the rules by their first sentence."""

    def __init__(self, sentences=SENTENCES, rules=RULES, gap: int = GAP):
        self.gap = gap
        self.opening: dict[str, list[tuple[list[str], str]]] = {}
        for name, text in sentences:
            w = normal_words(text)
            self.opening.setdefault(w[0], []).append((w, name))
        for known in self.opening.values():
            known.sort(key=lambda x: -len(x[0]))
        self.rules: dict[str, list[tuple[list[str], str]]] = {}
        for licence, names in rules:
            self.rules.setdefault(names[0], []).append((names, licence))
        for known in self.rules.values():
            known.sort(key=lambda x: (-len(x[0]), x[1]))
        # a text without any first word after a sentence start has no known sentence
        self.first = re.compile(r"(?:^|[\n.!?;:])[^\w\n.!?;:]*(?:" + "|".join(sorted(map(re.escape, self.opening))) + r")\b", re.I)

    def sentences(self, text: str | None) -> list[tuple[str, int, int]]:
        """(identifier, start, end) of the known sentences, in text order."""
        if not text or not self.first.search(text):
            return []
        pieces = [(m.start(), m.end()) for m in _PIECE.finditer(text)]
        out, k = [], 0
        while k < len(pieces):
            got = self._known_at(text, pieces, k)
            if got:
                out.append(got[:3])
                k = got[3]
            else:
                k += 1
        return out

    def _known_at(self, text: str, pieces: list[tuple[int, int]], k: int) -> tuple[str, int, int, int] | None:
        start, end = pieces[k]
        m = _WORD.search(text, start, end)
        known = self.opening.get(m[0].lower()) if m else None
        for want, name in known or ():
            have, last = normal_words(text[start:end]), k
            while len(have) < len(want) and have == want[:len(have)] and last + 1 < len(pieces):
                last += 1
                have += normal_words(text[pieces[last][0]:pieces[last][1]])
            if have == want:
                return name, m.start(), max(w.end() for w in _WORD.finditer(text, *pieces[last])), last + 1
        return None

    def licences(self, found: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """(licence, start, end) of the rules that the identifier sequence satisfies."""
        out, used = [], set()
        for k, (name, start, _) in enumerate(found):
            if k in used:
                continue
            for names, licence in self.rules.get(name, ()):
                at, seen = k, [k]
                for want in names[1:]:
                    at = next((j for j in range(at + 1, min(len(found), at + 2 + self.gap)) if found[j][0] == want and j not in used), None)
                    if at is None:
                        break
                    seen.append(at)
                else:
                    used.update(seen)
                    out.append((licence, start, found[seen[-1]][2]))
                    break
        return out


def scan(docs: DataFrame, rules: SentenceRules | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, known sentences and licences with their spans."""
    rules = rules or SentenceRules()

    def of(b):
        known = [rules.sentences(t) for t in b.column("_text").to_pylist()]
        as_rows = lambda spans: [{"name": n, "start": s, "end": e} for n, s, e in spans]
        return {id_col: b.column(id_col), "sentences": [as_rows(k) for k in known], "licences": [as_rows(rules.licences(k)) for k in known]}
    span = "array<struct<name:string,start:long,end:long>>"
    return map_batches(docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")), of,
                       f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, sentences {span}, licences {span}")


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.size("sentences").cast("long").alias("n_sentences"), F.size("licences").cast("long").alias("n_licences"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("licences", lambda x: x["name"]))), ",").alias("licences"),
        F.array_join(F.transform("licences", lambda x: F.concat_ws(":", x["name"], x["start"], x["end"])), ",").alias("spans"))
