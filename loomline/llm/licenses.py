"""Licence scan by a positional rare-token index, in DataFrame functions only.

Templates are licence texts, notices and names with key phrases that must stand in a file; the base phrases are templates
of one key phrase each. An index holds the postings (template, position) of their words.

1. Every licence word gets its inverse document frequency over all files.
2. In a file, only its licence words of highest IDF are looked up: those from the highest IDF on at which every template
   still has a word of its key phrases in the index (``rare_index``), so that no template can be missed.
3. A hit at file position p with a posting (t, q) proposes that template t starts at p - q. Proposals are intersected by
   that relative position: (t, start) is a candidate if as many postings propose it as all must that lie in t's key
   phrases, ``AGREE`` at most.
4. A candidate is verified there: every mandatory key phrase must stand consecutively in its place. The share of all the
   template's words that stand in place is its score.

Templates and postings are two constants of the plan, whose size doesn't depend on their number. All of it works within
a row; nothing shuffles but the words' document counts, so no licence, however common, gathers rows.

Words are runs of ASCII letters and digits and of all non-ASCII characters, lower-cased A-Z. Null text is empty: no
words, no labels, score 0. Repeated rows are scanned alike; very long texts are read whole; other columns pass
through; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import clear_name, without_outputs

#: The base phrases and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
    FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
    WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either
    version {version} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
    without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."""

#: Label, the licence's own wording, and its mandatory key phrases.
TEMPLATES = (
    ("cc-by-nc", "licensed under CC BY-NC", ("CC BY-NC",)),
    ("cc-by-sa", "licensed under CC BY-SA", ("CC BY-SA",)),
    ("cc-by-nd", "licensed under CC BY-ND", ("CC BY-ND",)),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike", ("Creative Commons Attribution-ShareAlike",)),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial", ("Creative Commons Attribution-NonCommercial",)),
    ("cc-by-nd", "Creative Commons Attribution-NoDerivatives", ("Creative Commons Attribution-NoDerivatives",)),
    ("cc0", "CC0 1.0 Universal Public Domain Dedication", ("CC0 1.0",)),
    ("mit", "released under the MIT License", ("MIT License",)),
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all
        copies or substantial portions of the Software. """ + _WARRANTY,
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "to deal in the Software without restriction"),
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this
        permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF
        USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
        ("distribute this software for any purpose with or without fee is hereby granted",),
    ),
    (
        "bsd-3-clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source
        code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor
        the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.""",
        ("Redistribution and use in source and binary forms", "Neither the name of the copyright holder nor the names of its contributors"),
    ),
    (
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source
        code must retain the above copyright notice, this list of conditions and the following disclaimer.""",
        ("Redistribution and use in source and binary forms",),
    ),
    (
        "zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
        Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.""",
        ("Permission is granted to anyone to use this software for any purpose, including commercial applications", "The origin of this software must not be misrepresented"),
    ),
    (
        "bsl-1.0",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
        (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software""",
        ("any person or organization obtaining a copy of the software and accompanying documentation covered by this license",),
    ),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ("Apache License, Version 2.0",)),
    (
        "apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
        ("Apache License, Version 2.0", "you may not use this file except in compliance with the License"),
    ),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3", ("General Public License, version 3",)),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2", ("General Public License, version 2",)),
    ("gpl-3.0", _GNU.format(name="General Public License", version=3), ("GNU General Public License as published by the Free Software Foundation, either version 3",)),
    ("gpl-2.0", _GNU.format(name="General Public License", version=2), ("GNU General Public License as published by the Free Software Foundation, either version 2",)),
    ("lgpl", "licensed under the GNU Lesser General Public License", ("Lesser General Public License",)),
    ("lgpl", _GNU.format(name="Lesser General Public License", version=3), ("GNU Lesser General Public License as published by the Free Software Foundation",)),
    ("agpl", "licensed under the GNU Affero General Public License", ("Affero General Public License",)),
    ("agpl", _GNU.format(name="Affero General Public License", version=3), ("GNU Affero General Public License as published by the Free Software Foundation",)),
    (
        "mpl-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at
        http://mozilla.org/MPL/2.0/.""",
        ("subject to the terms of the Mozilla Public License, v. 2.0",),
    ),
    ("epl-2.0", "made available under the terms of the Eclipse Public License 2.0", ("Eclipse Public License 2.0",)),
    (
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in
        source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
        ("free and unencumbered software released into the public domain",),
    ),
)
#: The most postings that must agree on a start.
AGREE = 2

_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans(*_LOWER)))


@dataclass(frozen=True)
class Template:
    """keys: (position, number of words) of each mandatory phrase."""

    label: str
    words: tuple[str, ...]
    keys: tuple[tuple[int, int], ...]
    base: bool

    @property
    def key_places(self) -> list[int]:
        return sorted({p for at, n in self.keys for p in range(at, at + n)})


def compiled(templates=TEMPLATES, phrases: dict[str, str] = BASE_PHRASES) -> list[Template]:
    """All templates, those of the base phrases last. A key phrase is taken where the wording has it first."""
    out = []
    for label, wording, keys in (*templates, *((x, p, (p,)) for p, x in phrases.items())):
        words = words_of(wording)
        at = [(next(i for i in range(len(words)) if words[i : i + len(k)] == k), len(k)) for k in map(words_of, keys)]
        out.append(Template(label, tuple(words), tuple(at), len(out) >= len(templates)))
    return out


def document_frequencies(docs: DataFrame, templates: list[Template], text_col: str = "text") -> tuple[dict[str, int], int]:
    """(number of texts that hold each word of the templates, number of texts), over all texts. The driver gets a row per word."""
    vocabulary = sorted({w for t in templates for w in t.words})
    held = F.array_intersect(_words(F.coalesce(F.col(text_col), F.lit(""))), F.lit(vocabulary))
    counts = {r["word"]: r["count"] for r in docs.select(F.explode(F.concat(held, F.array(F.lit("")))).alias("word")).groupBy("word").count().collect()}
    return {w: counts.get(w, 0) for w in vocabulary}, counts.get("", 0)


def rare_index(frequencies: dict[str, int], texts: int, templates: list[Template]) -> dict[str, list[tuple[int, int]]]:
    """word: its postings (template number, position), for all words from an IDF on.

    That is the highest IDF at which each template still has a word of its key phrases: a file that holds a template
    holds that word.
    """
    idf = {w: math.log((texts + 1) / (n + 1)) for w, n in frequencies.items()}
    least = min((max(idf[t.words[p]] for p in t.key_places) for t in templates), default=math.inf)
    index: dict[str, list[tuple[int, int]]] = {}
    for k, t in enumerate(templates):
        for p, w in enumerate(t.words):
            if idf[w] >= least:
                index.setdefault(w, []).append((k, p))
    return index


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, *_LOWER), F.lit(rf"{_WORD}++"), F.lit(0))


def scan(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, templates=TEMPLATES, phrases: dict[str, str] = BASE_PHRASES) -> DataFrame:
    """The columns in keep (default: all) with n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    These replace columns of these names. spans: start, end (in words), label and share of each verified template.
    """
    keep = without_outputs(docs.columns if keep is None else keep, ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"))
    text, words, proposals, found = (clear_name(docs, x) for x in ("text", "words", "proposals", "found"))
    all_of = compiled(templates, phrases)
    index = rare_index(*document_frequencies(docs, all_of, text_col), all_of)
    # By template: how many of its postings in the index must agree. All those in its key phrases do in a file that holds it.
    need = [min(AGREE, sum(t.words[p] in index for p in t.key_places)) for t in all_of]
    told = [{"label": t.label, "base": t.base, "words": t.words, "keys": [{"at": a, "n": n} for a, n in t.keys], "need": n} for t, n in zip(all_of, need, strict=True)]
    table = F.from_json(F.lit(json.dumps(told)), "array<struct<label:string,base:boolean,words:array<string>,keys:array<struct<at:int,n:int>>,need:int>>")
    posted = F.from_json(F.lit(json.dumps({w: [{"t": t, "q": q} for t, q in found_at] for w, found_at in index.items()})), "map<string,array<struct<t:int,q:int>>>")
    w = F.col(words)

    rows = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias(text)).withColumn(words, _words(F.col(text))).drop(text)
    # Files without any word of the index propose nothing and aren't looked through.
    hits = F.filter(F.transform(w, lambda x, i: F.struct(x.alias("w"), i.alias("i"))), lambda h: F.map_contains_key(posted, h["w"]))
    each = F.flatten(F.transform(hits, lambda h: F.transform(F.element_at(posted, h["w"]), lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["q"]).alias("s")))))
    rows = rows.withColumn(proposals, F.when(F.arrays_overlap(w, F.lit(sorted(index))), F.array_sort(each)))
    # Sorted, equal proposals are neighbours: a run's first is a candidate if the run is as long as its template needs.
    alike = lambda c, i: F.coalesce(F.get(F.col(proposals), i) == c, F.lit(False))
    candidates = F.filter(F.col(proposals), lambda c, i: ~alike(c, i - 1) & alike(c, i + F.get(table, c["t"])["need"] - 1))

    def verified(c: Column) -> Column:
        t = F.get(table, c["t"])
        return F.forall(t["keys"], lambda k: (c["s"] + k["at"] >= 0) & (F.slice(w, F.greatest(c["s"] + k["at"], F.lit(0)) + 1, k["n"]) == F.slice(t["words"], k["at"] + 1, k["n"])))

    def span(c: Column) -> Column:
        t = F.get(table, c["t"])
        n = F.size(t["words"])
        in_place = F.size(F.filter(t["words"], lambda x, k: F.coalesce(F.get(w, c["s"] + k) == x, F.lit(False))))
        return F.struct(t["base"].alias("base"), F.greatest(c["s"], F.lit(0)).alias("start"), F.least(c["s"] + n, F.size(w)).alias("end"), t["label"].alias("label"), (in_place / n).alias("share"))

    kind = "array<struct<base:boolean,start:int,end:int,label:string,share:double>>"
    rows = rows.withColumn(found, F.coalesce(F.transform(F.filter(candidates, verified), span), F.array().cast(kind)))
    places, own = F.filter(found, lambda x: x["base"]), F.filter(found, lambda x: ~x["base"])
    labels = lambda x: F.array_sort(F.array_distinct(F.transform(x, lambda y: y["label"])))
    return rows.select(
        *keep,
        F.size(w).cast("long").alias("n_words"),
        F.size(places).cast("long").alias("n_base"),
        F.array_min(F.transform(places, lambda x: x["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform(places, lambda x: x["start"])).cast("long").alias("last_word"),
        F.array_join(labels(places), ",").alias("base_labels"),
        F.array_join(labels(F.col(found)), ",").alias("labels"),
        F.coalesce(F.greatest(F.array_max(F.transform(own, lambda x: x["share"])), F.when(F.size(places) > 0, F.lit(0.5))), F.lit(0.0)).alias("score"),
        F.transform(own, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["label"].alias("label"), x["share"].alias("share"))).alias("spans"),
    )


def oracle(templates=TEMPLATES, phrases: dict[str, str] = BASE_PHRASES) -> str:
    """DuckDB SQL for the scan of `documents`: each template is looked for at every place of its first key phrase."""
    quote = lambda ws: "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in ws) + "]"
    values = ",\n".join(f"('{t.label}', {t.base}, {quote(t.words)}, {[a for a, _ in t.keys]}, {[n for _, n in t.keys]})" for t in compiled(templates, phrases))
    return rf"""WITH t(label, base, tw, pos, num) AS (VALUES {values}),
        d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_LOWER[0]}', '{_LOWER[1]}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        p AS (SELECT row, w, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d WHERE list_has_any(w, (SELECT list(tw[pos[1] + 1]) FROM t))),
        f AS (SELECT row, label, base, tw, w, i - 1 - pos[1] AS s FROM p JOIN t ON x = tw[pos[1] + 1]
            WHERE len(list_filter(range(1, len(pos) + 1), lambda k: i - pos[1] + pos[k] >= 1 AND w[i - pos[1] + pos[k]:i - pos[1] + pos[k] + num[k] - 1] = tw[pos[k] + 1:pos[k] + num[k]])) = len(pos)),
        v AS (SELECT row, label, base, s, len(list_filter(range(1, len(tw) + 1), lambda k: s + k >= 1 AND w[s + k] = tw[k])) / len(tw) AS share FROM f),
        g AS (SELECT row, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
            string_agg(DISTINCT label, ',' ORDER BY label) AS labels, greatest(coalesce(max(share) FILTER (NOT base), 0), CASE WHEN count(*) FILTER (base) > 0 THEN 0.5 ELSE 0 END) AS score FROM v GROUP BY row)
        SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
        FROM d LEFT JOIN g USING (row)"""
