"""Licence scan by sentence rules.

A text is cut into sentences, each is normalised (A-Z to lower case, all but a-z and 0-9 to single spaces), and known
licence sentences become identifiers. A rule is an ordered sequence of identifiers; it matches where consecutive
recognised sentences of a document carry it. Everything is relational: sentences are exploded, joined with the fixed
table of known sentences (a bounded literal), and a rule's match is a run in which place minus step stays the same.

Defined cases: null and empty texts have no sentences. Unrecognised sentences between recognised ones do not break a
match. Rows alike in doc_id and text count as one document, rows that share doc_id only are scanned apart and their
matches all returned. An expression of SPDX identifiers gives each of them, at one place; what follows WITH is no
licence. A colon ends a sentence only where a list of terms begins. A line is a sentence, and so is what runs over line ends inside a paragraph (hard-wrapped texts);
places count lines. OP1_SQL says the first only, so it holds where no known sentence is wrapped. Longer rules do not hide shorter ones. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .columns import lower_ascii, pick

# Sentences of public licence texts and notices, as published.
SENTENCES = {
    "mit-notice": "Released under the MIT License",
    "mit-licensed": "Licensed under the MIT License",
    "mit-spdx": "SPDX-License-Identifier: MIT",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "apache-notice": "Licensed under the Apache License, Version 2.0",
    "apache-short": "Released under the Apache License 2.0",
    "apache-spdx": "SPDX-License-Identifier: Apache-2.0",
    "apache-licensed": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-compliance": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-asis": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl2-spdx": "SPDX-License-Identifier: GPL-2.0-only",
    "gpl2-later-spdx": "SPDX-License-Identifier: GPL-2.0-or-later",
    "gpl3-only-spdx": "SPDX-License-Identifier: GPL-3.0-only",
    "lgpl-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl-hope": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "lgpl-see": "See the GNU Lesser General Public License for more details.",
    "lgpl21-spdx": "SPDX-License-Identifier: LGPL-2.1-or-later",
    "agpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl-see": "See the GNU Affero General Public License for more details.",
    "agpl3-spdx": "SPDX-License-Identifier: AGPL-3.0-or-later",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl2-notice": "This work is licensed under the GNU General Public License, version 2",
    "gpl3-spdx": "SPDX-License-Identifier: GPL-3.0-or-later",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gpl-implied": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-see": "See the GNU General Public License for more details.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-warranty": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "bsd2-spdx": "SPDX-License-Identifier: BSD-2-Clause",
    "bsd3-spdx": "SPDX-License-Identifier: BSD-3-Clause",
    "isc-spdx": "SPDX-License-Identifier: ISC",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "zlib-origin": "The origin of this software must not be misrepresented;",
    "zlib-spdx": "SPDX-License-Identifier: Zlib",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "boost-notice": "Distributed under the Boost Software License, Version 1.0.",
    "boost-spdx": "SPDX-License-Identifier: BSL-1.0",
    "mpl2-spdx": "SPDX-License-Identifier: MPL-2.0",
    "epl2-spdx": "SPDX-License-Identifier: EPL-2.0",
    "unlicense-2": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "unlicense-1": "This is free and unencumbered software released into the public domain.",
    "mpl-1": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "ccby-notice": "Licensed under CC BY 4.0",
    "ccbysa-notice": "Licensed under CC BY-SA 4.0",
    "ccbync-notice": "Licensed under CC BY-NC 4.0",
    "cc0-notice": "Licensed under CC0 1.0",
    "reserved": "All rights reserved",
}

# Fixed values: (rule, licence, identifiers in order).
RULES = [
    ("mit-short", "MIT", ["mit-notice"]),
    ("mit-licensed", "MIT", ["mit-licensed"]),
    ("mit-spdx", "MIT", ["mit-spdx"]),
    ("mit-text", "MIT", ["mit-grant", "mit-condition"]),
    ("mit-whole", "MIT", ["mit-grant", "mit-condition", "mit-warranty", "mit-liability"]),
    ("apache-line", "Apache-2.0", ["apache-notice"]),
    ("apache-short", "Apache-2.0", ["apache-short"]),
    ("apache-spdx", "Apache-2.0", ["apache-spdx"]),
    ("apache-header", "Apache-2.0", ["apache-copy", "apache-asis", "apache-see"]),
    ("apache-first", "Apache-2.0", ["apache-licensed"]),
    ("apache-full", "Apache-2.0", ["apache-compliance", "apache-copy", "apache-asis", "apache-see"]),
    ("gpl3-line", "GPL-3.0", ["gpl3-notice"]),
    ("gpl2-line", "GPL-2.0", ["gpl2-notice"]),
    ("gpl3-spdx", "GPL-3.0", ["gpl3-spdx"]),
    ("gpl3-header", "GPL-3.0", ["gpl-free", "gpl-hope", "gpl-implied", "gpl-see"]),
    ("gpl2-header", "GPL-2.0", ["gpl2-free", "gpl-hope", "gpl-implied", "gpl-see"]),
    ("gpl2-spdx", "GPL-2.0", ["gpl2-spdx"]),
    ("gpl2-later-spdx", "GPL-2.0", ["gpl2-later-spdx"]),
    ("gpl3-only-spdx", "GPL-3.0", ["gpl3-only-spdx"]),
    ("lgpl-header", "LGPL-2.1", ["lgpl-free", "lgpl-hope", "gpl-implied", "lgpl-see"]),
    ("lgpl-spdx", "LGPL-2.1", ["lgpl21-spdx"]),
    ("agpl-header", "AGPL-3.0", ["agpl-free", "gpl-hope", "gpl-implied", "agpl-see"]),
    ("agpl-spdx", "AGPL-3.0", ["agpl3-spdx"]),
    ("bsd2-whole", "BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty"]),
    ("bsd3-whole", "BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty"]),
    ("bsd2-spdx", "BSD-2-Clause", ["bsd2-spdx"]),
    ("bsd3-spdx", "BSD-3-Clause", ["bsd3-spdx"]),
    ("isc-spdx", "ISC", ["isc-spdx"]),
    ("zlib-text", "Zlib", ["zlib-grant", "zlib-origin"]),
    ("zlib-spdx", "Zlib", ["zlib-spdx"]),
    ("0bsd-text", "0BSD", ["0bsd-grant"]),
    ("boost-line", "BSL-1.0", ["boost-notice"]),
    ("boost-spdx", "BSL-1.0", ["boost-spdx"]),
    ("mpl2-spdx", "MPL-2.0", ["mpl2-spdx"]),
    ("epl2-spdx", "EPL-2.0", ["epl2-spdx"]),
    ("unlicense-whole", "Unlicense", ["unlicense-1", "unlicense-2"]),
    ("bsd2-text", "BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("bsd3-text", "BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("isc-text", "ISC", ["isc-grant"]),
    ("unlicense-text", "Unlicense", ["unlicense-1"]),
    ("mpl-line", "MPL-2.0", ["mpl-1"]),
    ("ccby-line", "CC-BY-4.0", ["ccby-notice"]),
    ("ccbysa-line", "CC-BY-SA-4.0", ["ccbysa-notice"]),
    ("ccbync-line", "CC-BY-NC-4.0", ["ccbync-notice"]),
    ("cc0-line", "CC0-1.0", ["cc0-notice"]),
    ("reserved-line", "Proprietary", ["reserved"]),
]

# Names of public licences in notices, by identifier, and identifiers without a rule of their own above.
NAMES = {
    "MIT": ["MIT License", "MIT Licence", "Expat License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2", "GPLv2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPLv3"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPLv2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "LGPLv3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "AGPLv3"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"],
    "ISC": ["ISC License"],
    "Zlib": ["zlib License"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "MPL 2.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0"],
    "EUPL-1.2": ["European Union Public Licence 1.2", "EUPL 1.2"],
    "Artistic-2.0": ["Artistic License 2.0"],
    "OFL-1.1": ["SIL Open Font License, Version 1.1", "SIL Open Font License 1.1"],
    "Unlicense": ["Unlicense"],
    "CC-BY-4.0": ["Creative Commons Attribution 4.0 International License", "CC BY 4.0 License"],
    "CC-BY-SA-4.0": ["Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0 License"],
    "CC-BY-NC-4.0": ["Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0 License"],
    "CC0-1.0": ["CC0 1.0 Universal license"],
}
LEADS = ["Licensed under the", "Released under the", "Distributed under the", "Available under the", "This project is licensed under the", "This software is licensed under the", "This program is licensed under the", "This work is licensed under the", "This code is licensed under the", "This file is licensed under the"]
IDENTIFIERS = ["LGPL-2.1-only", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "EUPL-1.2", "Artistic-2.0", "OFL-1.1", "0BSD", "Unlicense", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC0-1.0", "PostgreSQL", "WTFPL"]

SPDX = "SPDX-License-Identifier:"
#: Every lead with every name, with and without "terms of the", is one identifier for each licence.
SENTENCES |= {f"{x}-said": [f"{lead}{terms} {n}" for lead in LEADS for terms in ("", " terms of the") for n in names] for x, names in NAMES.items()}
SENTENCES |= {f"{x}-named": f"{SPDX} {x}" for x in IDENTIFIERS}
RULES += [(f"{x.lower()}-said", x, [f"{x}-said"]) for x in NAMES]
RULES += [(f"{x.lower()}-named", x.removesuffix("-only").removesuffix("-or-later"), [f"{x}-named"]) for x in IDENTIFIERS]

#: A sentence ends at a line's end, after one of these marks and white space, or after a colon and blanks where a list of
#: terms begins. Of the two groups one is empty.
SPACE = r"[\x20\x09-\x0D]"
CUT = rf"([.!?;]){SPACE}+|((?:conditions|restrictions|met):)[\x20\x09]+"
#: Between the parts of an identifier's expression.
OPERATORS = " +(?:OR|AND|WITH) +"


def sentences_of(text: str) -> list[str]:
    """The plain form of what the expressions below do; tables of known sentences are made with it."""
    lines = re.sub(CUT, "\\1\\2\n", text).split("\n")
    return [re.sub("[^a-z0-9]+", " ", x.translate({i: i + 32 for i in range(65, 91)})).strip(" ") for x in lines]


def known_rows(sentences: dict[str, str | list[str]] = SENTENCES) -> list[tuple[str, str]]:
    """sentence, identifier. A text of several sentences gives as many identifiers; the texts of a list mean the same."""
    rows = {}
    for name, texts in sentences.items():
        for text in [texts] if isinstance(texts, str) else texts:
            parts = [s for s in sentences_of(text) if s]
            for i, p in enumerate(parts):
                rows.setdefault(p, name if len(parts) == 1 else f"{name}/{i}")
    return list(rows.items())


def marks(sentences: list[str]) -> list[str]:
    """A few long words of which every sentence holds one (its longest word, if that is short), taken greedily: a text
    that holds none holds no sentence. Words keep whole over line ends, so texts need no normalising for this."""
    left, out = sorted(set(sentences)), []
    while left:
        held = Counter(w for x in left for w in {w for w in x.split(" ") if len(w) >= 7} or {max(x.split(" "), key=len)})
        out.append(min(held, key=lambda w: (-held[w], w)))
        left = [x for x in left if out[-1] not in x]
    return out


def rule_rows(rules=RULES, sentences: dict[str, str | list[str]] = SENTENCES) -> list[tuple[str, str, int, str, int]]:
    """rule, licence, step, identifier, steps; an identifier of several sentences stands for all of them in order."""
    parts: dict[str, dict[str, None]] = {}
    for _, name in known_rows(sentences):
        parts.setdefault(name.split("/")[0], {})[name] = None
    rows = []
    for rule, licence, names in rules:
        steps = [p for n in names for p in parts[n]]
        rows += [(rule, licence, i, s, len(steps)) for i, s in enumerate(steps)]
    return rows


def _sentences(text: Column) -> Column:
    cut = F.regexp_replace(text, CUT, "$1$2\n")
    return F.split(cut, "\n", -1)


#: A line's end that ends a paragraph: before a line without letters and digits, or before an item of a list.
PARAGRAPH = r"\n(?=[^A-Za-z0-9\n]*(?:\n|(?:[0-9]+|[A-Za-z])[.)][\x20\n]))"


def _normal(c: Column) -> Column:
    return F.trim(F.regexp_replace(lower_ascii(c), "[^a-z0-9]+", " "))


def _wrapped(docs: DataFrame, known: list[tuple[str, str]]) -> DataFrame:
    """doc_id, th, place, upto, sentence: known sentences that run over line ends inside a paragraph, with the places of
    their first and last line. Only texts that hold a mark of the known sentences are cut a second time."""
    words = [x for x, _ in known]
    # The lambda binds the lower form, which would be made again for every mark otherwise.
    few = marks(words)
    marked = lambda c: reduce(or_, [F.contains(c, F.lit(x)) for x in few])
    holding = docs.filter(F.contains("text", F.lit("\n"))).filter(F.exists(F.array(lower_ascii(F.col("text"))), marked))
    every = F.split(F.lit("\n".join(words)), "\n", -1)  # one literal, made once; a thousand would burden the plan
    # Every piece keeps the line ends in it, one for each cut too, so line ends before a piece tell its place.
    cut = F.regexp_replace(F.regexp_replace(F.translate("text", "\x01", " "), CUT, "$1$2\n\x01"), PARAGRAPH, "\n\x01")
    pieces = F.transform(F.split(cut, "\x01", -1), lambda x, i: F.struct(i.alias("i"), x.alias("raw"), _normal(x).alias("sentence")))
    said = holding.select("doc_id", "th", F.split(cut, "\x01", -1).alias("all"), F.explode(F.filter(pieces, lambda x: marked(x["sentence"]) & F.array_contains(every, x["sentence"]))).alias("p"))
    ends = lambda c: F.length(F.regexp_replace(c, "[^\n]+", "")).cast("int")
    lead = ends(F.concat(F.array_join(F.slice("all", F.lit(1), F.col("p.i")), ""), F.regexp_extract("p.raw", "^[^A-Za-z0-9]*", 0)))
    inside = ends(F.regexp_extract("p.raw", "[A-Za-z0-9](?s:.*)[A-Za-z0-9]", 0))
    return said.select("doc_id", "th", lead.alias("place"), (lead + inside).alias("upto"), F.col("p.sentence").alias("sentence")).filter("upto > place")


def scan(documents: DataFrame, sentences: dict[str, str | list[str]] = SENTENCES, rules=RULES) -> DataFrame:
    """doc_id, license, rule, first_sentence, last_sentence (places among the document's sentences, from 0), a row for each match."""
    spark = documents.sparkSession
    known = spark.createDataFrame(known_rows(sentences), "sentence string, sid string")
    steps = spark.createDataFrame(rule_rows(rules, sentences), "rule string, license string, step long, sid string, steps long")
    docs = pick(documents, "doc_id", "text").filter("text is not null")
    said = docs.select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(_sentences(F.col("text"))).alias("place", "raw"))
    least = min(len(x) for x, _ in known_rows(sentences))  # normalising never lengthens a sentence
    near = said.filter(F.length("raw") >= least)
    parts = F.transform(F.split("raw", OPERATORS, -1), lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.lit(SPDX), x)))
    near = near.withColumn("raw", F.explode(F.when(F.contains("raw", F.lit(SPDX)), parts).otherwise(F.array("raw"))))
    lines = near.select("doc_id", "th", "place", F.col("place").alias("upto"), _normal(F.col("raw")).alias("sentence"))
    wrapped = _wrapped(docs.select("doc_id", "text", F.xxhash64("text").alias("th")), known_rows(sentences))
    seen = lines.unionByName(wrapped).join(F.broadcast(known), "sentence").select("doc_id", "th", "place", "upto", "sid").distinct()
    w = W.partitionBy("doc_id", "th").orderBy("place", "sid")
    placed = seen.withColumn("nth", F.row_number().over(w).cast("long"))
    runs = placed.join(F.broadcast(steps), "sid").groupBy("doc_id", "th", "rule", "license", "steps", (F.col("nth") - F.col("step")).alias("run"))
    whole = runs.agg(F.count("*").alias("n"), F.min("place").alias("a"), F.max("upto").alias("b")).filter("n = steps")
    return whole.select("doc_id", "license", "rule", F.col("a").cast("long").alias("first_sentence"), F.col("b").cast("long").alias("last_sentence"))


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _values(rows) -> str:
    lit = lambda x: str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows)


OP1_SQL = rf"""
WITH known(sentence, sid) AS (VALUES {_values(known_rows())}),
steps(rule, license, step, sid, steps) AS (VALUES {_values(rule_rows())}),
s AS (
  SELECT doc_id, md5(text) AS th, unnest(x) AS raw, generate_subscripts(x, 1) - 1 AS place
  FROM (SELECT doc_id, text, string_split(regexp_replace(text, '{CUT}', '\1\2' || chr(10), 'g'), chr(10)) AS x FROM documents WHERE text IS NOT NULL)
), parts AS (SELECT doc_id, th, place, unnest(string_split_regex(raw, '{OPERATORS}')) AS part, generate_subscripts(string_split_regex(raw, '{OPERATORS}'), 1) AS i FROM s WHERE contains(raw, '{SPDX}')),
one AS (
  SELECT doc_id, th, place, raw FROM s WHERE NOT contains(raw, '{SPDX}')
  UNION ALL SELECT doc_id, th, place, CASE WHEN i = 1 THEN part ELSE '{SPDX}' || part END FROM parts
), seen AS (
  SELECT DISTINCT doc_id, th, place, sid
  FROM one JOIN known ON known.sentence = trim(regexp_replace(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g'))
), placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id, th ORDER BY place, sid) AS nth FROM seen),
whole AS (
  SELECT doc_id, th, rule, license, steps, nth - step AS run, count(*) AS n, min(place) AS a, max(place) AS b
  FROM placed JOIN steps USING (sid) GROUP BY ALL HAVING count(*) = steps
)
SELECT doc_id, license, rule, a::BIGINT AS first_sentence, b::BIGINT AS last_sentence FROM whole
"""
