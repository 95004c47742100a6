"""License scans by sentence rules (operator 10).

A text is cut into lines and sentences, which are normalised and looked up among known licence sentences; one that is
wrapped over several lines is found as well, and so is one that names its own authors where the public text has a
slot for them. The identifiers found, in order, form the document's sequence. Ordered
rules name the licence of a run of identifiers; a rule takes the runs it matches out of the sequence, so that a later,
wider rule doesn't see them again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sentences as the public licence texts and their usual notices word them, normalised; * is a slot for the
# names of holders.
SENTENCES = {
    "mit_notice": [
        "released under the mit license",
        "licensed under the mit license",
        "this project is licensed under the mit license",
        "this software is released under the mit license",
        "distributed under the mit license",
        "licensed under the terms of the mit license",
        "this project is licensed under the terms of the mit license",
        "licensed under mit",
        "mit licensed",
        "license mit",
    ],
    "mit_title": ["mit license", "the mit license", "the mit license mit"],
    "mit_grant": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies "
        "of the software and to permit persons to whom the software is furnished to do so subject to the "
        "following conditions"
    ],
    "mit_condition": [
        "the above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the software"
    ],
    "as_is": [
        "the software is provided as is without warranty of any kind express or implied including but not "
        "limited to the warranties of merchantability fitness for a particular purpose and noninfringement"
    ],
    "mit_liability": [
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability "
        "whether in an action of contract tort or otherwise arising from out of or in connection with the "
        "software or the use or other dealings in the software"
    ],
    "apache2_notice": [
        "licensed under the apache license version 2 0",
        "released under the apache license version 2 0",
        "distributed under the apache license version 2 0",
        "this project is licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license",
        "license apache 2 0",
        "license apache license 2 0",
    ],
    "apache2_comply": ["you may not use this file except in compliance with the license"],
    "apache2_copy": [
        "you may obtain a copy of the license at http www apache org licenses license 2 0",
        "you may obtain a copy of the license at",
    ],
    "apache2_as_is": [
        "unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied"
    ],
    "apache2_see": [
        "see the license for the specific language governing permissions and limitations under the license"
    ],
    "gpl3_notice": [
        "this work is licensed under the gnu general public license version 3",
        "licensed under the gnu general public license version 3",
        "released under the gnu general public license version 3",
        "spdx license identifier gpl 3 0",
    ],
    "gpl2_notice": [
        "this work is licensed under the gnu general public license version 2",
        "licensed under the gnu general public license version 2",
        "released under the gnu general public license version 2",
        "spdx license identifier gpl 2 0",
    ],
    "gpl3_redistribute": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation either version 3 of the license or "
        "at your option any later version"
    ],
    "gpl2_redistribute": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation either version 2 of the license or "
        "at your option any later version"
    ],
    "gpl2_only_redistribute": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license version 2 as published by the free software foundation",
        "this program is free software you can redistribute it and or modify it under the terms of version 2 of the "
        "gnu general public license as published by the free software foundation",
    ],
    "gpl3_only_redistribute": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license version 3 as published by the free software foundation",
        "this program is free software you can redistribute it and or modify it under the terms of version 3 of the "
        "gnu general public license as published by the free software foundation",
    ],
    "lgpl_notice": [
        "licensed under the gnu lesser general public license version 3",
        "licensed under the gnu lesser general public license version 2 1",
        "released under the gnu lesser general public license version 3",
    ],
    "agpl3_notice": [
        "licensed under the gnu affero general public license version 3",
        "this work is licensed under the gnu affero general public license version 3",
    ],
    "gpl_hope": [
        "this program is distributed in the hope that it will be useful but without any warranty without even "
        "the implied warranty of merchantability or fitness for a particular purpose"
    ],
    "gpl_see": ["see the gnu general public license for more details"],
    "bsd_grant": [
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met"
    ],
    "bsd_source": [
        "redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer"
    ],
    "bsd_binary": [
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and "
        "the following disclaimer in the documentation and or other materials provided with the distribution"
    ],
    "bsd_endorse": [
        "neither the name of * nor the names of * contributors may be used to endorse or promote products derived from "
        "this software without specific prior written permission",
        "neither the name of * nor the names of its contributors may be used to endorse or promote products derived from "
        "this software without specific prior written permission",
        "neither the name nor the names of * may be used to endorse or promote products derived from this software "
        "without specific prior written permission",
        "the name of * may not be used to endorse or promote products derived from this software without specific prior "
        "written permission",
        "the names of * may not be used to endorse or promote products derived from this software without specific prior "
        "written permission",
    ],
    "bsd_notice": [
        "licensed under the bsd license", "released under the bsd license", "licensed under the bsd 3 clause license",
        "released under the bsd 3 clause license",
    ],
    "isc_grant": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is "
        "hereby granted provided that the above copyright notice and this permission notice appear in all copies"
    ],
    "mpl2_notice": [
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "licensed under the mozilla public license version 2 0",
        "released under the mozilla public license version 2 0",
    ],
    "cc_by": [
        "licensed under cc by 4 0",
        "this work is licensed under cc by 4 0",
        "this work is licensed under a creative commons attribution 4 0 international license",
    ],
    "cc_by_sa": [
        "licensed under cc by sa 4 0",
        "this work is licensed under cc by sa 4 0",
        "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    ],
    "cc_by_nc": [
        "licensed under cc by nc 4 0",
        "this work is licensed under cc by nc 4 0",
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    ],
    "cc_by_nd": ["licensed under cc by nd 4 0", "this work is licensed under cc by nd 4 0"],
    "cc0": [
        "licensed under cc0 1 0",
        "to the extent possible under law the author has waived all copyright and related or neighboring rights "
        "to this work",
    ],
    "all_rights": ["all rights reserved"],
    "apache2_title": ["apache license version 2 0 january 2004"],
    "apache2_terms": ["terms and conditions for use reproduction and distribution"],
    "gpl3_title": ["gnu general public license version 3 29 june 2007"],
    "gpl2_title": ["gnu general public license version 2 june 1991"],
    "lgpl3_title": ["gnu lesser general public license version 3 29 june 2007"],
    "lgpl21_title": ["gnu lesser general public license version 2 1 february 1999"],
    "agpl3_title": ["gnu affero general public license version 3 19 november 2007"],
    "fsf_verbatim": [
        "everyone is permitted to copy and distribute verbatim copies of this license document but changing it "
        "is not allowed"
    ],
    "gpl_received": [
        "you should have received a copy of the gnu general public license along with this program",
        "you should have received a copy of the gnu general public license along with this program if not see "
        "http www gnu org licenses",
        "you should have received a copy of the gnu general public license along with this program if not see "
        "https www gnu org licenses",
    ],
    "lgpl3_redistribute": [
        "this library is free software you can redistribute it and or modify it under the terms of the gnu "
        "lesser general public license as published by the free software foundation either version 3 of the "
        "license or at your option any later version",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "lesser general public license as published by the free software foundation either version 3 of the "
        "license or at your option any later version",
    ],
    "lgpl21_redistribute": [
        "this library is free software you can redistribute it and or modify it under the terms of the gnu "
        "lesser general public license as published by the free software foundation either version 2 1 of the "
        "license or at your option any later version"
    ],
    "lgpl_hope": [
        "this library is distributed in the hope that it will be useful but without any warranty without even "
        "the implied warranty of merchantability or fitness for a particular purpose"
    ],
    "lgpl_see": ["see the gnu lesser general public license for more details"],
    "agpl3_redistribute": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "affero general public license as published by the free software foundation either version 3 of the "
        "license or at your option any later version"
    ],
    "agpl_see": ["see the gnu affero general public license for more details"],
    "bsd_as_is": [
        "this software is provided by * as is and any express or implied "
        "warranties including but not limited to the implied warranties of merchantability and fitness for a "
        "particular purpose are disclaimed"
    ],
    "bsd_liability": [
        "in no event shall * be liable for any direct indirect incidental "
        "special exemplary or consequential damages including but not limited to procurement of substitute goods "
        "or services loss of use data or profits or business interruption however caused and on any theory of "
        "liability whether in contract strict liability or tort including negligence or otherwise arising in any "
        "way out of the use of this software even if advised of the possibility of such damage"
    ],
    "isc_as_is": [
        "the software is provided as is and the author disclaims all warranties with regard to this software "
        "including all implied warranties of merchantability and fitness"
    ],
    "isc_liability": [
        "in no event shall the author be liable for any special direct indirect or consequential damages or any "
        "damages whatsoever resulting from loss of use data or profits whether in an action of contract "
        "negligence or other tortious action arising out of or in connection with the use or performance of this "
        "software"
    ],
    "mpl2_title": ["mozilla public license version 2 0"],
    "mpl2_obtain": [
        "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
        "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    ],
    "cc_by_title": ["creative commons attribution 4 0 international public license", "attribution 4 0 international"],
    "cc_by_sa_title": [
        "creative commons attribution sharealike 4 0 international public license",
        "attribution sharealike 4 0 international",
    ],
    "cc_by_nc_title": [
        "creative commons attribution noncommercial 4 0 international public license",
        "attribution noncommercial 4 0 international",
    ],
    "cc_by_nd_title": [
        "creative commons attribution noderivatives 4 0 international public license",
        "attribution noderivatives 4 0 international",
    ],
    "cc0_title": ["cc0 1 0 universal"],
    "unlicense_grant": ["this is free and unencumbered software released into the public domain"],
    "zlib_as_is": ["this software is provided as is without any express or implied warranty"],
    "zlib_liability": [
        "in no event will the authors be held liable for any damages arising from the use of this software"
    ],
    "zlib_grant": [
        "permission is granted to anyone to use this software for any purpose including commercial applications "
        "and to alter it and redistribute it freely subject to the following restrictions"
    ],
    "boost_title": [
        "boost software license version 1 0 august 17th 2003",
        "distributed under the boost software license version 1 0",
    ],
    "epl2_notice": [
        "eclipse public license v 2 0",
        "this program and the accompanying materials are made available under the terms of the eclipse public "
        "license 2 0 which is available at https www eclipse org legal epl 2 0",
    ],
}
# Identifiers of the SPDX list that a file's tag line may name; each is a sentence and a rule of its own.
SPDX = [
    "Apache-2.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
    "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only",
    "AGPL-3.0-or-later", "MPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "Unlicense", "Zlib", "BSL-1.0", "EPL-2.0",
]
SENTENCES |= {f"spdx_{x}": ["spdx license identifier " + " ".join(re.findall("[a-z0-9]+", x.lower()))] for x in SPDX}
# Fixed values: (licence, run of identifiers), in order of precedence: whole texts, file headers, then single sentences.
RULES = [
    ("MIT", ["mit_grant", "mit_condition", "as_is", "mit_liability"]),
    ("Apache-2.0", ["apache2_title", "apache2_terms"]),
    ("Apache-2.0", ["apache2_notice", "apache2_comply", "apache2_copy", "apache2_as_is", "apache2_see"]),
    ("GPL-3.0-or-later", ["gpl3_redistribute", "gpl_hope", "gpl_see", "gpl_received"]),
    ("GPL-2.0-or-later", ["gpl2_redistribute", "gpl_hope", "gpl_see", "gpl_received"]),
    ("GPL-3.0-or-later", ["gpl3_redistribute", "gpl_hope", "gpl_see"]),
    ("GPL-2.0-or-later", ["gpl2_redistribute", "gpl_hope", "gpl_see"]),
    ("GPL-2.0-only", ["gpl2_only_redistribute", "gpl_hope", "gpl_see", "gpl_received"]),
    ("GPL-3.0-only", ["gpl3_only_redistribute", "gpl_hope", "gpl_see", "gpl_received"]),
    ("GPL-2.0-only", ["gpl2_only_redistribute", "gpl_hope", "gpl_see"]),
    ("GPL-3.0-only", ["gpl3_only_redistribute", "gpl_hope", "gpl_see"]),
    ("LGPL-3.0-or-later", ["lgpl3_redistribute", "lgpl_hope", "lgpl_see"]),
    ("LGPL-3.0-or-later", ["lgpl3_redistribute", "gpl_hope", "lgpl_see"]),
    ("LGPL-2.1-or-later", ["lgpl21_redistribute", "lgpl_hope", "lgpl_see"]),
    ("AGPL-3.0-or-later", ["agpl3_redistribute", "gpl_hope", "agpl_see"]),
    ("GPL-3.0", ["gpl3_title", "fsf_verbatim"]),
    ("GPL-2.0", ["gpl2_title", "fsf_verbatim"]),
    ("LGPL-3.0", ["lgpl3_title", "fsf_verbatim"]),
    ("LGPL-2.1", ["lgpl21_title", "fsf_verbatim"]),
    ("AGPL-3.0", ["agpl3_title", "fsf_verbatim"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse", "bsd_as_is", "bsd_liability"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_as_is", "bsd_liability"]),
    ("BSD", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_more", "bsd_as_is", "bsd_liability"]),
    ("BSD", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_more"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary"]),
    ("ISC", ["isc_grant", "isc_as_is", "isc_liability"]),
    ("Zlib", ["zlib_as_is", "zlib_liability", "zlib_grant"]),
    ("MPL-2.0", ["mpl2_notice", "mpl2_obtain"]),
    ("MIT", ["mit_grant", "mit_condition"]),
    ("GPL-3.0-or-later", ["gpl3_redistribute"]),
    ("GPL-2.0-or-later", ["gpl2_redistribute"]),
    ("GPL-2.0-only", ["gpl2_only_redistribute"]),
    ("GPL-3.0-only", ["gpl3_only_redistribute"]),
    ("LGPL-3.0-or-later", ["lgpl3_redistribute"]),
    ("LGPL-2.1-or-later", ["lgpl21_redistribute"]),
    ("AGPL-3.0-or-later", ["agpl3_redistribute"]),
    ("ISC", ["isc_grant"]),
    ("MIT", ["mit_notice"]),
    ("MIT", ["mit_title"]),
    ("Apache-2.0", ["apache2_title"]),
    ("Apache-2.0", ["apache2_notice"]),
    ("GPL-3.0", ["gpl3_title"]),
    ("GPL-3.0", ["gpl3_notice"]),
    ("GPL-2.0", ["gpl2_title"]),
    ("GPL-2.0", ["gpl2_notice"]),
    ("LGPL-3.0", ["lgpl3_title"]),
    ("LGPL-2.1", ["lgpl21_title"]),
    ("LGPL", ["lgpl_notice"]),
    ("AGPL-3.0", ["agpl3_title"]),
    ("AGPL-3.0", ["agpl3_notice"]),
    ("BSD", ["bsd_notice"]),
    ("MPL-2.0", ["mpl2_title"]),
    ("MPL-2.0", ["mpl2_notice"]),
    ("CC-BY-4.0", ["cc_by"]),
    ("CC-BY-4.0", ["cc_by_title"]),
    ("CC-BY-SA-4.0", ["cc_by_sa"]),
    ("CC-BY-SA-4.0", ["cc_by_sa_title"]),
    ("CC-BY-NC-4.0", ["cc_by_nc"]),
    ("CC-BY-NC-4.0", ["cc_by_nc_title"]),
    ("CC-BY-ND-4.0", ["cc_by_nd"]),
    ("CC-BY-ND-4.0", ["cc_by_nd_title"]),
    ("CC0-1.0", ["cc0"]),
    ("CC0-1.0", ["cc0_title"]),
    ("Unlicense", ["unlicense_grant"]),
    ("BSL-1.0", ["boost_title"]),
    ("EPL-2.0", ["epl2_notice"]),
    *((x, [f"spdx_{x}"]) for x in SPDX),
]
#: A piece of text ends at a line feed, or at one of these marks with white space after it.
ENDS = re.compile(r"(?<=[.!?;:])[ \t\r]+|\n")
#: ASCII letters (in lower case) and digits; all else, comment leaders too, stands between words.
_WORD = re.compile(r"[a-z0-9]+")
#: What a list puts before a clause: a number or a letter with a mark, or a mark alone.
_LEAD = re.compile(r"[^a-z0-9]*\(?(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})[.)](?![a-z0-9])|[^a-z0-9]*[*+\u2022-](?=[ \t])")
#: Words that a slot takes, at least one.
SLOT = 16


def _trie() -> dict:
    """Known sentences by their words; the identifier of a whole one is under the empty word."""
    root: dict = {}
    for i, many in SENTENCES.items():
        for s in many:
            node = root
            for word in s.split():
                node = node.setdefault(word, {})
            node[""] = i
    return root


TRIE = _trie()


def _step(states: list[tuple[dict, int]], word: str) -> list[tuple[dict, int]]:
    """The places in the trie after one more word, each with the words that its slot may still take."""
    out = []
    for node, left in states:
        if word in node:
            out.append((node[word], 0))
        if "*" in node:
            out.append((node["*"], SLOT - 1))
        if left:
            out.append((node, left - 1))
    return out


def _sentence_at(pieces: list[str], at: int, first: list[str]) -> tuple[str, int] | None:
    """(id, number of the piece after it) of the longest known sentence that begins with the words `first` of a piece."""
    states, found = [(TRIE, 0)], None
    for k in range(at, len(pieces)):
        words = first if k == at else _WORD.findall(pieces[k])
        for word in words:
            states = _step(states, word)
            if not states:
                return found
        if not words:
            return found
        whole = [node[""] for node, left in states if "" in node]
        if whole:
            found = whole[0], k + 1
    return found


def known_sentences(text: str | None) -> list[tuple[int, str]]:
    """(number of the piece where it begins, id) of the known sentences of a text.

    A known sentence is a run of whole pieces, the longest one from its first piece on; what a list puts before its
    clauses is no part of it. It may hold line feeds and end marks ("free software: you can", "v. 2.0", "Example Inc."),
    but no line without words. A clause of a list that follows the second BSD clause and isn't known, or anything that
    stands between that and the disclaimer, is there as "bsd_more".
    """
    out: list[tuple[int, str]] = []
    pieces, at, clause, odd = ENDS.split((text or "").lower()), 0, False, 0
    while at < len(pieces):
        lead = _LEAD.match(pieces[at])
        words, found = None, None
        head = _WORD.search(pieces[at], lead.end() if lead else 0)
        if head and head[0] in TRIE:
            words = _WORD.findall(pieces[at], head.start())
            found = _sentence_at(pieces, at, words)
        if found:
            if odd and found[0] == "bsd_as_is":
                out.append((odd, "bsd_more"))
            out.append((at, found[0]))
            at, clause, odd = found[1], False, 0
            continue
        if out and out[-1][1] == "bsd_binary" and head:
            if (lead or clause) and not odd:
                out.append((at, "bsd_more"))
            elif out[-1][1] == "bsd_binary":
                odd = odd or at
        clause = bool(lead) and not head
        at += 1
    return out


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("place", pa.int32()), ("id", pa.string())]))
    for batch in batches:
        found = [[{"place": p, "id": x} for p, x in known_sentences(text.as_py())] for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "hits"])


def license_hits(documents: DataFrame) -> DataFrame:
    """(doc_id, hits) of each row: its known sentences as (place, id) in order. Nothing is shuffled."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        _find, f"doc_id {kind}, hits array<struct<place: int, id: string>>"
    )


def scan_licenses(documents: DataFrame) -> DataFrame:
    """Per row of `documents` (doc_id, text; others, whatever their names, are left out): doc_id, n_sentences (known
    ones), licenses (names in the order of the rules, each once), unmatched (identifiers that no rule took), hits.

    A null or empty text has none. Every row is scanned by itself and whole, with or without a doc_id, whether ids repeat
    or not. An empty table gives an empty result.
    """
    found = license_hits(documents)
    rest = F.concat(
        F.lit(","), F.array_join(F.transform("hits", lambda h: F.concat(h["id"], F.lit(","))), ","), F.lit(",")
    )
    rows, names = found.withColumn("rest", F.coalesce(rest, F.lit(","))), []
    for i, (name, run) in enumerate(RULES):
        pattern = F.lit("," + ",,".join(run) + ",")
        rows = rows.withColumns(
            {f"r{i}": F.when(F.contains("rest", pattern), F.lit(name))}
        ).withColumn("rest", F.replace("rest", pattern, F.lit("")))
        names.append(f"r{i}")
    left = F.filter(F.split("rest", ","), lambda x: x != "")
    return rows.select(
        "doc_id",
        F.size("hits").cast("bigint").alias("n_sentences"),
        F.array_distinct(F.array_compact(F.array(*names))).alias("licenses"),
        left.alias("unmatched"),
        "hits",
    )


def op10_license_scan(spark, sf_dir: str) -> DataFrame:
    """Every document, with its licences and what no rule explains."""
    found = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id",
        "n_sentences",
        F.array_join("licenses", ",").alias("licenses"),
        F.array_join("unmatched", ",").alias("unmatched"),
    )


def _sql() -> str:
    """The same for texts whose sentences are lines or end at marks, and without unknown BSD clauses."""
    every = [(s, i) for i, many in SENTENCES.items() for s in many]
    known = ", ".join(f"('{s}', '{i}')" for s, i in every if "*" not in s)
    slots = ", ".join(f"('{s.replace('*', f'[a-z0-9]+( [a-z0-9]+){{0,{SLOT - 1}}}')}', '{i}')" for s, i in every if "*" in s)
    steps, before = [], "seqs"
    for k, (_, run) in enumerate(RULES):
        pattern = "," + ",,".join(run) + ","
        steps.append(
            f"s{k} AS (SELECT * EXCLUDE (rest), replace(rest, '{pattern}', '') AS rest, contains(rest, "
            f"'{pattern}') AS r{k} FROM {before})"
        )
        before = f"s{k}"
    names = ", ".join(f"CASE WHEN r{k} THEN '{name}' END" for k, (name, _) in enumerate(RULES))
    return f"""
WITH known(sentence, id) AS (VALUES {known}),
slots(pattern, id) AS (VALUES {slots}),
cut AS (SELECT doc_id, generate_subscripts(x, 1) AS place, unnest(x) AS s FROM (
  SELECT doc_id, string_split(regexp_replace(text, '([.!?;:])[ \\t\\r]+', '\\1' || chr(10), 'g'), chr(10)) AS x FROM documents)),
sentences AS (SELECT doc_id, place, trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'), ' ') AS sentence FROM cut),
found AS (SELECT doc_id, place, id FROM sentences JOIN known USING (sentence) UNION ALL
  SELECT doc_id, place, min(id) FROM sentences JOIN slots ON regexp_full_match(sentence, pattern)
  WHERE starts_with(sentence, 'neither the name') OR starts_with(sentence, 'the name') OR starts_with(sentence, 'this software is') OR starts_with(sentence, 'in no event') GROUP BY doc_id, place),
hits AS (SELECT doc_id, count(*) AS n, string_agg(',' || id || ',', '' ORDER BY place) AS rest FROM found GROUP BY doc_id),
seqs AS (SELECT doc_id, coalesce(n, 0)::BIGINT AS n_sentences, coalesce(rest, ',') AS rest FROM documents LEFT JOIN hits USING (doc_id)),
{", ".join(steps)}
SELECT doc_id, n_sentences, array_to_string(list_filter([{names}], lambda x, i: x IS NOT NULL AND list_position([{names}], x) = i), ',') AS licenses,
  array_to_string(list_filter(string_split(rest, ','), lambda x: x <> ''), ',') AS unmatched FROM {before}
"""


SQL = _sql()
