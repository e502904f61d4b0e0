"""License scan by sentence rules.

A text is cut into sentences, each is normalised and looked up among known
license sentences, and the sequence of identifiers found is matched against
rules in order; a rule consumes the sentences it matches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import ascii_lower, table

# Sentences of public license texts as `normal` leaves them, by
# identifier. One identifier may have several wordings.
SENTENCES = {
    "spdx-license-identifier": "SpdxTag",
    "mit": "MitName", "apache-2.0": "ApacheName", "gpl-3.0-only": "Gpl3Name", "gpl-2.0-only": "Gpl2Name",
    "bsd-3-clause": "Bsd3Name", "bsd-2-clause": "Bsd2Name", "mpl-2.0": "MplName", "isc": "IscName",
    "released under the mit license": "MitRef",
    "licensed under the mit license": "MitRef",
    "this project is licensed under the mit license": "MitRef",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and/or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MitGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MitNotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MitWarranty",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "MitLiability",
    "licensed under the apache license version 2.0": "ApacheRef",
    "licensed under the apache license version 2.0 the license": "ApacheHead",
    "you may not use this file except in compliance with the license": "ApacheComply",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "ApacheWarranty",
    "see the license for the specific language governing permissions and limitations under the license": "ApacheSee",
    "this work is licensed under the gnu general public license version 3": "Gpl3Ref",
    "licensed under the gnu general public license version 3": "Gpl3Ref",
    "licensed under the gnu general public license version 2": "Gpl2Ref",
    "you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation": "GplTerms",
    "either version 2 of the license or at your option any later version": "Version2Later",
    "either version 3 of the license or at your option any later version": "Version3Later",
    "see the gnu general public license for more details": "GplSee",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BsdGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BsdSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution": "BsdBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BsdEndorse",
    "permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "IscGrant",
    "this source code form is subject to the terms of the mozilla public license v. 2.0": "MplRef",
    "this is free and unencumbered software released into the public domain": "Unlicense",
    "all rights reserved": "AllRights",
    "licensed under cc by 4.0": "CcBy4Ref", "licensed under cc by-sa 4.0": "CcBySa4Ref",
    "licensed under cc by-nc 4.0": "CcByNc4Ref", "licensed under cc by-nd 4.0": "CcByNd4Ref",
    "this work is licensed under a creative commons attribution 4.0 international license": "CcBy4Ref",
}

# License of an identifier sequence; longer evidence comes first.
RULES = [
    ("MIT", "MitGrant MitNotice MitWarranty MitLiability"),
    ("Apache-2.0", "ApacheHead ApacheComply ApacheWarranty ApacheSee"),
    ("BSD-3-Clause", "BsdGrant BsdSource BsdBinary BsdEndorse"),
    ("BSD-2-Clause", "BsdGrant BsdSource BsdBinary"),
    ("GPL-3.0-or-later", "GplTerms Version3Later"), ("GPL-2.0-or-later", "GplTerms Version2Later"),
    ("MIT", "SpdxTag MitName"), ("Apache-2.0", "SpdxTag ApacheName"), ("GPL-3.0-only", "SpdxTag Gpl3Name"),
    ("GPL-2.0-only", "SpdxTag Gpl2Name"), ("BSD-3-Clause", "SpdxTag Bsd3Name"), ("BSD-2-Clause", "SpdxTag Bsd2Name"),
    ("MPL-2.0", "SpdxTag MplName"), ("ISC", "SpdxTag IscName"),
    ("MIT", "MitRef"), ("MIT", "MitGrant"), ("Apache-2.0", "ApacheRef"), ("Apache-2.0", "ApacheHead"),
    ("GPL-3.0-only", "Gpl3Ref"), ("GPL-2.0-only", "Gpl2Ref"), ("GPL", "GplTerms"), ("ISC", "IscGrant"),
    ("MPL-2.0", "MplRef"), ("Unlicense", "Unlicense"), ("CC-BY-4.0", "CcBy4Ref"), ("CC-BY-SA-4.0", "CcBySa4Ref"),
    ("CC-BY-NC-4.0", "CcByNc4Ref"), ("CC-BY-ND-4.0", "CcByNd4Ref"),
]

#: Each known sentence holds one of these words, so a piece without any of
#: them is no known sentence and need not be normalised.
TRIGGERS = "license|licence|copyright|software|spdx|conditions|noninfringement|redistribution|mozilla|rights|mit|apache|gpl|bsd|mpl|isc"


def normal(piece):
    """Lower case, one spelling of license, words and version numbers kept,
    everything else one blank, no dots, dashes or slashes at the ends."""
    s = F.regexp_replace(ascii_lower(piece), "licence", "license")
    s = F.regexp_replace(s, "[^a-z0-9.+/-]+", " ")
    return F.regexp_replace(s, "^[ ./-]+|[ ./-]+$", "")


def pieces(text):
    """Sentences: ends are .!?;: before white space, and blank lines."""
    s = F.regexp_replace(text, r"([.!?;:])[ \t\r\n]+", "$1\u0001")
    return F.split(F.regexp_replace(s, r"\n[ \t\r]*\n", "\u0001"), "\u0001")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_pieces, n_known, sentences, licenses, n_left of every row.

    sentences and licenses are comma-joined in text order and rule order;
    n_left counts known sentences that no rule used. A sentence broken over
    lines is read whole; a piece of several lines that is not known as a whole
    is read line by line. Null or empty text has no sentence. Rows are judged
    one by one, so repeated rows and null ids pass through; other columns are
    ignored.
    """
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    trigger = F.lit(f"(?i){TRIGGERS}")
    lookup = lambda p: F.try_element_at(known, normal(p))
    ids_of = lambda p: F.when(lookup(p).isNotNull(), F.array(lookup(p))).otherwise(
        F.filter(F.transform(F.split(p, "\n"), lookup), lambda x: x.isNotNull()))
    got = docs.select("doc_id", pieces(F.coalesce("text", F.lit(""))).alias("p"))
    got = got.select("doc_id", F.size("p").alias("n_pieces"), F.flatten(F.transform(
        F.filter("p", lambda x: F.regexp_like(x, trigger)), ids_of)).alias("ids"))
    # each identifier stands between blanks of its own: neighbours share none
    seq = F.concat(F.lit(" "), F.array_join("ids", "  "), F.lit(" "))
    found = []
    for name, rule in RULES:
        wanted = f" {rule.replace(' ', '  ')} "
        found.append(F.when(F.contains(seq, F.lit(wanted)), name))
        seq = F.replace(seq, F.lit(wanted), F.lit(" "))
    left = F.size(F.filter(F.split(seq, " "), lambda x: x != ""))
    return got.select("doc_id", "n_pieces", F.size("ids").alias("n_known"), F.array_join("ids", ",").alias("sentences"),
                      F.array_join(F.array_distinct(F.filter(F.array(*found), lambda x: x.isNotNull())), ",").alias("licenses"),
                      left.alias("n_left"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def _oracle() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quote(k)}, {quote(v)})" for k, v in SENTENCES.items())
    rules = [(name, f" {rule.replace(' ', '  ')} ") for name, rule in RULES]
    steps = "seq0"
    prev = []
    for i, (name, wanted) in enumerate(rules):
        prev.append(f"s{i + 1} AS (SELECT *, replace(seq{i}, {quote(wanted)}, ' ') AS seq{i + 1}, "
                    f"CASE WHEN contains(seq{i}, {quote(wanted)}) THEN {quote(name)} END AS r{i} FROM s{i})")
    n = len(rules)
    norm = lambda x: (f"regexp_replace(regexp_replace(replace(translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "  # noqa: E731
                      "'licence', 'license'), '[^a-z0-9.+/-]+', ' ', 'g'), '^[ ./-]+|[ ./-]+$', '', 'g')")
    names = ", ".join(f"r{i}" for i in range(n))
    order = list(dict.fromkeys(name for name, _ in RULES))
    return f"""
WITH known(s, id) AS (VALUES {known}),
d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(regexp_replace(regexp_replace(coalesce(text, ''),
  '([.!?;:])[ \\t\\r\\n]+', '\\1' || chr(1), 'g'), '\\n[ \\t\\r]*\\n', chr(1), 'g'), chr(1)) AS p FROM documents),
x AS (SELECT rid, generate_subscripts(p, 1) AS i, unnest(p) AS piece FROM d),
w AS (SELECT rid, i, 0 AS j, id FROM x JOIN known ON s = {norm('piece')}),
l AS (SELECT rid, i, generate_subscripts(string_split(piece, chr(10)), 1) AS j, unnest(string_split(piece, chr(10))) AS line
  FROM x WHERE contains(piece, chr(10)) AND NOT EXISTS (SELECT 1 FROM w WHERE w.rid = x.rid AND w.i = x.i)),
h AS (SELECT * FROM w UNION ALL SELECT rid, i, j, id FROM l JOIN known ON s = {norm('line')}),
s0 AS (SELECT d.rid, any_value(doc_id) AS doc_id, any_value(len(p)) AS n_pieces, count(h.id) AS n_known,
  coalesce(string_agg(h.id, ',' ORDER BY i, j), '') AS sentences,
  ' ' || coalesce(string_agg(h.id, '  ' ORDER BY i, j), '') || ' ' AS {steps} FROM d LEFT JOIN h USING (rid) GROUP BY d.rid),
{", ".join(prev)}
SELECT doc_id, CAST(n_pieces AS INTEGER) AS n_pieces, CAST(n_known AS INTEGER) AS n_known, sentences,
  array_to_string(list_filter([{", ".join(quote(o) for o in order)}], lambda o: list_contains([{names}], o)), ',') AS licenses,
  CAST(len(list_filter(string_split(seq{n}, ' '), lambda y: y <> '')) AS INTEGER) AS n_left FROM s{n}
"""


ORACLE_SQL = _oracle()
