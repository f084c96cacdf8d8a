"""Licence recognition: sentences to identifiers, identifier sequences to licences.

A text is split into sentences, each is normalised (lower case, letters and digits only) and known licence sentences are
found in it as sequences of words; rules in order are then matched against a text's sequence of identifiers. All of it is
one projection: no join, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .quality import let

#: Known licence sentences after normalisation, and their identifiers (one letter-and-digit word each).
SENTENCES = (
    ("licensed under the apache license version 2 0", "A1"),
    ("you may not use this file except in compliance with the license", "A2"),
    ("you may obtain a copy of the license at", "A3"),
    ("this work is licensed under the gnu general public license version 3", "G1"),
    ("this program is free software", "G2"),
    ("you can redistribute it and or modify it under the terms of the gnu general public license", "G3"),
    ("released under the mit license", "M1"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "M2"),
    ("the software is provided as is without warranty of any kind", "M3"),
    ("licensed under cc by nc 4 0", "C1"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "C2"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "B1"),
    ("neither the name of the copyright holder nor the names of its contributors may be used", "B2"),
    ("all rights reserved", "R1"),
    ("licensed under the mit license", "M4"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "I1"),
    ("the software is provided as is and the author disclaims all warranties", "I2"),
    ("this software is provided as is without any express or implied warranty", "Z1"),
    ("permission is granted to anyone to use this software for any purpose including commercial applications", "Z2"),
    ("this source code form is subject to the terms of the mozilla public license v", "P1"),
    ("licensed under the mozilla public license version 2 0", "P2"),
    ("under the terms of the gnu lesser general public license", "L1"),
    ("licensed under the gnu lesser general public license version 3", "L2"),
    ("licensed under the gnu lesser general public license version 2 1", "L3"),
    ("under the terms of the gnu affero general public license", "F1"),
    ("licensed under the gnu affero general public license version 3", "F2"),
    ("licensed under the gnu general public license version 2", "G4"),
    ("this is free and unencumbered software released into the public domain", "U1"),
    ("anyone is free to copy modify publish use compile sell or distribute this software", "U2"),
    ("dedicated to the public domain", "D1"),
    ("cc0 1 0 universal", "D2"),
    ("licensed under a creative commons attribution sharealike 4 0 international license", "C3"),
    ("licensed under a creative commons attribution noncommercial 4 0 international license", "C4"),
    ("licensed under cc by 4 0", "C5"),
    ("licensed under cc by sa 4 0", "C6"),
    ("redistributions of source code must retain the above copyright notice", "B3"),
    ("redistributions in binary form must reproduce the above copyright notice", "B4"),
    ("this software is provided by the copyright holders and contributors as is", "B5"),
    ("distributed under the boost software license version 1 0", "O1"),
    ("made available under the terms of the eclipse public license 2 0", "E1"),
    ("spdx license identifier mit", "S1"),
    ("spdx license identifier apache 2 0", "S2"),
    ("spdx license identifier gpl 3 0 or later", "S3"),
    ("spdx license identifier bsd 3 clause", "S4"),
    ("spdx license identifier mpl 2 0", "S5"),
)
#: (licence, pattern over the identifiers, each with a leading and a trailing space), most specific first: a text has
#: every licence whose pattern is found, but for those that a listed earlier licence of the same family implies.
RULES = (
    ("Apache-2.0-header", " A1 (?:[A-Z][0-9] )?A2 A3 "),
    ("Apache-2.0", " (?:A1|S2) "),
    ("GPL-3.0-notice", " G2 G3 "),
    ("GPL-3.0", " (?:G1|S3) "),
    ("GPL-2.0", " G4 "),
    ("AGPL-3.0-notice", " G2 (?:[A-Z][0-9] )*F1 "),
    ("AGPL-3.0", " F2 "),
    ("LGPL-notice", " (?:[A-Z][0-9] )*L1 "),
    ("LGPL-3.0", " L2 "),
    ("LGPL-2.1", " L3 "),
    ("MPL-2.0", " (?:P1|P2|S5) "),
    ("EPL-2.0", " E1 "),
    ("BSL-1.0", " O1 "),
    ("MIT-text", " M2 (?:[A-Z][0-9] )*M3 "),
    ("MIT", " (?:M1|M4|S1) "),
    ("ISC", " I1 (?:[A-Z][0-9] )*I2 "),
    ("Zlib", " Z1 (?:[A-Z][0-9] )*Z2 "),
    ("Unlicense", " U1 (?:[A-Z][0-9] )*U2 "),
    ("CC0-1.0", " (?:D2 (?:[A-Z][0-9] )*D1|D1 (?:[A-Z][0-9] )*D2) "),
    ("CC-BY-NC-4.0", " (?:C1|C4) "),
    ("CC-BY-SA-4.0", " (?:C3|C6) "),
    ("CC-BY-4.0", " (?:C2|C5) "),
    ("BSD-3-Clause", " (?:B1 (?:[A-Z][0-9] )*B2|S4) "),
    ("BSD-2-Clause", " B1 (?:[A-Z][0-9] )*B3 (?:[A-Z][0-9] )*B4 "),
    ("BSD", " B1 "),
    ("public-domain", " (?:U1|D1) "),
    ("proprietary", " R1 "),
)
#: (licence, licence that it implies): the implied one is left out beside it.
IMPLIED = (("Apache-2.0-header", "Apache-2.0"), ("BSD-3-Clause", "BSD-2-Clause"), ("BSD-3-Clause", "BSD"), ("BSD-2-Clause", "BSD"), ("Unlicense", "public-domain"), ("CC0-1.0", "public-domain"))
#: A sentence ends at a blank line, at ; ! or ?, and at a period before white space or the end.
SPLIT = r"\n\s*\n|[;!?]+|[.]+(?=\s|$)"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def recognise(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sentences: Sequence[tuple[str, str]] = SENTENCES, rules: Sequence[tuple[str, str]] = RULES, implied: Sequence[tuple[str, str]] = IMPLIED) -> DataFrame:
    """Per row: id_col, n_sentences (known ones found), sentence_ids (in order, joined by spaces), licenses (joined by
    commas, in the order of the rules; empty if none).

    Null and empty texts have none. A known sentence counts each time it occurs, also within a longer sentence; of those
    that begin at one word the longest counts. Repeated rows are judged one by one; only the id is carried over, so other
    columns cannot clash; a text's length bounds its memory. Sentences are normalised like the texts; at least one sentence
    and one rule are needed, and identifiers are a capital letter and a digit, as the rules' patterns expect.
    """
    sentences = [(" ".join(regex.findall(r"[\p{L}\p{N}]+", s.lower())), k) for s, k in sentences]
    quoted = "`" + text_col.replace("`", "``") + "`"
    table = "map(" + ", ".join(f"{_literal(s)}, {_literal(k)}" for s, k in sentences) + ")"
    normal = r"concat(' ', trim(regexp_replace(x, '[^\\p{L}\\p{N}]+', ' ')), ' ')"
    known = "(?<= )(?=(" + "|".join(sorted((s for s, _ in sentences), key=len, reverse=True)) + ") )"
    # A cheap look for two first words spares most texts the rest; it rejects none that holds a sentence of the table.
    starts = sorted({r"[^\\p{L}\\p{N}]+".join(s.split(" ")[:2]) for s, _ in sentences})
    text = f"lower(CAST({quoted} AS STRING))"
    split = SPLIT.replace("\\", "\\\\")
    found = f"flatten(transform(split(t, '{split}'), x -> regexp_extract_all({normal}, '{known}', 1)))"
    ids = let(text, "t", f"CASE WHEN t RLIKE '{'|'.join(starts)}' THEN transform({found}, x -> element_at({table}, x)) ELSE CAST(array() AS array<string>) END")
    drop = "".join(f" AND NOT (r = {_literal(b)} AND array_contains(h, {_literal(a)}))" for a, b in implied)
    all_rules = "array(" + ", ".join(f"CASE WHEN i RLIKE {_literal(p)} THEN {_literal(n)} END" for n, p in rules) + ")"
    hits = let(f"filter({all_rules}, r -> r IS NOT NULL)", "h", f"array_join(filter(h, r -> true{drop}), ',')")
    found = let(ids, "k", let("concat(' ', array_join(k, '  '), ' ')", "j", let("concat(replace(j, '  ', ' '), '')", "i", f"named_struct('n', CAST(size(k) AS BIGINT), 'ids', trim(i), 'licenses', CASE WHEN size(k) = 0 THEN '' ELSE {hits} END)")))
    got = docs.select(F.col(id_col), F.explode(F.array(F.expr(found))).alias("found"))
    return got.select(id_col, F.col("found.n").alias("n_sentences"), F.col("found.ids").alias("sentence_ids"), F.col("found.licenses").alias("licenses"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recognise(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP2_SQL = (
    "WITH s(s, k) AS (VALUES "
    + ", ".join(f"('{s}', '{k}')" for s, k in SENTENCES)
    + r"""),
p AS (SELECT doc_id, string_split(regexp_replace(lower(coalesce(text, '')), '\n\s*\n|[;!?]+|[.]+(\s|$)', chr(1), 'g'), chr(1)) AS p FROM documents),
x AS (SELECT doc_id, unnest(p) AS x, generate_subscripts(p, 1) AS i FROM p),
n AS (SELECT doc_id, i, trim(regexp_replace(x, '[^\p{L}\p{N}]+', ' ', 'g')) AS x FROM x),
h AS (SELECT doc_id, i, s, k, string_split(x, ' ') AS w, len(string_split(s, ' ')) AS n FROM n JOIN s ON contains(' ' || x || ' ', ' ' || s || ' ')),
o AS (SELECT *, unnest(range(1, len(w) - n + 2)) AS o FROM h),
f AS (SELECT doc_id, i, o, arg_max(k, n) AS k FROM o WHERE array_to_string(w[o:o + n - 1], ' ') = s GROUP BY doc_id, i, o),
g AS (SELECT doc_id, count(*) AS n_sentences, string_agg(k, ' ' ORDER BY i, o) AS ids FROM f GROUP BY doc_id),
l AS (SELECT doc_id, n_sentences, ids, list_filter(["""
    + ", ".join(f"CASE WHEN regexp_matches(' ' || ids || ' ', '{p}') THEN '{n}' END" for n, p in RULES)
    + r"""], lambda r: r IS NOT NULL) AS h FROM g)
SELECT d.doc_id, coalesce(n_sentences, 0)::BIGINT AS n_sentences, coalesce(ids, '') AS sentence_ids,
       coalesce(array_to_string(list_filter(h, lambda r: NOT ("""
    + " OR ".join(f"(r = '{b}' AND list_contains(h, '{a}'))" for a, b in IMPLIED)
    + r""")), ','), '') AS licenses
FROM documents d LEFT JOIN l USING (doc_id)
"""
)
