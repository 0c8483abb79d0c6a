"""Licences of texts by recognised sentences and ordered rules over their sequence.

A text is cut into sentences (at . ! ? ; : before white space, and at empty lines) and a sentence of
several lines also into its lines. Sentences are normalised to lower-case letters and digits with
single spaces and looked up, by hash, among the known sentences of licences. The identifiers found, in
order, are a short sequence, in which rules are matched one after another: a rule is a sequence of
identifiers that may have others between them, and what it matches is taken out before the next rule.
So a longer licence comes before one that is a part of it.

Rules are matched on a text with one letter for each identifier, without repeated groups, so nothing is
recursive. A letter that cannot start a match any more, because what the rule needs does not follow, is
marked before: the last place from which a rule can be completed is found by one search from the end. So
a sequence of any length and order takes time in proportion to it.

All is done inside a row: no shuffle, nothing broadcast but the fixed table in the plan. Null and empty
texts have no licence; repeated rows each have theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised sentences of licences with their identifiers.
SENTENCES = {
    "MITNAME": ("mit license", "the mit license", "the mit license mit"),
    "MITREF": ("released under the mit license", "licensed under the mit license", "this project is licensed under the mit license",
               "distributed under the mit license", "spdx license identifier mit"),
    "MITGRANT": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                 "documentation files the software to deal in the software without restriction including without limitation the "
                 "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
                 "persons to whom the software is furnished to do so subject to the following conditions",),
    "MITNOTICE": ("the above copyright notice and this permission notice shall be included in all copies or substantial portions "
                  "of the software",),
    "ISCGRANT": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
                 "granted provided that the above copyright notice and this permission notice appear in all copies",),
    "ISCREF": ("licensed under the isc license", "isc license", "spdx license identifier isc"),
    "BSDGRANT": ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
                 "following conditions are met",),
    "BSDSOURCE": ("redistributions of source code must retain the above copyright notice this list of conditions and the following "
                  "disclaimer", "1 redistributions of source code must retain the above copyright notice this list of conditions "
                  "and the following disclaimer"),
    "BSDBINARY": ("redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
                  "following disclaimer in the documentation and or other materials provided with the distribution",
                  "2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
                  "following disclaimer in the documentation and or other materials provided with the distribution"),
    "BSDNAMES": ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                 "products derived from this software without specific prior written permission",
                 "3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                 "products derived from this software without specific prior written permission"),
    "BSD3REF": ("licensed under the bsd 3 clause license", "spdx license identifier bsd 3 clause"),
    "BSD2REF": ("licensed under the bsd 2 clause license", "spdx license identifier bsd 2 clause"),
    "APACHE2REF": ("licensed under the apache license version 2 0", "licensed under the apache license 2 0",
                   "licensed under the apache license version 2 0 the license", "spdx license identifier apache 2 0",
                   "released under the apache license version 2 0"),
    "APACHEUSE": ("you may not use this file except in compliance with the license",),
    "GPL3REF": ("this work is licensed under the gnu general public license version 3", "licensed under the gnu general public "
                "license version 3", "spdx license identifier gpl 3 0 only", "released under the gnu general public license version 3"),
    "GPL2REF": ("this work is licensed under the gnu general public license version 2", "licensed under the gnu general public "
                "license version 2", "spdx license identifier gpl 2 0 only"),
    "GPLFREE": ("this program is free software",),
    "GPL3LATER": ("you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
                  "free software foundation either version 3 of the license or at your option any later version",),
    "GPL2LATER": ("you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
                  "free software foundation either version 2 of the license or at your option any later version",),
    "LGPL3LATER": ("you can redistribute it and or modify it under the terms of the gnu lesser general public license as published "
                   "by the free software foundation either version 3 of the license or at your option any later version",),
    "LGPL21LATER": ("you can redistribute it and or modify it under the terms of the gnu lesser general public license as published "
                    "by the free software foundation either version 2 1 of the license or at your option any later version",),
    "AGPL3LATER": ("you can redistribute it and or modify it under the terms of the gnu affero general public license as published "
                   "by the free software foundation either version 3 of the license or at your option any later version",),
    "LGPL3REF": ("licensed under the gnu lesser general public license version 3", "spdx license identifier lgpl 3 0 only"),
    "AGPL3REF": ("licensed under the gnu affero general public license version 3", "spdx license identifier agpl 3 0 only"),
    "MPL2REF": ("this source code form is subject to the terms of the mozilla public license v 2 0",
                "licensed under the mozilla public license version 2 0", "spdx license identifier mpl 2 0"),
    "MPL2COPY": ("if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
                 "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0"),
    "BOOSTREF": ("distributed under the boost software license version 1 0", "spdx license identifier bsl 1 0"),
    "ZLIBUSE": ("permission is granted to anyone to use this software for any purpose including commercial applications and to "
                "alter it and redistribute it freely subject to the following restrictions",),
    "CCBY4REF": ("licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"),
    "CCBYSA4REF": ("licensed under cc by sa 4 0",
                   "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    "CCBYNC4REF": ("licensed under cc by nc 4 0",
                   "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    "CCBYND4REF": ("licensed under cc by nd 4 0",),
    "CC0REF": ("licensed under cc0 1 0", "released under cc0 1 0", "spdx license identifier cc0 1 0"),
    "UNLICENSE": ("this is free and unencumbered software released into the public domain",),
    "RESERVED": ("all rights reserved",),
}

# Rules in their order: licence, class, sequences of identifiers of which any one is enough.
RULES = (
    ("Apache-2.0", "permissive", (("APACHE2REF", "APACHEUSE"), ("APACHE2REF",))),
    ("BSD-3-Clause", "permissive", (("BSDGRANT", "BSDSOURCE", "BSDBINARY", "BSDNAMES"), ("BSD3REF",))),
    ("BSD-2-Clause", "permissive", (("BSDGRANT", "BSDSOURCE", "BSDBINARY"), ("BSD2REF",))),
    ("MIT", "permissive", (("MITNAME", "MITGRANT", "MITNOTICE"), ("MITGRANT", "MITNOTICE"), ("MITREF",))),
    ("ISC", "permissive", (("ISCREF", "ISCGRANT"), ("ISCGRANT",), ("ISCREF",))),
    ("GPL-3.0-or-later", "copyleft", (("GPLFREE", "GPL3LATER"), ("GPL3LATER",))),
    ("GPL-2.0-or-later", "copyleft", (("GPLFREE", "GPL2LATER"), ("GPL2LATER",))),
    ("LGPL-3.0-or-later", "copyleft", (("LGPL3LATER",),)),
    ("LGPL-2.1-or-later", "copyleft", (("LGPL21LATER",),)),
    ("AGPL-3.0-or-later", "copyleft", (("AGPL3LATER",),)),
    ("GPL-3.0", "copyleft", (("GPL3REF",),)),
    ("GPL-2.0", "copyleft", (("GPL2REF",),)),
    ("LGPL-3.0", "copyleft", (("LGPL3REF",),)),
    ("AGPL-3.0", "copyleft", (("AGPL3REF",),)),
    ("MPL-2.0", "copyleft", (("MPL2REF", "MPL2COPY"), ("MPL2REF",), ("MPL2COPY",))),
    ("BSL-1.0", "permissive", (("BOOSTREF",),)),
    ("Zlib", "permissive", (("ZLIBUSE",),)),
    ("CC-BY-SA-4.0", "copyleft", (("CCBYSA4REF",),)),
    ("CC-BY-NC-4.0", "restricted", (("CCBYNC4REF",),)),
    ("CC-BY-ND-4.0", "restricted", (("CCBYND4REF",),)),
    ("CC-BY-4.0", "permissive", (("CCBY4REF",),)),
    ("CC0-1.0", "permissive", (("CC0REF",),)),
    ("Unlicense", "permissive", (("UNLICENSE",),)),
    ("Proprietary", "restricted", (("RESERVED",),)),
)
#: Classes from the strictest on: that of a text is the strictest of its licences.
CLASSES = ("restricted", "copyleft", "permissive")

# Where sentences and lines end, and what is not kept of a sentence.
ENDS, LINES, REST = r"[.!?;:][\x20\x09-\x0D]+|\n[\x20\x09-\x0D]*\n", r"\n", r"[^a-z0-9]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def pairs() -> list[tuple[str, str]]:
    """Normalised sentences with their identifiers."""
    return [(text, name) for name, texts in SENTENCES.items() for text in texts]


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(sentence, UPPER, LOWER), REST, " "))


def identifiers(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    known = pairs()
    hashes = F.array(*[F.xxhash64(F.lit(sentence)) for sentence, _ in known])
    names = F.array(*[F.lit(name) for _, name in known])
    units = F.flatten(F.transform(
        F.split(F.coalesce(text, F.lit("")), ENDS),
        lambda part: F.when(F.contains(part, F.lit("\n")), F.concat(F.array(part), F.split(part, LINES))).otherwise(F.array(part)),
    ))
    places = F.transform(units, lambda unit: F.array_position(hashes, F.xxhash64(normalised(unit))))
    return F.transform(F.filter(places, lambda place: place > 0), lambda place: F.element_at(names, place.cast("int")))


def pattern(sequence: tuple[str, ...]) -> str:
    """Pattern of a rule, for SQL, in a text where each identifier has its own space on either side."""
    return " " + r" (?: \w+ )*? ".join(sequence) + " "


#: Letters of an identifier: as it is, and where it cannot start a match.
LETTERS = {name: (chr(0x100 + 2 * place), chr(0x101 + 2 * place)) for place, name in enumerate(SENTENCES)}


def _either(name: str) -> str:
    return "".join(LETTERS[name])


def _rule(sequences: tuple[tuple[str, ...], ...]) -> str:
    """A rule over letters: each identifier is the next one of its name, whatever is between."""
    return "|".join(
        f"[{_either(sequence[0])}]" if len(sequence) == 1
        else LETTERS[sequence[0]][0] + "".join(f"[^{_either(name)}]*+[{_either(name)}]" for name in sequence[1:])
        for sequence in sequences
    )


def _marked(letters: Column, sequence: tuple[str, ...]) -> Column:
    """Letters of the first identifier marked behind the last place from which the sequence is complete."""
    whole = "".join(f"[^{_either(name)}]*+[{_either(name)}]" for name in reversed(sequence))
    back = F.length(F.regexp_extract(F.reverse(letters), f"^({whole})", 1))
    ahead = F.when(back > 0, F.length(letters) - back + 1).otherwise(0)
    plain, marked = LETTERS[sequence[0]]
    return F.concat(F.substr(letters, F.lit(1), ahead), F.translate(F.substr(letters, ahead + 1), plain, marked))


def _unmarked(letters: Column, sequences: tuple[tuple[str, ...], ...]) -> Column:
    firsts = {sequence[0] for sequence in sequences if len(sequence) > 1}
    plain, marked = ("".join(LETTERS[name][place] for name in sorted(firsts)) for place in (0, 1))
    return F.translate(letters, marked, plain) if firsts else letters


def scan(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text) to doc_id, n_sentences (known ones), licenses, license_class.

    ``licenses`` has the names in the order of the rules, separated by commas; without a licence it is
    empty and the class is ``none``.
    """
    found = docs.select("doc_id", identifiers(F.col("text")).alias("names"))
    names, letters = list(LETTERS), [plain for plain, _ in LETTERS.values()]
    places = F.array(*[F.lit(name) for name in names])
    spelt = F.transform("names", lambda name: F.substr(F.lit("".join(letters)), F.array_position(places, name).cast("int"), F.lit(1)))
    found = found.withColumn("left", F.array_join(spelt, ""))
    parts = []
    for number, (name, kind, sequences) in enumerate(RULES):
        has, left = f"has_{number}", F.col("left")
        for sequence in sequences:
            if len(sequence) > 1:
                left = F.when(F.contains("left", F.lit(LETTERS[sequence[0]][0])), _marked(left, sequence)).otherwise(left)
        found = found.withColumn("left", left).withColumn(has, F.col("left").rlike(_rule(sequences)))
        rest = _unmarked(F.regexp_replace("left", _rule(sequences), ""), sequences)
        found = found.withColumn("left", F.when(F.col(has), rest).otherwise(_unmarked(F.col("left"), sequences)))
        parts.append((has, name, kind))
    names = F.concat_ws(",", *[F.when(F.col(has), F.lit(name)) for has, name, _ in parts])
    strictest = F.coalesce(*[
        F.when(F.greatest(*[F.col(has) for has, _, kind in parts if kind == wanted], F.lit(False)), F.lit(wanted))
        for wanted in CLASSES
    ], F.lit("none"))
    return found.select(
        "doc_id", F.size("names").cast("bigint").alias("n_sentences"), names.alias("licenses"), strictest.alias("license_class")
    )


def sql() -> str:
    """The scan of the table ``documents`` in SQL."""
    values = ", ".join(f"('{text}', '{name}')" for text, name in pairs())
    steps, before = [], "seq"
    for number, (_, _, sequences) in enumerate(RULES):
        rule = "|".join(pattern(sequence) for sequence in sequences)
        steps.append(
            f"r{number} AS (SELECT *, regexp_matches(s, '{rule}') AS h{number} FROM "
            f"(SELECT * EXCLUDE (t), t AS s FROM {before})), "
            f"n{number} AS (SELECT * EXCLUDE (s), regexp_replace(s, '{rule}', ' ', 'g') AS t FROM r{number})"
        )
        before = f"n{number}"
    names = ", ".join(f"CASE WHEN h{n} THEN '{name}' END" for n, (name, _, _) in enumerate(RULES))
    kinds = " ".join(
        "WHEN " + " OR ".join(f"h{n}" for n, (_, kind, _) in enumerate(RULES) if kind == wanted) + f" THEN '{wanted}'"
        for wanted in CLASSES
    )
    return f"""
WITH known(sentence, name) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_split_to_array(coalesce(text, ''), '{ENDS}') AS parts FROM documents),
u AS (SELECT r, i, unnest(CASE WHEN contains(part, chr(10)) THEN list_concat([part], string_split(part, chr(10))) ELSE [part] END) AS unit,
      generate_subscripts(CASE WHEN contains(part, chr(10)) THEN list_concat([part], string_split(part, chr(10))) ELSE [part] END, 1) AS j
      FROM (SELECT r, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM d)),
f AS (SELECT r, i, j, name FROM u JOIN known
      ON trim(regexp_replace(translate(unit, '{UPPER}', '{LOWER}'), '{REST}', ' ', 'g'), ' ') = sentence),
g AS (SELECT r, string_agg(name, '  ' ORDER BY i, j) AS names, count(*) AS n FROM f GROUP BY r),
seq AS (SELECT d.doc_id, coalesce(n, 0) AS n, ' ' || coalesce(names, '') || ' ' AS t FROM d LEFT JOIN g USING (r)),
{", ".join(steps)}
SELECT doc_id, n AS n_sentences, concat_ws(',', {names}) AS licenses, CASE {kinds} ELSE 'none' END AS license_class FROM {before}
"""
