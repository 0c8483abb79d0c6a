from __future__ import annotations

import random
import re

import pytest

from tidemark.llm import license_scan

MIT = """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """3. Neither the name of the copyright holder nor the names of its contributors
may be used to endorse or promote products derived from this software without
specific prior written permission.
"""


def by_hand(text):
    """Licences by plain string work: every sentence of a rule in order, longest rules first."""
    units = []
    for part in re.split(license_scan.ENDS, text or ""):
        units += [part, *part.split("\n")] if "\n" in part else [part]
    known = dict(license_scan.pairs())
    plain = [re.sub(license_scan.REST, " ", u.translate(str.maketrans(license_scan.UPPER, license_scan.LOWER))).strip(" ") for u in units]
    left = [known[u] for u in plain if u in known]
    names = []
    for name, _, sequences in license_scan.RULES:
        hit = True
        while hit:
            hit = False
            for start in range(len(left)):
                for sequence in sequences:
                    place, ok = start, left[start] == sequence[0]
                    for item in sequence[1:] if ok else ():
                        place = next((i for i in range(place + 1, len(left)) if left[i] == item), None)
                        if place is None:
                            ok = False
                            break
                    if ok:
                        del left[start:place + 1]
                        names.append(name)
                        hit = True
                        break
                if hit:
                    break
    return ",".join(n for n, _, _ in license_scan.RULES if n in names)


TEXTS = [
    None, "", "no licence here.", "Released under the MIT License.", MIT, "x\n" + MIT + "\ny", BSD2, BSD3, BSD3 + "\n\n" + MIT,
    "Licensed under the Apache License, Version 2.0.\nYou may not use this file except in compliance with the License.",
    "prose prose\nLicensed under CC BY-NC 4.0.\nmore; All rights reserved.", "LICENSED UNDER CC BY-NC 4.0! Licensed under CC BY 4.0.",
    "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as "
    "published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
    "The MIT License is mentioned inside a sentence that says released under the MIT license or not.", "word " * 60000 + "\nISC License",
    "Redistribution of nothing.", BSD2 + BSD2,
]


def test_licences(corpus):
    rows = {row["doc_id"]: row for row in license_scan.scan(corpus(TEXTS + [MIT], clashing=True)).collect()}
    assert {i: rows[i]["licenses"] for i in range(len(TEXTS))} == {i: by_hand(t) for i, t in enumerate(TEXTS)}
    assert rows[4]["licenses"] == rows[len(TEXTS)]["licenses"] == "MIT"
    assert rows[6]["licenses"] == "BSD-2-Clause" and rows[7]["licenses"] == "BSD-3-Clause"
    assert rows[10]["license_class"] == "restricted" and rows[0]["license_class"] == "none"
    assert rows[12]["licenses"] == "GPL-3.0-or-later" and rows[14]["licenses"] == "ISC"


def test_long_sequences_in_any_order(corpus):
    draw = random.Random(2)
    sentences = [texts[0] for texts in license_scan.SENTENCES.values()]
    grant = license_scan.SENTENCES["BSDGRANT"][0]
    texts = [
        grant + ".\n" + "All rights reserved.\n" * 2000, (grant + ".\n") * 3000,
        "\n".join(draw.choice(sentences) for _ in range(100_000)),
        "\n".join(license_scan.SENTENCES[name][0] for name in ("MITNAME", "MITGRANT") for _ in range(50_000)),
    ]
    texts += ["\n".join(draw.choice(sentences) for _ in range(draw.randint(0, 30))) for _ in range(300)]
    few = [license_scan.SENTENCES[name][0] for name in ("MITNAME", "MITGRANT", "MITNOTICE", "ISCREF", "BSDGRANT", "BSDSOURCE", "BSDBINARY")]
    texts += ["\n".join(draw.choice(few) for _ in range(draw.randint(2, 12))) for _ in range(300)]
    rows = {row["doc_id"]: row for row in license_scan.scan(corpus(texts)).collect()}
    assert rows[0]["licenses"] == "Proprietary" and rows[1]["licenses"] == rows[3]["licenses"] == ""
    assert rows[2]["n_sentences"] == 100_000
    assert [rows[n]["licenses"] for n in range(4, len(texts))] == [by_hand(text) for text in texts[4:]]


def test_empty_table(corpus):
    assert license_scan.scan(corpus([])).collect() == []


@pytest.mark.parametrize("name", list(license_scan.SENTENCES))
def test_table_is_consistent(name):
    assert all(re.sub(license_scan.REST, " ", s) == s for s in license_scan.SENTENCES[name])
    assert any(name in sequence for _, _, sequences in license_scan.RULES for sequence in sequences)
