from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline
from tidemark.llm import line_rules

from .conftest import LOWER, prose, words


def brute(rows):
    """Counts and verdicts of (source, text) rows by the rules themselves."""
    lines = defaultdict(set)
    texts = defaultdict(set)
    norm = lambda line: " ".join(words(line.translate(LOWER)))
    for source, text in rows:
        texts[source].add(text or "")
        for line in (text or "").split("\n"):
            if words(line):
                lines[source, norm(line)].add(text)
    out = []
    for source, text in rows:
        own, text = words(text), text or ""
        with_words = [line for line in text.split("\n") if words(line)]
        three = [tuple(own[i:i + 3]) for i in range(len(own) - 2)]
        often = Counter(three)
        covered = {j for i, w in enumerate(three) if often[w] > 1 for j in range(i, i + 3)}
        removed = sum(
            len(words(line)) for line in with_words
            if len(lines[source, norm(line)]) > 20 and 100 * len(lines[source, norm(line)]) > 5 * len(texts[source])
        )
        failed = len(own) < 50 or 100 * len(covered) > 50 * len(own)
        depleted = removed > 0 and (100 * removed > 50 * len(own) or len(own) - removed < 20)
        out.append((
            len(own), sum(map(len, own)), sum(text.count(c) for c in "#*$%&|<>"), len(with_words) - len(set(with_words)),
            len(covered), failed, not failed and not depleted, removed,
        ))
    return out


def rows():
    common, long = "Home |  About us & more", prose(77, 60)
    made = [("a", f"{common}\n{prose(n, 70)}\n{common.upper()}") for n in range(30)]
    made += [("a", f"{long}\n{prose(500 + n, 20)}") for n in range(25)] + [("b", f"{common}\n{prose(n, 70)}") for n in range(15)]
    made += [
        ("a", None), ("a", ""), (None, "\n \n"), (None, prose(1, 49)), (None, prose(1, 50)), ("a", "one two three " * 40),
        ("a", "same line\n" * 40), ("b", "x\ty\x0bz\x0cw\r\n" * 20), ("b", "#*$%&|<> é " * 30), ("c", prose(3, 30000)),
        ("c", (prose(4, 3000) + "\n") * 3), ("a", prose(0, 70)), ("a", prose(0, 70)), ("b", "a b c d a b c " + prose(8, 60)),
    ]
    return made


def test_counts_and_verdicts(corpus):
    made = rows()
    found = line_rules.verdicts(corpus([t for _, t in made], sources=[s for s, _ in made], clashing=True)).collect()
    found = {r["doc_id"]: tuple(r[c] for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words"
    )) for r in found}
    for number, wanted in enumerate(brute(made)):
        assert found[number] == wanted, made[number]
    assert any(not r[6] and not r[5] for r in found.values())


def test_keep(corpus):
    made = rows()
    docs = corpus([t for _, t in made], sources=[s for s, _ in made], clashing=True)
    kept = line_rules.keep(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [n for n, row in enumerate(brute(made)) if row[6]]


def test_long_lines_by_number_alone(corpus):
    passage, short = prose(77, 60), "home about us"
    made = [f"{passage}\n{prose(n, 30)}" for n in range(25)] + [f"{short}\n{prose(100 + n, 70)}" for n in range(25)]
    made += [prose(1000 + n, 60) for n in range(600)]
    docs = corpus(made)
    # Below 5 % of the host: by the share nothing is common.
    assert line_rules.keep(docs).count() == len(made)
    limits = line_rules.Limits(long_line=10)
    found = {r["doc_id"]: r for r in line_rules.verdicts(docs, limits).collect()}
    assert sorted(found[n]["n_removed_words"] for n in range(25)) == [0] + [60] * 24
    assert all(found[n]["n_removed_words"] == 0 for n in range(25, len(made)))
    kept = sorted(r["doc_id"] for r in line_rules.keep(docs, limits).collect())
    assert kept == sorted(n for n in found if found[n]["kept"])
    assert len([n for n in kept if n < 25]) == 1 and kept[1:] == list(range(25, len(made)))


def test_passages_in_the_hot_source_go_in_the_pipeline(spark, corpus):
    passage = prose(77, 60)
    made = [f"{passage}\n{prose(n, 30)}" for n in range(25)] + [prose(1000 + n, 60) for n in range(600)]
    assert corpus_pipeline.within_rules(spark, corpus(made), "").count() == 601


def test_repeated_ids_and_empty_table(corpus):
    text = prose(5, 60)
    found = line_rules.verdicts(corpus([text, text, text], ids=[1, 1, None])).collect()
    assert [r["n_words"] for r in found] == [60] * 3 and all(r["kept"] for r in found)
    assert line_rules.verdicts(corpus([])).collect() == [] and line_rules.keep(corpus([])).collect() == []
