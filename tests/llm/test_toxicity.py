from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity
from tidemark.llm.common import training_row

from .conftest import prose


def scores(docs, lexicon):
    return {r["doc_id"]: r["s"] for r in docs.select("doc_id", toxicity.toxicity(F.col("text"), lexicon).alias("s")).collect()}


def labelled(spark, toxic, clean):
    rows = [(i, 1, t) for i, t in enumerate(toxic)] + [(10000 + i, 0, t) for i, t in enumerate(clean)]
    return spark.createDataFrame(rows, "doc_id long, label int, text string")


def spoiled(n, word):
    own = prose(n, 40 + n % 60).split()
    own[n % 30] = word
    return " ".join(own)


def test_learns_words_and_beginnings_of_words(spark, corpus):
    toxic = [spoiled(n, ["zorblat", f"krumpf{'xyz'[n % 3]}{prose(n, 1)}"][n % 2]) for n in range(120)]
    clean = [prose(5000 + n, 60) for n in range(300)]
    lexicon = toxicity.learn(labelled(spark, toxic[:80], clean[:200]))
    found = scores(corpus(toxic[80:] + clean[200:] + ["KRUMPFish", "zоrbl4t", prose(9, 20000)], clashing=True), lexicon)
    assert all(found[i] >= 0.7 for i in range(40)) and all(found[40 + i] < 0.7 for i in range(100))
    assert found[140] >= 0.7 and found[141] >= 0.7 and found[142] < 0.7


def test_words_that_only_begin_like_a_term(spark, corpus):
    harsh = ["pathetic", "moron", "idiot", "stupid", "trash"]
    toxic = [spoiled(n, harsh[n % 5]) for n in range(150)]
    clean = [prose(5000 + n, 60) for n in range(300)]
    lexicon = toxicity.learn(labelled(spark, toxic, clean))
    assert {f"{word} " for word in harsh} <= set(lexicon.weights)
    texts = [
        "the path to the station", "a trip to Morocco", "an idiom is an idiosyncratic phrase", "he lay in a stupor", "a tram came",
        "you are an idiot", "what a pathetic try",
    ]
    found = scores(corpus(texts), lexicon)
    assert [found[n] >= 0.7 for n in range(len(texts))] == [False] * 5 + [True] * 2


def test_built_in_terms_go_once_there_are_labels(spark):
    toxic = [spoiled(n, "zorblat") for n in range(40)]
    # A word that is harsh elsewhere is common and clean here.
    clean = [spoiled(5000 + n, "clown") for n in range(40)]
    lexicon = toxicity.learn(labelled(spark, toxic, clean))
    assert "zorblat " in lexicon.weights and not set(toxicity.BUILT_IN) & {term.strip() for term in lexicon.weights}


@pytest.mark.skipif(not Path("/root/testdata/sf0.1").exists(), reason="test data are not here")
def test_held_out_rows(spark, corpus):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    learning = training_row(F.col("doc_id"), 3, 1)
    lexicon = toxicity.learn(toxicity.sample(docs, labels.where(learning)))
    held = docs.join(labels.where(~learning), "doc_id").select("toxic", toxicity.toxicity(F.col("text"), lexicon).alias("s"))
    found = {row["toxic"]: row["caught"] for row in held.groupBy("toxic").agg(F.avg((F.col("s") >= 0.7).cast("int")).alias("caught")).collect()}
    assert found[1] >= 0.86 and found[0] <= 0.01


def test_folding():
    assert toxicity.fold("1d10t m0r0n ѕtupіd ｔｒａｓｈ sc​um L0SER") == " idiot moron stupid trash scum loser "
    assert toxicity.fold("in 2024 and 17 of 30") == " in and of "
    assert toxicity.fold("") == toxicity.fold("12 %") == ""


def brute(folded, lexicon):
    """Longest terms at word starts, none inside an exception, by plain comparison."""
    hits = []
    spans = [
        (i, i + len(p) + 2) for p in lexicon.exceptions for i in range(len(folded)) if folded.startswith(f" {p} ", i)
    ]
    for i in range(len(folded)):
        terms = [t for t in lexicon.weights if folded.startswith(f" {t}", i)]
        if terms and not any(a <= i < b - 1 for a, b in spans):
            hits.append(lexicon.weights[max(terms, key=len)])
    return sum(hits)


def test_matches_equal_brute_force():
    lexicon = toxicity.Lexicon({"trash": 2.0, "trash ": 3.0, "tra": 0.5, "clown": 1.0, "idio": 4.0}, ("trash can", "circus clown"))
    built = toxicity.automaton(lexicon)
    for text in (
        "trash", "trash can", "the trash can is trash", "trashy tractor", "circus clown clown", "idiots idiot idi", "trash trash can trash",
        "a circus clown", "cantrash clowns",
    ):
        folded = toxicity.fold(text)
        assert sum(w for _, _, w in toxicity.matches(folded, built)) == brute(folded, lexicon), text


def test_awkward_texts_and_tables(spark, corpus):
    lexicon = toxicity.learn(labelled(spark, [], []))
    found = scores(corpus([None, "", "  \n", "you idiot", "plain words", "you idiot"]), lexicon)
    assert found[0] == found[1] == found[2] == found[4] < 0.7 <= found[3] == found[5]
    assert scores(corpus([]), lexicon) == {}


def test_longer_texts_need_more(spark):
    lexicon = toxicity.Lexicon({"idiot": 3.0})
    built = toxicity.automaton(lexicon)
    assert toxicity.strength("idiot " + prose(1, 50), built) > toxicity.strength("idiot " + prose(1, 5000), built) > 0
