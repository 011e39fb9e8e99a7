"""Language mixtures: n-grams against a plain count, known mixtures, held-out documents."""

import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from regulink.llm import languages as la

FOLDER = Path("/root/testdata/sf0.01")
SYLLABLES = {"aa": ["ka", "to", "mi"], "bb": ["schu", "ber", "ung"], "cc": ["ção", "ões", "lha"]}


def text(lang, n, dealt):
    return " ".join("".join(dealt.choices(SYLLABLES[lang], k=3)) for _ in range(n))


def plain_grams(t):
    t = "".join(c if c.isalpha() else " " for c in f" {t.lower()} ")
    t = " " + " ".join(t.split()) + " "
    return Counter(t[k : k + 3] for k in range(len(t) - 2) if t[k + 1] != " ")


def test_grams_are_those_of_a_plain_count():
    texts = ["", "a", "Ab, c!", "  x\n\ny  ", "é1ñ", "12", "ß", "ab" * 300, "İx", "\U0001d400b 中文"]
    document, _, counts = la.grams(texts)
    for k, t in enumerate(texts):
        assert sorted(counts[document == k]) == sorted(plain_grams(t).values()), t


@pytest.fixture
def model(spark):
    dealt = random.Random(1)
    rows = [(text(lang, 60, dealt), lang) for lang in SYLLABLES for _ in range(20)]
    rows += [("never learned from", None), (None, "aa"), ("", "bb")]
    return la.fit_languages(spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, text string, lang string"))


def test_mixtures(model):
    dealt = random.Random(2)
    assert model.names == sorted(SYLLABLES)
    texts = [text("aa", 30, dealt), text("aa", 60, dealt) + " " + text("bb", 20, dealt), "?", "", text("cc", 1, dealt)]
    said, score, chosen = la.infer(texts, model)
    assert said == ["aa", "aa", "und", "und", "cc"]
    assert chosen[:4] == [["aa"], ["aa", "bb"], [], []]
    share = sum(map(len, texts[1].split()[:60])) / len(texts[1])
    assert abs(score[1] - share) < 0.1 and score[0] == 1 and score[2] == 0


def test_rows(spark, model):
    df = spark.createDataFrame([(1, "kato", "x"), (2, None, "x"), (2, "", "x"), (None, "berung 1", "x")], "doc_id long, text string, score string")
    got = sorted((str(r["doc_id"]), r["lang_pred"], r["score"]) for r in la.identify(df, model).collect())
    assert got == [("1", "aa", 1.0), ("2", "und", 0.0), ("2", "und", 0.0), ("None", "bb", 1.0)]
    kept = la.keep_identified(df, model)
    assert kept.columns == df.columns and sorted(r["text"] for r in kept.collect()) == ["berung 1", "kato"]


def test_nothing_learned(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = la.fit_languages(df)
    assert model.names == [] and la.identify(df, model).count() == 0
    assert la.infer(["some text"], model)[0] == ["und"]


def test_without_labels_every_text_with_a_letter_stays(spark):
    df = spark.createDataFrame([(1, "an English text", None), (2, "another", None), (3, "12 ?", None), (4, None, None), (5, "", None)], "doc_id long, text string, lang string")
    kept = la.keep_identified(df, la.fit_languages(df))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2]


@pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")
def test_held_out_documents(spark):
    got = la.op7_language_id(spark, str(FOLDER)).where("held_out")
    rows = got.join(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) > 150 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98
