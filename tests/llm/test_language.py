"""Language identification: held-out accuracy, calibration and the rules around it."""

import random
import zlib

import numpy as np
import pytest

from touchline.llm import language_id

SF = "/root/testdata/sf0.01"
SYLLABLES = {"aa": ["ka", "mo", "ti", "ru"], "bb": ["sch", "ung", "ei", "ver"], "cc": ["ção", "lh", "nh", "os"]}


def corpus(n=240):
    dice = random.Random(2)
    rows = []
    for k in range(n):
        lang = sorted(SYLLABLES)[k % 3]
        words = ["".join(dice.choice(SYLLABLES[lang]) for _ in range(dice.randint(1, 3))) for _ in range(dice.randint(3, 30))]
        rows.append((k, " ".join(words), lang))
    return rows


@pytest.fixture(scope="module")
def labelled(spark):
    rows = corpus() + [(1000, None, "aa"), (1001, "123 ... !", "bb"), (1002, "", None), (None, "ka mo", None), (1003, "verung", None)]
    return spark.createDataFrame([(*r, "s", "x") for r in rows], "doc_id bigint, text string, lang string, source string, score string")


def test_held_out_documents_are_found(labelled):
    model = language_id.fit(labelled)
    rows = language_id.identify(labelled, model).collect()
    truth = dict((i, lang) for i, _, lang in corpus())
    for r in rows:
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    mine = [r for r in rows if r["doc_id"] in truth and r["held_out"]]
    assert len(mine) > 20 and np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in mine]) > 0.95
    by_id = {r["doc_id"]: r for r in rows}
    assert [by_id[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and by_id[1003]["lang_pred"] == "bb"
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean(model.weights == 0) > 0.5 and model.temperature > 0


def test_nothing_is_learned_from_the_held_out_fold(labelled, spark):
    from pyspark.sql import functions as F

    wrong = labelled.withColumn("lang", F.when(language_id.held_out(), F.lit("aa")).otherwise(F.col("lang")))
    a, b = language_id.fit(labelled), language_id.fit(wrong)
    assert a.languages == b.languages and np.array_equal(a.weights, b.weights) and a.temperature == b.temperature


def test_no_model_and_empty(spark, documents):
    unlabelled = documents(["some text", None], lang=None)
    assert language_id.fit(unlabelled) is None
    assert {r["lang_pred"] for r in language_id.identify(unlabelled, None).collect()} == {"und"}
    assert language_id.identify(documents([]), None).collect() == []


def test_pieces_do_not_change_features(monkeypatch):
    from touchline.llm import pretokens

    text = "Ein längerer Text, dessen Wörter zählen. " * 20
    whole = language_id.gram_counts([text])[0]
    monkeypatch.setattr(pretokens.pieces, "__defaults__", (40,))
    cut = language_id.gram_counts([text])[0]
    assert np.array_equal(whole[0], cut[0]) and np.array_equal(whole[1], cut[1])


def test_accuracy_on_driver_documents(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    found = language_id.identify(documents, language_id.fit(documents)).join(documents.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.95


def test_a_rare_language_is_in_the_sample(spark):
    dice = random.Random(7)
    word = lambda lang: "".join(dice.choice(SYLLABLES[lang]) for _ in range(3))
    rows = [(k, " ".join(word("aa") for _ in range(15)), "aa") for k in range(6000)]
    rows += [(9000 + k, " ".join(word("bb") for _ in range(15)), "bb") for k in range(60)]
    rows += [(9500 + k, " ".join(word("cc") for _ in range(15)), "cc") for k in range(4) if zlib.crc32(str(9500 + k).encode()) % 5]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.fit(docs, sample_docs=240)
    assert model.languages == ["aa", "bb", "cc"]
    hashed = docs.selectExpr("lang", "xxhash64(doc_id) as hash", "xxhash64(text) as tie")
    sampled = [r["lang"] for r in language_id.sampled_keys(hashed, 240).collect()]
    assert len(sampled) == 240 and sampled.count("bb") >= 20 and sampled.count("cc") == sum(r[2] == "cc" for r in rows)
    found = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs, model).collect()}
    assert np.mean([found[i] == lang for i, _, lang in rows if lang == "bb"]) > 0.9
    assert np.mean([found[i] == lang for i, _, lang in rows if lang == "aa"]) > 0.9
