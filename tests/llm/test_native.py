"""Secret scan, quality rules and decontamination against plain Python, and their plans."""

import random
import re

import pytest
from brute import base_secrets, contaminated, surface

from touchline.llm import decontamination, quality_rules, secret_scan

SF = "/root/testdata/sf0.001"
SECRETS = [
    None, "", "nothing here", 'token = "0123456789abcdef0123456789abcdef" and password: hunter2!', "PASSWORD=token: 'abcdefgh'",
    "api_key = abc apikey:abcdef secret='x.y=z/w+'", "AKIA" + "A" * 12, "AKIA" + "Z9" * 8, "xAKIAAKIA" + "B" * 15 + "c",
    "f" * 23 + "g" + "0" * 24, "é😀 token=éabcdef 😀passwd = \"ab_cd-ef", "token=secret=abcdefg token==abcdef", "toKen\t=abcdef token  :  abcdef",
    "user: maria\n key Zx81kQpLm42VbNt77AA\n https://db.example.org:5432/main", "only Zx81kQpLm42VbNt77AA and https://db.example.org",
    "user=maria " + "- " * 300 + "Zx81kQpLm42VbNt77AA", "login: root token = abcdef0123", "token = abcdef0123 " * 700,
]


def test_base_secrets(documents):
    dice = random.Random(3)
    parts = ["token", "API_KEY", "secret", "=", ":", " ", '"', "'", "abcdef", "ab", "AKIA", "A1B2C3D4E5F6G7H8", "0f" * 12, "é", "\n", "."]
    texts = SECRETS + ["".join(dice.choice(parts) for _ in range(dice.randint(1, 25))) for _ in range(400)]
    rows = {r["doc_id"]: r for r in secret_scan.secret_digests(documents(texts)).collect()}
    for k, text in enumerate(texts):
        *expected, listed = base_secrets(text)
        assert tuple(rows[k])[1:5] == tuple(expected), text
        assert set(filter(None, listed.split(","))) <= set(rows[k]["spans"].split(","))


def test_weak_parts_need_each_other(documents):
    rows = {r["doc_id"]: r["spans"] for r in secret_scan.secret_digests(documents(SECRETS)).collect()}
    assert [s.split(":")[0] for s in rows[13].split(",")] == ["login", "linked", "endpoint"]
    assert rows[14] == "" and rows[15] == ""  # no identifier at all; one too far away
    assert "login:0:11" in rows[16]


def test_redaction(documents):
    rows = {r["doc_id"]: r for r in secret_scan.redacted(documents(SECRETS)).collect()}
    assert rows[0]["text"] is None and rows[2]["text"] == SECRETS[2]
    assert rows[3]["text"] == "[SECRET]\" and [SECRET]!" and rows[3]["n_chars"] == len(rows[3]["text"])
    assert rows[10]["text"] == "é😀 token=éabcdef 😀[SECRET]"
    assert rows[17]["text"].count("[SECRET]") == 700 and "abcdef" not in rows[17]["text"]
    assert rows[3]["n_words"] == 1


def test_surface_counts(documents, spark):
    dice = random.Random(4)
    words = ["a", "bb", "c#", "é|é", "<d>", "\n", "\n", "\t", "\x0b", "\x1c", "　", "the"]
    texts = [None, "", "\n \n", "one", "x y z " * 40, "l\nl\n \n \nl\n", "z " * 20_000, "w" * 100_000]
    texts += [" ".join(dice.choice(words) for _ in range(dice.randint(1, 200))) for _ in range(200)]
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = {r["doc_id"]: r for r in quality_rules.quality(documents(texts), labels).collect()}
    for k, text in enumerate(texts):
        assert tuple(rows[k])[1:7] == surface(text), text
        assert rows[k]["kept"] == (not rows[k]["base_failed"])  # without trusted documents every ratio is 0


def test_likelihood_ratio_parts_prose_from_junk(documents, spark):
    dice = random.Random(6)
    prose = [f"{a}{b}" for a in "bcdfg" for b in ("an", "el", "ist", "or")]
    junk = [w + "&&&" for w in prose]
    texts = [" ".join(dice.choice(junk if k % 4 == 0 else prose) for _ in range(80)) for k in range(400)]
    labels = spark.createDataFrame([(k, int(k % 4 > 0), 0) for k in range(200)] + [(None, 1, 0), (4, 1, 0)], "doc_id bigint, quality int, toxic int")
    rows = {r["doc_id"]: r for r in quality_rules.quality(documents(texts), labels).collect()}
    assert all(rows[k]["kept"] == (k % 4 > 0) for k in range(400))
    kept = quality_rules.quality(documents(texts), labels, keep_columns=True)
    assert kept.columns == documents([]).columns and kept.count() == 300


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog and then it sleeps"), (2, "Short item"), (3, "One"), (4, ""), (5, None),
    (6, "a b a b a b a b a b a b"), (7, "éclair au café, s'il vous plaît monsieur, un café noir"), (12, "Short item"), (None, "alpha beta"),
]


def test_contamination(documents, spark):
    dice = random.Random(8)
    pool = "the quick brown fox jumps over lazy dog and then it sleeps short item one a b".split()
    texts = [
        None, "", "THE quick, brown fox jumps over the lazy dog and", "the quick brown fox jumps over the lazy dog", "short-item!", "one",
        "a b " * 30, "x éclair au café s'il vous plaît monsieur un café noir", "ONE one ones", ("short item " * 9000).strip(), "alpha beta",
        "The quick brown fox jumps over the lazy dog and then it sleeps the quick brown fox jumps over the lazy dog and then",
    ]
    texts += [" ".join(dice.choice(pool) for _ in range(dice.randint(1, 40))) for _ in range(150)]
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    rows = {r["doc_id"]: r for r in decontamination.contamination(documents(texts), items).collect()}
    for k, text in enumerate(texts):
        assert tuple(rows[k])[1:6] == contaminated(text, [x for x in ITEMS if x[0] is not None]), text
    kept = {r["doc_id"] for r in decontamination.clean_documents(documents(texts), items).collect()}
    assert kept == {k for k in rows if not rows[k]["contaminated"]}


def test_contamination_edges(documents, spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert not any(r["contaminated"] for r in decontamination.contamination(documents(["short item"]), none).collect())
    assert decontamination.contamination(documents([]), items).collect() == []
    same = documents([(1, "short item"), (1, "short item"), (1, "clean"), (None, "one")])
    found = sorted((str(r["doc_id"]), r["n_hit"]) for r in decontamination.contamination(same, items).collect())
    assert found == [("1", 0), ("1", 2), ("1", 2), ("None", 1)]


@pytest.mark.parametrize("name", ["op3_secret_scan", "op6_quality_rules", "op9_decontamination"])
def test_no_python_and_no_cross_join_in_plans(spark, name):
    from touchline.llm.queries import QUERIES

    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
    assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_empty_tables(documents, spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality_rules.quality(documents([]), labels).collect() == []
    assert secret_scan.secret_digests(documents([])).collect() == []
    assert secret_scan.redacted(documents([])).collect() == []
