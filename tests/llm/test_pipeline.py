"""The pipeline's stages against plain Python, one after another."""

import random
import re

import pytest
from brute import BLANK, LOWER, base_secrets, contaminated, near_components, surface
from tokenizers import Tokenizer

import corpus_pipeline
from touchline.llm import quality_rules
from touchline.llm.support import WORD_BPE, table, tokenizer_file

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, result = table(spark, SF, "documents"), {}
    result["input"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        result[name] = docs.collect()
    return result


def texts(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def test_stages_keep_and_drop(stages, spark):
    columns = table(spark, SF, "documents").columns
    before, good = texts(stages["input"]), texts(stages["quality rules"])
    assert not any(surface(t)[-1] for t in good.values()) and set(good) < set(before)
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    assert all(i in good for i, q in labels.items() if q == 1 and not surface(before[i])[-1])
    one = texts(stages["near duplicates"])
    assert set(one) == first_of_each(sorted(good.items()))
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    clean = texts(stages["decontamination"])
    assert set(clean) == {i for i, t in one.items() if not contaminated(t, items)[-1]}
    redacted = texts(stages["secret scan"])
    assert set(redacted) == set(clean)
    for i, text in redacted.items():
        assert sum(base_secrets(text)[:3]) == 0
        assert text == clean[i] or "[SECRET]" in text
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert list(stages[name][0].asDict()) == columns
    library = Tokenizer.from_file(tokenizer_file(WORD_BPE))
    assert {r["doc_id"]: r["ids"] for r in stages["bpe encoding"]} == {
        i: library.encode(t, add_special_tokens=False).ids for i, t in redacted.items()
    }


def test_run_gives_the_last_stage(spark, stages):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["ids_sha256"] for r in rows) == sorted(r["ids_sha256"] for r in stages["bpe encoding"])
    assert re.fullmatch("[0-9a-f]{64}", rows[0]["ids_sha256"])


def first_of_each(rows, size=5, percent=80):
    """The smallest id of each component of (doc_id, text) rows, by all pairs."""
    sets = []
    for i, text in rows:
        words = re.findall(BLANK, text.translate(LOWER))
        sets.append((i, {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()))
    up = {i: i for i, _ in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                up[max(root(i), root(j))] = min(root(i), root(j))
    return {root(i) for i in up}


def test_near_duplicates_are_five_words_at_four_fifths(documents, spark):
    dice = random.Random(4)
    rows = []
    for base in range(6):
        words = [f"b{base}w{k}" for k in range(100)]
        rows.append((100 * base, " ".join(words)))
        for copy in range(6):
            changed = list(words)
            # Two words of a hundred: 86 of 106 shingles of five, 92 of 104 of three; three words are too many for both.
            for at in dice.sample(range(10, 90, 10), copy // 2 + 1):
                changed[at] = f"x{base}{copy}{at}"
            rows.append((100 * base + copy + 1, " ".join(changed)))
    rows += [(900, "one two"), (901, "One  two"), (902, "")]
    kept = {r["doc_id"] for r in corpus_pipeline.keep_one_of_each(spark, documents(rows), SF).collect()}
    assert kept == first_of_each(rows) and kept != {c for _, c in near_components(rows).values()}


def test_texts_of_one_id_are_told_apart(documents, spark):
    a, b, c, d = (" ".join(f"{name}{k}" for k in range(60)) for name in "abcd")
    rows = [(1, a), (9, a), (9, b), (7, c), (7, d), (8, d), (3, b), (4, c + " more"), (7, c), (None, a), (6, ""), (6, ""), (5, None)]
    kept = corpus_pipeline.keep_one_of_each(spark, documents(rows), SF)
    assert kept.columns == documents(rows).columns
    # 9 loses both texts to other ids, 7 keeps the one that only it has first; nothing joins a with b or c with d.
    expected = [(1, a), (3, b), (4, c + " more"), (7, d), (None, a), (6, ""), (5, None)]
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(map(str, expected))
    alone = corpus_pipeline.keep_one_of_each(spark, documents([(1, a), (9, a), (9, b)]), SF).collect()
    assert sorted((r["doc_id"], r["text"]) for r in alone) == [(1, a), (9, b)]


def test_stages_on_odd_rows(documents, spark):
    """NULL and empty texts, a NULL id, equal rows and columns of any name go through every stage; so does an empty table."""
    good = " ".join(f"plain{k}" for k in range(60))
    rows = [(1, good), (1, good), (2, None), (3, ""), (None, good + " once"), (4, good + "\npassword = abc123def456 end"), (5, "short")]
    docs = documents(rows)
    assert corpus_pipeline.keep_good(spark, docs, SF).columns == docs.columns
    kept = quality_rules.quality(docs, table(spark, SF, "labels"), threshold=-99.0, keep_columns=True)  # the surface rules alone
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "1", "4", "None"]
    assert all(r["a.b"] == "a.b" and r["_found"] == "_found" and r["carried"] == "carried" for r in kept.collect())
    for stage in (corpus_pipeline.keep_one_of_each, corpus_pipeline.keep_uncontaminated, corpus_pipeline.replace_secrets):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        found = out.collect()
        assert {r["doc_id"] for r in found} >= {1, 2, 3, 5, None} and all(r["_doc"] == "_doc" and r["whole"] == "whole" for r in found)
    redacted = {r["doc_id"]: r["text"] for r in found}
    assert "abc123" not in redacted[4] and redacted[2] is None and redacted[3] == ""
    assert corpus_pipeline.encode(spark, docs, SF).count() == len(rows)
    nothing = documents([])
    for _, stage in corpus_pipeline.STAGES:
        nothing = stage(spark, nothing, SF)
        assert nothing.collect() == []
