"""Token counts, BPE automaton and token store against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from touchline.llm import bpe_automaton, parity_join, pretokens, token_counts, token_output
from touchline.llm.support import BYTE_BPE, WORD_BPE, tokenizer_file

ODD = [
    None, "", " ", "plain words here", "<|endoftext|>", "a<|startoftext|>b  <|endoftext|> ", "ΣΑΣ İstanbul ǅ ﬁ",
    "it's they'll 'sabc ''s x's 's 'll' '", "  lead  \n\n x \t\n y  ", "\x1c a\x85b\xa0c　d​z", "aaa aaaaaaa " * 5,
    "١٢٣ ½ Ⅷ 12 345", "日本語 😀😀 👨‍👩‍👧", " '  's a 'm", "x̀y é", "a" * 5000, "plain words here", "the " * 20_000,
]


def texts():
    dice = random.Random(5)
    letters = "aAbeslrvtm'’ \n\t  0١.!-éÉΣßİǅ中😀́\x85<|>_"
    return ODD + ["".join(dice.choice(letters) for _ in range(dice.randint(0, 60))) for _ in range(600)]


@pytest.fixture(scope="module")
def library():
    return {name: Tokenizer.from_file(tokenizer_file(name)) for name in (WORD_BPE, BYTE_BPE)}


def test_counts(documents, library):
    all_texts = texts()
    got = {r["doc_id"]: r for r in token_counts.token_counts(documents(all_texts)).collect()}
    for k, text in enumerate(all_texts):
        n = len(library[WORD_BPE].encode(text or "", add_special_tokens=False).ids)
        assert (got[k]["n_bytes"], got[k]["n_tokens"], got[k]["over_limit"]) == (len((text or "").encode()), n, n > 2048)
    assert got[17]["over_limit"]


def test_automaton_encodes_and_decodes(documents, library):
    all_texts = texts()
    got = {r["doc_id"]: r for r in bpe_automaton.encode_documents(documents(all_texts)).collect()}
    for k, text in enumerate(all_texts):
        ids = library[WORD_BPE].encode(text or "", add_special_tokens=False).ids
        decoded = library[WORD_BPE].decode(ids, skip_special_tokens=False)
        assert got[k]["ids"] == ids and got[k]["decoded"] == decoded and got[k]["n_tokens"] == len(ids)
        assert got[k]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[k]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_pieces_do_not_change_results(documents, library, monkeypatch):
    monkeypatch.setattr(pretokens.pieces, "__defaults__", (50,))
    memo = pretokens.WordMemo(list)
    for name, keep_space, normal in ((WORD_BPE, False, pretokens.lower_nfc), (BYTE_BPE, True, None)):
        for text in (" it's  a\n\n longer   text, with 12 numbers\t and 'tails " * 9, "x" * 300):
            found = []
            for _, slots, _ in pretokens.encoded([text], {}, keep_space, normal, memo):
                found += ["".join(memo.values[s]) for s in slots]
            expect = library[name].pre_tokenizer.pre_tokenize_str(text)
            assert found == [text[a:b] for _, (a, b) in expect]


def rule_words():
    """Long words that alternate two letters by the parity of the bits of their places, and their complements.

    Hashes that are polynomials modulo a power of two cannot tell the two apart."""
    found = []
    for a, b in ("ez", "ab", "oé"):
        for size in (1024, 4096):
            found += ["".join((x, y)[k.bit_count() & 1] for k in range(size)) for x, y in ((a, b), (b, a))]
    return found


def test_words_of_one_polynomial_are_told_apart(spark, documents, library, tmp_path):
    words = rule_words()
    counts = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(documents(words)).collect()}
    coded = {r["doc_id"]: r["ids"] for r in bpe_automaton.encode_documents(documents(words)).collect()}
    token_output.write_token_store(documents(words), str(tmp_path / "store"))
    stored = {r["doc_id"]: r["ids"] for r in token_output.read_token_store(spark, str(tmp_path / "store")).collect()}
    for k, word in enumerate(words):
        ids = library[WORD_BPE].encode(word, add_special_tokens=False).ids
        assert counts[k] == len(ids) and coded[k] == ids
        assert stored[k] == [*library[BYTE_BPE].encode(word, add_special_tokens=False).ids, 0]
    sets = parity_join.near_components(documents(words)).collect()
    assert all(r["component_id"] == r["doc_id"] for r in sets)


def test_a_shared_first_hash_does_not_matter():
    memo = pretokens.WordMemo(lambda words: list(words))
    joined, starts = "aabbccaa", np.array([0, 2, 4, 6])
    both = np.array([[7, 7, 7, 7], [1, 2, 3, 1]], np.uint64)
    for _ in range(2):
        slots = memo.slots_of(joined, starts, starts + 2, both)
        assert [memo.values[s] for s in slots] == ["aa", "bb", "cc", "aa"]
    slots = memo.slots_of("dd", np.array([0]), np.array([2]), np.array([[7], [4]], np.uint64))
    assert memo.values[slots[0]] == "dd"


def test_memo_starts_anew(library):
    memo = pretokens.WordMemo(len, 3)
    memo.encode = lambda words: [len(w) for w in words]
    for text in ("one three fifteen", "a bb ccc dddd", "one a"):
        for _, slots, _ in pretokens.encoded([text], {}, False, None, memo):
            assert [memo.values[s] for s in slots] == [len(w) for w in text.split()]


def test_values_round_trip():
    values = np.array([0, 1, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1, 7, 300], np.uint32)
    for n in range(len(values) + 1):
        control, data = token_output.encode_values(values[:n])
        assert token_output.decode_values(control, data, n).tolist() == values[:n].tolist()
    assert len(token_output.encode_values(values[:4])[1]) == 1 + 1 + 1 + 2


def test_token_store(spark, documents, library, tmp_path, monkeypatch):
    monkeypatch.setattr(token_output, "BLOCK_IDS", 500)
    all_texts = texts()
    rows = [(1000 - k, t) for k, t in enumerate(all_texts)]
    token_output.write_token_store(documents(rows), str(tmp_path / "store"), shard_bytes=4000)
    back = token_output.read_token_store(spark, str(tmp_path / "store"))
    whole = {(r["doc_id"], r["start"]): r["ids"] for r in back.collect()}
    got = sorted(token_output.token_digests(spark, str(tmp_path / "store")).collect())
    before = 0
    assert len(got) == len(rows)
    for (doc, text), row in zip(sorted(rows), got):
        ids = [*library[BYTE_BPE].encode(text or "", add_special_tokens=False).ids, 0]
        assert whole[doc, before] == ids
        assert tuple(row) == (doc, before, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        before += len(ids)


def test_token_store_edges(spark, documents, tmp_path):
    token_output.write_token_store(documents([]), str(tmp_path / "none"))
    assert token_output.read_token_store(spark, str(tmp_path / "none")).collect() == []
    token_output.write_token_store(documents([(3, "b"), (None, "a"), (3, "b")]), str(tmp_path / "ties"))
    back = sorted(token_output.read_token_store(spark, str(tmp_path / "ties")).collect(), key=lambda r: r["start"])
    assert [(r["doc_id"], r["start"]) for r in back] == [(None, 0), (3, 2), (3, 4)]


def test_empty_tables(documents):
    assert token_counts.token_counts(documents([])).collect() == []
    assert bpe_automaton.encode_documents(documents([])).collect() == []
