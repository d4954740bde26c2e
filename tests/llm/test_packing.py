"""Packed token ids against the tokenizer on whole texts."""

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from bankmart.llm.packing import TOKENIZER, Words, pack, pieces, write_buckets


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(TOKENIZER))


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def rows(df):
    return df.orderBy("sequence_id").collect()


def rebuilt(found):
    """Documents from pieces in order; a start of 0 begins one."""
    out = []
    for r in found:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] and r["offset"] == 0 and r["length"] & (r["length"] - 1) == 0
        if r["start"] == 0:
            out.append((r["doc_id"], []))
        assert len(out[-1][1]) == r["start"]
        out[-1][1].extend(ids)
        assert r["doc_tokens"] >= len(out[-1][1])
    return out


def test_test_table_reads_back(docs, tokenizer):
    got = rebuilt(rows(pack(docs)))
    assert sorted(got) == sorted((r.doc_id, whole(tokenizer, r.text)) for r in docs.collect())


def test_odd_rows(odd_docs, no_docs, tokenizer):
    got = rebuilt(rows(pack(odd_docs)))
    assert sorted(got, key=str) == sorted(((r[0], whole(tokenizer, r[1])) for r in odd_docs.collect()), key=str)
    assert pack(no_docs).count() == 0


def test_sequences_are_one_piece_each(docs):
    found = rows(pack(docs))
    assert len({r["sequence_id"] for r in found}) == len(found) and max(r["length"] for r in found) == 2048


def test_buckets(docs, tmp_path):
    write_buckets(pack(docs, longest=64), str(tmp_path / "b"))
    assert {p.name for p in (tmp_path / "b").iterdir() if p.is_dir()} <= {f"length={1 << b}" for b in range(7)}


@pytest.mark.parametrize("length,longest,cut", [(1, 2048, [1]), (2048, 2048, [2048]), (4100, 2048, [2048, 2048, 4]), (7, 4, [4, 2, 1])])
def test_pieces(length, longest, cut):
    assert pieces(length, longest) == cut


def test_longest_must_be_a_power_of_two(docs):
    with pytest.raises(ValueError):
        pack(docs, longest=100)


ALPHABET = st.sampled_from(list("abzAZ019'st re'll!?.,-_ \n\t\r\x0b\x1c\x85\xa0éÉßñçŒſĲıİ²½ªµ×÷Σς日本́e𝄞<|>")) | st.characters(exclude_categories=["Cs"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=40), min_size=1, max_size=5))
def test_words_equal_the_tokenizer(texts):
    words = test_words_equal_the_tokenizer.words = getattr(test_words_equal_the_tokenizer, "words", None) or Words(public_tokenizers.path(TOKENIZER))
    for text, ids in zip(texts, words.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


def test_words_come_back_from_the_old_generation(monkeypatch, tokenizer):
    monkeypatch.setattr("bankmart.llm.packing.KNOWN", 5)
    words = Words(public_tokenizers.path(TOKENIZER))
    for text in ["one two three", "four five six seven", "one two", "", "a b c d e f g h", "one <|endoftext|> don't"]:
        assert np.frombuffer(words.encode([text])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_added_tokens_are_what_a_plain_call_makes_of_them(tokenizer):
    words = Words(public_tokenizers.path(TOKENIZER))
    names = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    texts = ["a <s> b <|endoftext|> c", "<|ENDOFTEXT|>", "x<|endoftext|><|endoftext|>", *[f"before {n}after {n.upper()} {n}" for n in names]]
    for text, ids in zip(texts, words.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
