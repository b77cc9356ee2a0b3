"""Unit ids: learnt many at a call, forgotten when there are too many."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import pre_tokenizers

from ragloom.llm.words import GPT2_PATTERN, RecentCache, UnitIds, library_tokenizer, plain_encoder, plain_words, text_parts


def test_unit_ids_keep_what_is_asked_when_the_cache_is_emptied():
    tokenizer = library_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    ids = UnitIds(tokenizer, "<u2", lambda u: " " + u, limit=5)
    for units in (["a", "bc", "a"], ["a", "new", "words", "come", "in"], [f"u{i}" for i in range(12)], ["a"]):
        ids.learn(iter(units))
        for u in units:
            assert np.frombuffer(ids[u], "<u2").tolist() == tokenizer.encode(" " + u, add_special_tokens=False).ids
    assert len(ids) <= 5


def test_text_parts_cover_all_texts():
    texts = ["x" * n for n in (3, 0, 9, 1, 1, 30, 2)] + [None]
    parts = list(text_parts(texts, 10))
    assert [i for a, b in parts for i in range(a, b)] == list(range(len(texts)))
    assert list(text_parts([], 10)) == []


def _odd_units():
    rnd, chars = random.Random(1), "abABÀÿßÞ×÷àİſ́.,'!<|>~_09 \né"
    units = ["", "a", "A", "<|endoftext|>", "a<|endoftext|>", "it's", "a'", "\nfoo..", "foo\n", "x_y", "ÀÉ.", "ß!", "×a", "\nA", "á", "ſa"]
    return units + ["".join(rnd.choice(chars) for _ in range(rnd.randint(1, 6))) for _ in range(5000)]


@pytest.mark.parametrize("name, width", [("word_bpe_49k.json", "<u4"), ("byte_bpe_50k.json", "<u2")])
def test_plain_units_have_the_library_s_ids_without_its_rules(name, width):
    tokenizer = library_tokenizer(public_tokenizers.path(name))
    encode = plain_encoder(tokenizer, width, 1000)
    units = _odd_units()
    found = [(u, ids) for u in units if (ids := encode(u)) is not None]
    assert len(found) > 500
    for (u, ids), own in zip(found, tokenizer.encode_batch_fast([u for u, _ in found], add_special_tokens=False), strict=True):
        assert np.frombuffer(ids, width).tolist() == own.ids, u


def test_ids_asked_for_come_from_the_model_and_are_given_back():
    tokenizer = library_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))

    class Plain(UnitIds):
        def _bytes(self, ids):
            raise AssertionError("the whole library was called")

    ids = Plain(tokenizer, "<u2", lambda u: " " + u, limit=3)
    for u in ["some", "plain", "words,", "come", "some", "again", "plain"]:
        assert np.frombuffer(ids[u], "<u2").tolist() == tokenizer.encode(" " + u, add_special_tokens=False).ids
        assert len(ids) <= 3
    ids.forget()
    assert not ids


def test_tokenizers_with_other_rules_are_asked_whole():
    tokenizer = library_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    assert plain_encoder(tokenizer, "<u2", 10) is None
    ids = UnitIds(tokenizer, "<u2")
    ids.expect(["word"])
    assert list(ids) == ["word"] and np.frombuffer(ids["word"], "<u2").tolist() == tokenizer.encode("word", add_special_tokens=False).ids


def test_plain_words_are_the_pattern_s_matches():
    import regex
    assert GPT2_PATTERN == public_tokenizers.PATTERN
    for u in _odd_units():
        found = plain_words(u)
        assert found is None or found == regex.findall(GPT2_PATTERN, u), u


def test_recent_cache_keeps_what_was_asked_for_since():
    asked = []
    cache = RecentCache(lambda u: asked.append(u) or u * 2, 2)
    assert [cache[u] for u in "abcada"] == [u * 2 for u in "abcada"] and len(cache) <= 2
    assert asked == ["a", "b", "c", "d"]
