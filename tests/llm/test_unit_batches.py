"""Units of many texts at a call, in Arrow, give what whole texts give."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import pre_tokenizers

from ragloom.llm import bpe, brown, exact_dedup, setsketch
from ragloom.llm.jaccard_rtree import Limit
from ragloom.llm.words import (WordCounts, WordIds, flat_lists, gpt2_unit_lists, library_ids, library_tokenizer, parts_of,
                               plain_unit_lists, spelled, word_lists)


def _texts():
    rnd, chars = random.Random(2), "abABÀÿßÞ×İſ́.,'!<|>~_09 \n\n  \té\x0b\x85 漢"
    texts = ["", None, " ", "\n", "A b\nC d.\n\nE", "<|endoftext|> a<|endoftext|>", "it's  two", " lead", "trail ", "same Same same!"]
    return texts + ["".join(rnd.choice(chars) for _ in range(rnd.randint(1, 60))) for _ in range(1500)]


def _encoded(ids, name, texts):
    out = []
    for part in parts_of(pa.array(texts, pa.string()), 2000):
        if name.startswith("byte"):
            out += ids.lists(*spelled(gpt2_unit_lists(part)))
        else:
            units, offsets = flat_lists(plain_unit_lists(part))
            found = units.dictionary_encode()
            out += ids.lists(found.dictionary, found.indices.to_numpy(), offsets[1:])
    return out


@pytest.mark.parametrize("limit", [3, 100_000])
@pytest.mark.parametrize("name, width", [("word_bpe_49k.json", "<u4"), ("byte_bpe_50k.json", "<u2")])
def test_ids_of_batches_are_the_library_s(name, width, limit):
    tokenizer, texts = library_tokenizer(public_tokenizers.path(name)), _texts()
    for got, text in zip(_encoded(library_ids(tokenizer, width, limit), name, texts), texts, strict=True):
        assert np.frombuffer(got, width).tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_units_of_tokenizers_with_other_rules_are_encoded_whole():
    tokenizer = library_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Digits(), pre_tokenizers.ByteLevel(add_prefix_space=False)])
    texts = ["some words, 12 of them", "and\nlines"]
    for got, text in zip(_encoded(library_ids(tokenizer, "<u2"), "byte", texts), texts, strict=True):
        assert np.frombuffer(got, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_a_word_is_encoded_once_while_it_is_held():
    asked = []
    ids = WordIds(lambda words: asked.extend(words) or [w.encode() for w in words], 3)
    for words in (["a", "b"], ["b", "c"], ["a", "d", "e"], ["a", "e"]):
        assert ids.of(words) == [w.encode() for w in words]
        assert len(ids) <= 3 and len(ids._older) <= 3
    assert sorted(asked) == ["a", "b", "c", "d", "e"]


def test_parts_cover_all_texts():
    texts = pa.array(["x" * n for n in (3, 0, 9, 1, 1, 30, 2)] + [None])
    for size in (1, 10, 1000):
        assert [t for p in parts_of(texts, size) for t in p.to_pylist()] == texts.to_pylist()
        assert [t for p in parts_of(texts.slice(2), size) for t in p.to_pylist()] == texts.to_pylist()[2:]
    assert list(parts_of(texts.slice(0, 0))) == []


def test_words_are_cut_as_bytes_are():
    texts = _texts()
    words, at = flat_lists(word_lists(pa.array(texts, pa.string())))
    words = words.to_pylist()
    assert [words[a:b] for a, b in zip(at, at[1:], strict=False)] == [(t or "").encode().lower().split() for t in texts]


def test_word_counts_are_handed_on_in_bounded_parts():
    counts, out = WordCounts(4), {}
    for words in (["a", "b", "c"], ["a", "d"], ["e", "f", "g"], ["a"], []):
        counts.add(pa.array([w.encode() for w in words], pa.binary()), pa.array([2] * len(words), pa.int64()))
        for b in counts.drain() if counts.full() else []:
            for w, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                out[w] = out.get(w, 0) + n
        assert counts._rows < 8
    for b in counts.drain():
        for w, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
            out[w] = out.get(w, 0) + n
    assert out == {b"a": 6, **dict.fromkeys([b"b", b"c", b"d", b"e", b"f", b"g"], 2)}


def test_words_merged_together_are_merged_as_alone():
    tokens = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    ids, table, rnd = {t: i for i, t in enumerate(tokens)}, bpe.RankMap(tokens).arrays(), random.Random(4)
    words = [b"", b"x", *(b"a" * n for n in range(2, 60)), *(b"ab" * n + b"a" for n in range(20))]
    words += [bytes(rnd.choices(b"aehinorst \xc3\xa9", k=rnd.randint(1, 40))) for _ in range(3000)]
    assert bpe.merge_words(words, table, 500) == [np.array(bpe.merge_bytes(w, ids), "<i4").tobytes() for w in words]
    assert bpe.merge_words([], table) == [] and bpe.merge_words([b"", b""], table) == [b"", b""]


def test_ends_stand_between_the_texts():
    x, at = brown._with_ends(np.array([1, 2, 3]), np.array([0, 2, 2, 3]), 9)
    assert x.tolist() == [1, 2, 9, 9, 3, 9] and at.tolist() == [0, 3, 4, 6]


def test_pairs_of_several_packs_are_estimated_at_one_call(monkeypatch):
    calls, likely = [], setsketch.likely
    monkeypatch.setattr(setsketch, "likely", lambda *a: calls.append(len(a[0])) or likely(*a))
    regs = setsketch.registers(np.random.default_rng(1).integers(0, 1 << 63, 40, np.uint64))
    pack = {"nodes": [1, 2], "ns": [40, 40], "parts": [1, 2], "sizes": [720, 720], "data": regs.tobytes() * 2, "no": 0}
    row = {"key": 0, **{f"{side}_{k}": v for side in "ab" for k, v in pack.items()}}
    found = [tuple(p.values()) for b in setsketch._close_in_packs(Limit(80, 100))(iter([pa.RecordBatch.from_pylist([row] * 50)])) for p in b.to_pylist()]
    assert found == [(1, 2)] * 50 and calls == [50]


def test_contents_of_blocks_are_moved_once(spark, monkeypatch):
    plans, stored = {}, exact_dedup.stored
    monkeypatch.setattr(exact_dedup, "stored", lambda df, name: plans.update({name: df._jdf.queryExecution().optimizedPlan().toString()}) or stored(df, name))
    docs = spark.createDataFrame([(1, "a b"), (2, "a  b"), (3, "c")], "doc_id long, text string")
    got = exact_dedup.exact_dedup(docs, hash_bits=1).select("doc_id", "keep_id", "kept").collect()
    assert sorted(map(tuple, got)) == [(1, 1, True), (2, 1, False), (3, 3, True)]
    numbering = plans["block-names"].split("Aggregate")[0]
    assert "RepartitionByExpression" in numbering and "block" not in numbering
