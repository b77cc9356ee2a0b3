"""Invariants of the chunkers and of the hierarchical running numbers."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001
from ragloom.operators import chunking
from ragloom.operators.chunking import split_recursive
from ragloom.operators.numbering import ordered_offsets

TEXT = st.text(alphabet=st.sampled_from(list("ab cd\n\n\n  xyz")), min_size=0, max_size=3000)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(min_value=20, max_value=300), st.integers(min_value=0, max_value=19))
def test_recursive_split_invariants(text, size, overlap):
    chunks = split_recursive(text, size, overlap)
    for c in chunks:
        assert 0 < len(c) <= size
        assert c == c.strip()
        assert c in text
    # nothing but whitespace is lost (chunks overlap, so they hold at least as much)
    assert len("".join("".join(chunks).split())) >= len("".join(text.split()))
    kept = set("".join(chunks).replace(" ", "").replace("\n", ""))
    assert kept == set(text.replace(" ", "").replace("\n", ""))


def test_recursive_split_known_cases():
    assert split_recursive("") == []
    assert split_recursive("   \n\n ") == []
    assert split_recursive("short text") == ["short text"]
    para = "a" * 600 + "\n\n" + "b" * 600
    assert split_recursive(para, 1000, 200) == ["a" * 600, "b" * 600]
    words = " ".join(["word"] * 500)            # 2499 characters
    out = split_recursive(words, 1000, 200)
    assert all(len(c) <= 1000 for c in out) and len(out) == 3
    assert out[1].startswith("word") and out[0][-200:].strip() in out[1]
    assert [len(c) for c in split_recursive("x" * 2500, 1000, 200)] == [1000, 1000, 900]


def test_window_chunks_cover_page(spark):
    docs = spark.createDataFrame([(0, "s/a.pdf", "x" * 2601), (1, "s/a.pdf", "y" * 1000), (2, None, ""), (3, "b", "z")],
                                 "doc_id long, source string, text string")
    rows = chunking.window_chunks(docs).orderBy("chunk_no").collect()
    assert [(r["source"], r["page"], r["pos"], r["start"], len(r["text"])) for r in rows] == [
        ("a.pdf", 0, 0, 0, 1000), ("a.pdf", 0, 1, 800, 1000), ("a.pdf", 0, 2, 1600, 1000),
        ("a.pdf", 0, 3, 2400, 201), ("a.pdf", 1, 0, 0, 1000), ("b", 0, 0, 0, 1)]
    assert [r["chunk_id"] for r in rows] == [f"chunk_{i}" for i in range(6)]


@pytest.fixture
def partitions(spark):
    """Set the number of shuffle partitions, without coalescing them."""
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    old = {k: spark.conf.get(k) for k in keys}

    def set_to(n):
        spark.conf.set(keys[0], str(n))
        spark.conf.set(keys[1], "false")
    yield set_to
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_ordered_offsets_equal_row_number(spark, parts, partitions):
    partitions(parts)
    rnd = random.Random(7)
    rows = [(f"s{rnd.randint(0, 3)}", i * 3 + rnd.randint(0, 2), rnd.randint(0, 5)) for i in range(300)]
    df = spark.createDataFrame(rows, "source string, num long, w long")
    out = ordered_offsets(df, by=["source"], num="num",
                          weights={"page": F.lit(1), "base": F.col("w")}, reset_by={"page": ["source"]})
    ref = (df.withColumn("page_ref", F.row_number().over(Window.partitionBy("source").orderBy("num")) - 1)
           .withColumn("base_ref", F.coalesce(F.sum("w").over(
               Window.orderBy("source", "num").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    got = {(r["source"], r["num"]): (r["page"], r["base"]) for r in out.collect()}
    exp = {(r["source"], r["num"]): (r["page_ref"], r["base_ref"]) for r in ref.collect()}
    assert got == exp


def test_recursive_chunks_ids_dense(spark):
    from ragloom.plans import derived
    ch = chunking.recursive_chunks(derived.page_docs(spark, SF001))
    rows = ch.select("chunk_no", "source", "page", "pos", F.length("text").alias("n")).collect()
    nos = sorted(r["chunk_no"] for r in rows)
    assert nos == list(range(len(rows)))
    assert max(r["n"] for r in rows) <= 1000
    order = sorted(rows, key=lambda r: (r["source"], r["page"], r["pos"]))
    assert [r["chunk_no"] for r in order] == list(range(len(rows)))


@pytest.mark.parametrize("parts", [1, 8])
def test_ordered_offsets_with_secondary_order(spark, parts, partitions):
    partitions(parts)
    rows = [(s, p, pos) for s in ("a", "b") for p in range(7) for pos in range((p * 3) % 4 + 1)]
    df = spark.createDataFrame(rows, "source string, page long, pos long")
    out = ordered_offsets(df, by=["source"], num="page", then=["pos"], weights={"no": F.lit(1)})
    got = sorted((r["source"], r["page"], r["pos"], r["no"]) for r in out.collect())
    assert [g[3] for g in got] == list(range(len(rows)))


def test_window_chunks_refuse_a_wrong_stored_length(spark):
    """The chunk counts come from the stored n_chars; a row whose stored
    length differs from its text fails the job, whether or not the chunk
    text is part of the output."""
    docs = spark.createDataFrame([(1, "a" * 2500, "s/x", 2500), (2, "b" * 900, "s/x", 901)],
                                 "doc_id long, text string, source string, n_chars long")
    with pytest.raises(Exception, match="differs from length"):
        chunking.window_chunks(docs).collect()
    with pytest.raises(Exception, match="differs from length"):
        chunking.window_chunks(docs).select("chunk_id").collect()
    ok = chunking.window_chunks(docs.where(F.col("doc_id") == 1)).select("chunk_id", "start").collect()
    assert sorted(r["start"] for r in ok) == [0, 800, 1600]


def _doc_pages(docs):
    return chunking.document_pages(docs)


def test_recursive_chunks_count_pages_in_the_chunk_pass(spark):
    """Numbering pages inside the chunk pass gives the same rows as numbering
    the page table first -- also with documents that yield no chunk (they
    still count as pages) at the start, middle and end of a source."""
    docs = spark.createDataFrame(
        [(1, "", "a/s1"), (2, "x " * 900, "a/s1"), (3, None, "a/s1"), (4, "y\\n\\n" * 400, "a/s1"),
         (5, "   ", "a/s1"), (6, "z" * 2100, "b/s2"), (7, "", "b/s2"), (8, "w w", "b/s2")],
        "doc_id long, text string, source string")
    cols = ["doc_id", "source", "page", "pos", "chunk_no", "chunk_id", "text"]
    old = sorted(tuple(r) for r in chunking.recursive_chunks(chunking.page_docs(docs)).select(cols).collect())
    new = sorted(tuple(r) for r in chunking.recursive_chunks(_doc_pages(docs)).select(cols).collect())
    assert new == old and len(new) > 0
    assert {(r[0], r[2]) for r in new} >= {(2, 1), (4, 3), (6, 0), (8, 2)}


def test_recursive_chunks_both_paths_on_the_tables(spark):
    from ragloom.plans import derived
    docs = derived.documents(spark, SF001)
    cols = ["doc_id", "source", "page", "pos", "chunk_no", "chunk_id"]
    old = chunking.recursive_chunks(chunking.page_docs(docs)).select(*cols, F.md5("text").alias("h"))
    new = chunking.recursive_chunks(_doc_pages(docs)).select(*cols, F.md5("text").alias("h"))
    assert old.exceptAll(new).count() == 0 and new.exceptAll(old).count() == 0
    assert new.count() == old.count()


def _numbers(df, by, num):
    out = ordered_offsets(df, by=by, num=num, weights={"page": F.lit(1), "base": F.col("w")}, reset_by={"page": by})
    return out, sorted((tuple(r[c] for c in (*by, num)), r["page"], r["base"]) for r in out.collect())


def _expected(rows):
    out, base, page, last = [], 0, 0, object()
    for source, num, w in sorted(rows):
        page = page + 1 if source == last else 0
        out.append(((source, num), page, base))
        base, last = base + w, source
    return out


def test_numbers_of_100000_one_page_sources(spark):
    """No task sees more than its share of the keys: nothing is windowed."""
    df = spark.range(100_000).select(F.format_string("s%06d", "id").alias("source"), F.xxhash64("id").alias("num"), (F.col("id") % 3).alias("w"))
    out, got = _numbers(df, ["source"], "num")
    assert got == _expected([(r["source"], r["num"], r["w"]) for r in df.collect()])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_numbers_of_hashed_ids_with_a_hot_source(spark, partitions):
    partitions(12)
    df = spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("source"),
                                  F.xxhash64("id").alias("num"), (F.col("id") % 5).alias("w"))
    out, got = _numbers(df, ["source"], "num")
    assert got == _expected([(r["source"], r["num"], r["w"]) for r in df.collect()])
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_numbers_of_repeated_and_null_keys(spark, partitions):
    partitions(5)
    rows = [("a", 1, 2, "x"), ("a", 1, 2, "y"), ("a", 1, 5, "z"), ("a", None, 1, "n"), ("b", 0, 3, "b"), (None, 7, 4, "q"), (None, 7, 4, "r")]
    df = spark.createDataFrame(rows, "source string, num long, w long, tag string")
    out = ordered_offsets(df, by=["source"], num="num", weights={"page": F.lit(1), "base": F.col("w")}, reset_by={"page": ["source"]})
    got = out.orderBy("base").collect()
    assert sorted(r["tag"] for r in got) == sorted(r[3] for r in rows)
    base = 0
    for r in got:  # dense running sum over (source, num), nulls first
        assert r["base"] == base
        base += r["w"]
    assert [(r["source"], r["num"]) for r in got] == [(None, 7), (None, 7), ("a", None), ("a", 1), ("a", 1), ("a", 1), ("b", 0)]
    assert [r["page"] for r in got] == [0, 1, 0, 1, 2, 3, 0]
    assert ordered_offsets(df.where("false"), by=["source"], num="num", weights={"page": F.lit(1)}).count() == 0
