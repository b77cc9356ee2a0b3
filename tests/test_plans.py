"""Physical-plan shape of the registered queries."""

import pytest

import __spark_entry__ as entry
from conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_pair_producing_joins(spark, name):
    df = entry.queries()[name](spark, SF001)
    plan = _plan(df)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_knn_ranks_with_partial_window_group_limit(spark):
    from ragloom.operators.retrieval import knn_topk
    from ragloom.plans import derived
    df = knn_topk(derived.vec_queries(spark, SF001), derived.vec_corpus(spark, SF001))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "MapInPandas" in plan


def test_scan_is_pruned(spark):
    df = entry.queries()["prompt_summary"](spark, SF001)
    text = df._jdf.queryExecution().executedPlan().toString()
    # documents is read for doc_id and n_chars only, never its text
    assert "ReadSchema: struct<doc_id:bigint,n_chars:bigint>" in text


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert df.columns == ["model_name", "retrieval", "generation", "ragas", "rqi", "grade", "justification"]


def test_every_sql_query_is_registered():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _subtree(lines, i):
    """Lines of the plan subtree rooted at line i (deeper indentation)."""
    def depth(line):
        return len(line) - len(line.lstrip(" :+-"))
    d = depth(lines[i])
    out = []
    for line in lines[i + 1:]:
        if line.strip() and depth(line) <= d:
            break
        out.append(line)
    return out


@pytest.mark.parametrize("name", ["window_chunks", "chunk_ids", "page_docs", "recursive_chunks"])
def test_unpartitioned_window_reads_only_block_totals(spark, name):
    df = entry.queries()[name](spark, SF001)
    lines = _plan(df).splitlines()
    singles = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    for i in singles:
        sub = "\n".join(_subtree(lines, i))
        assert "HashAggregate" in sub            # block totals, not rows
        assert "text" not in sub.split("HashAggregate")[0]   # no row with its text reaches it


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_single_partition_exchanges_carry_only_aggregates(spark, name):
    """No registered plan sends rows to one task: every single-partition
    exchange sits directly on an aggregate (partial results of a global
    mean / count, one row per task, or the numbering's top-level block
    totals)."""
    df = entry.queries()[name](spark, SF001)
    lines = _plan(df).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            child = next(x for x in lines[i + 1:] if x.strip())
            assert "HashAggregate" in child, (name, line, child)


def test_knn_block_query_takes_the_index_path(spark, monkeypatch):
    """Both sides beyond the bound: blocks of the corpus are visited, and
    neither side is broadcast whole or replicated."""
    from ragloom.operators import retrieval
    asked = []
    real = retrieval.search_index
    monkeypatch.setattr(retrieval, "search_index", lambda q, i, *a, **k: asked.append(i.n_blocks) or real(q, i, *a, **k))
    df = entry.queries()["knn_block"](spark, SF001)
    assert len(asked) == 1 and asked[0] > 1
    assert "CoGroup" not in _plan(df)


def test_retrieval_recall_searches_for_the_cases_alone(spark, monkeypatch):
    from ragloom.operators import retrieval
    from ragloom.plans import derived
    asked = []
    real = retrieval.knn_search
    monkeypatch.setattr(retrieval, "knn_search", lambda q, *a, **k: asked.append(q.count()) or real(q, *a, **k))
    entry.queries()["retrieval_recall"](spark, SF001)
    n = derived.keyword_cases(spark, SF001).where("length(query) > 0").count()
    assert asked == [n] and n < derived.vec_queries(spark, SF001).count()


def test_table_counts_read_no_text(spark):
    import re
    plan = _plan(entry.queries()["table_counts"](spark, SF001))
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert read and all("text:" not in r for r in read if "conv_id" not in r)
    assert any("n_chars" in r for r in read)


def test_keywords_shuffle_words_alone(spark):
    """The document frequency is the one shuffle over the chunks' words."""
    from ragloom.operators import synth
    from ragloom.plans import queries
    ch = queries._window_chunks(spark, SF001).select("chunk_id", "text")
    plan = _plan(synth.tfidf_keywords(ch))
    assert "MapInArrow" in plan and "Exchange" not in plan and "Window" not in plan
