"""Each operator against brute force on small tables with nulls, empty and
long texts, ties, repeated rows and extra columns."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ragloom.llm import bpe, brown, exact_dedup, jaccard_rtree, line_dedup, nn_descent, packing, token_files, toxicity, warc

SPECIAL = ["a<|endoftext|>b", "x <|endoftext|> y", "x  <|endoftext|>  y\n<|endoftext|>", "<|startoftext|> Hi<|endoftext|>", "<|endoftext"]
LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(6000))
TEXTS = [
    "", None, " ", "a b", "One two  three\tfour five six seven", "one two three four five six seven",
    LONG, LONG + " tail", LONG, "x" * 700 + "yz" * 300, "日本語 テスト\r\nзд 'll don't <|endoftext|> 123 １２ É é ΣΑΣ",
    "a ", "  ", " \n\nfoo \nbar", "a  b   c\n\n d \t e\x1cf \x85g h",
    "The quick brown fox jumps over the lazy dog and then it sleeps for a while in the sun",
    "The quick brown fox jumps over the lazy dog and then it sleeps for a while in the shade",
]
DOC = "doc_id long, text string, uid long, name string, h long, n long, part string, __uid string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4]), (None, "null id"), (None, LONG)]
    return _table(spark, rows)


def _table(spark, rows):
    """A stored table whose extra columns have the operators' own names."""
    import tempfile
    path = tempfile.mkdtemp(prefix="llm-test-") + "/t"
    spark.createDataFrame([(i, t, 7, "x", 1, 2, "p", "u") for i, t in rows], DOC).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return _table(spark, [])


def _rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def _place(i):
    return (i is None, i or 0)


def test_exact_dedup(docs, empty):
    import re
    for settings in ({}, {"block_bytes": 5, "hash_bits": 3}):
        got = exact_dedup.exact_dedup(docs, **settings).collect()
        groups = {}
        for i, t in _rows(docs):
            groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
        want = Counter((i, min(ids, key=_place), len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids)
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
        assert sum(r.kept for r in got) == len(groups)
    assert exact_dedup.exact_dedup(empty).count() == 0
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def _components(rows, k, num, den):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    part = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                old, new = part[a], part[b]
                part = [new if x == old else x for x in part]
    least = {p: min((rows[i][0] for i in range(len(rows)) if part[i] == p), key=_place) for p in set(part)}
    return Counter((rows[i][0], len(sets[i]), least[part[i]]) for i in range(len(rows)))


@pytest.mark.parametrize(("k", "num", "den"), [(4, 85, 100), (5, 80, 100)])
def test_jaccard_components(spark, docs, empty, k, num, den):
    rng = np.random.default_rng(3)
    rows = _rows(docs)
    passage = [f"p{i}" for i in range(40)]
    for g in range(12):
        words = [f"t{x}" for x in rng.integers(0, 400, int(rng.integers(6, 260)))] + passage * (g % 3)
        for _ in range(int(rng.integers(1, 9))):
            own = list(words)
            for at in rng.integers(0, len(own), int(rng.integers(0, 1 + len(own) // 40))):
                own[at] = f"e{rng.integers(0, 9999)}"
            rows.append((1000 + len(rows), " ".join(own)))
    table = _table(spark, rows)
    got = jaccard_rtree.jaccard_components(table, k, num, den).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == _components(rows, k, num, den)
    assert jaccard_rtree.jaccard_components(empty, k, num, den).count() == 0


def test_signatures_meet_for_every_linked_pair():
    rng, limit = np.random.default_rng(5), jaccard_rtree.Limit(80, 100)
    for _ in range(300):
        n = int(rng.integers(6, 400))
        base = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        a = base[rng.random(len(base)) > 0.1]
        b = np.unique(np.r_[base[rng.random(len(base)) > 0.1], rng.integers(0, 1 << 62, n // 30).astype(np.uint64)])
        common = np.sort(base[: int(rng.integers(0, len(base)))])
        inter = len(np.intersect1d(a, b))
        if len(a) and len(b) and len(np.setxor1d(a, b)) and limit.linked(inter, len(a), len(b)):
            assert set(jaccard_rtree.signatures(a, limit, common)) & set(jaccard_rtree.signatures(b, limit, common))
            assert jaccard_rtree._overlap_bound(jaccard_rtree._point(a), jaccard_rtree._point(b)) >= inter


def test_few_nodes_take_few_tasks(spark):
    x = np.random.default_rng(4).standard_normal((60, 8))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, vector array<double>")
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        graph = nn_descent.build_graph(nn_descent.nodes_of(rows, 5))
        assert 0 < len(graph.inputFiles()) <= 2 * spark.sparkContext.defaultParallelism
        assert graph.select("u").distinct().count() == 60
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert nn_descent.tasks_for(spark, 10**9) == 10**9 // nn_descent.TASK_ROWS


def test_points_are_stored_in_few_bytes_and_read_back():
    rng = np.random.default_rng(2)
    for n in (1, 300, 3000):
        point = jaccard_rtree._point(rng.integers(0, 1 << 63, n).astype(np.uint64))
        data = jaccard_rtree._stored_point(point)
        assert np.array_equal(jaccard_rtree._read_point(data), point) and len(data) == len(point) + 1  # a byte a count
    for large in (255, 256, 65535, 65536, 1 << 30):
        point = np.array([0, large] * 32, "<i4")
        assert np.array_equal(jaccard_rtree._read_point(jaccard_rtree._stored_point(point)), point)


def test_only_wanted_texts_are_moved(spark, tmp_path):
    texts = spark.range(2000).select(F.col("id").alias("uid"), F.concat(F.lit("words of text "), "id").alias("text"))
    wanted = spark.createDataFrame([(7,), (1999,), (-3,), (7,)], "uid long")
    marked = texts.mapInArrow(jaccard_rtree._marked(spark.sparkContext.broadcast(jaccard_rtree._marks(wanted))), "uid long, text string")
    found = {r.uid for r in marked.collect()}
    assert {7, 1999} <= found and len(found) < 20
    assert marked.join(wanted.distinct(), "uid").count() == 2
    none = spark.sparkContext.broadcast(jaccard_rtree._marks(wanted.limit(0)))
    assert texts.mapInArrow(jaccard_rtree._marked(none), "uid long, text string").count() == 0


def test_byte_bpe_equals_the_library(docs, empty):
    import tiktoken
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {t: i for i, t in enumerate(bpe.load_ranks(path))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for i, t in _rows(docs):
        ids = library.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    for vocabulary in (0, 1 << 16):
        got = bpe.round_trip(docs, path, public_tokenizers.PATTERN, vocabulary=vocabulary).collect()
        assert Counter(tuple(r) for r in got) == want
    assert bpe.round_trip(empty, path, public_tokenizers.PATTERN).count() == 0


def _encoded(docs, name, end):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path(name))  # a plain call: special tokens in a text are such
    return [(i, np.array([*t.encode(x or "", add_special_tokens=False).ids, end], "<u4")) for i, x in _rows(docs)]


def test_packed_words_are_found():
    words = [b"a", b"ab", bytes(range(64)), b"\xff"]
    ids = [[1], [2, 3], list(range(9)), [50_000]]
    known = bpe.Vocabulary(bpe.pack_words(pa.array(words, pa.binary()), pa.array(ids, pa.list_(pa.int32()))))
    assert [known.get(w) for w in words] == [np.array(x, np.int32).tobytes() for x in ids]
    assert known.get(b"b") is None
    assert bpe.Vocabulary(bpe.pack_words(pa.array([], pa.binary()), pa.array([], pa.list_(pa.int32())))).get(b"a") is None


def test_token_files_round_trip(docs, empty, spark):
    docs = docs.unionByName(_table(spark, [(500 + i, t) for i, t in enumerate(SPECIAL)]))
    path = public_tokenizers.path("byte_bpe_50k.json")
    for length in (2048, 7):
        got = sorted(token_files.token_files(docs, path, length=length).collect(), key=lambda r: r.start)
        assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(
            (i, len(x), zlib.crc32(x.tobytes())) for i, x in _encoded(docs, "byte_bpe_50k.json", 2))
        assert [r.start for r in got] == np.r_[0, np.cumsum([r.n_tokens for r in got])[:-1]].tolist()
        assert [(r.doc_id is not None, r.doc_id or 0) for r in got] == sorted((r.doc_id is not None, r.doc_id or 0) for r in got)
    assert token_files.token_files(empty, path).count() == 0


def test_packing(docs, empty, spark):
    docs = docs.unionByName(_table(spark, [(500 + i, t) for i, t in enumerate(SPECIAL)]))
    path = public_tokenizers.path("word_bpe_49k.json")
    got = packing.pack(docs, path, capacity=512).collect()
    want = Counter((i, p, s, len(x[s:s + 512]), zlib.crc32(x[s:s + 512].tobytes()))
                   for i, x in _encoded(docs, "word_bpe_49k.json", 1) for p, s in enumerate(range(0, len(x), 512)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        pieces.sort()
        assert pieces[0][0] == 0 and sum(n for _, n in pieces) <= 512
        assert all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:], strict=False))
    assert packing.pack(empty, path).count() == 0


def test_sweep_is_best_fit_decreasing():
    rng = np.random.default_rng(2)
    for _ in range(30):
        lengths = rng.integers(1, 101, int(rng.integers(1, 400))).tolist()
        room = []
        for n in sorted(lengths, reverse=True):
            fits = [i for i, r in enumerate(room) if r >= n]
            if fits:
                room[min(fits, key=lambda i: room[i])] -= n
            else:
                room.append(100 - n)
        found = packing.sweep(Counter(lengths), 100)
        used = {}
        for length, _, n, first, _ in found:
            for s in range(first, first + n):
                used[s] = used.get(s, 0) + length
        assert sum(n for _, _, n, _, _ in found) == len(lengths) and max(used.values()) <= 100
        assert len(used) <= len(room) + 1


def test_brown_base_score_and_counts(docs, empty):
    rows = _rows(docs)
    held = lambda i, m: i is not None and zlib.crc32(str(i).encode()) % m == 0
    training = Counter()
    for i, t in rows:
        if not held(i, 10):
            training.update([*(t or "").encode().lower().split(), None])
    total, distinct = sum(training.values()), len(training)
    want = []
    for i, t in rows:
        tokens = [*(t or "").encode().lower().split(), None]
        base = sum(math.log10((training[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in tokens)
        want.append((str(i), held(i, 10), len(tokens), sum(x in training for x in tokens), total, round(base, 5)))
    got = brown.brown_scores(docs, vocabulary=100, classes=4, rounds=2).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == sorted(want)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert brown.brown_scores(empty).count() == 0


def test_frequent_words_are_found_whatever_their_counts(spark):
    ns = [200_000] * 3 + [10 ** 12 + 1, 10 ** 12, 150_000, 5, 5, 5, 1]
    counts = spark.createDataFrame([(f"w{i}", n) for i, n in enumerate(ns)], "word string, n long")
    top = sorted(ns, reverse=True)
    for limit in range(1, 13):
        assert sorted((r.n for r in bpe.frequent(counts, limit, "word").collect()), reverse=True) == top[:limit]
        whole = [n for n in top if sum(m >= n for m in top) <= limit]
        assert sorted((r.n for r in bpe.frequent(counts, limit).collect()), reverse=True) == whole
    hot = spark.range(50).select(F.concat(F.lit("w"), "id").alias("word"), F.lit(300_000).cast("long").alias("n"))
    assert bpe.frequent(hot, 20, "word").count() == 20 and bpe.frequent(hot.limit(0), 20, "word").count() == 0


def test_best_class_is_the_best_of_all_moves():
    rng = np.random.default_rng(4)
    bigrams = rng.integers(0, 6, (9, 9)).astype(float)
    classes = np.r_[np.arange(7) % 3, 3, 4]

    def table(c):
        out = np.zeros((5, 5))
        for i in range(9):
            for j in range(9):
                out[c[i], c[j]] += bigrams[i, j]
        return out

    def likelihood(c):
        t = table(c)
        return sum(brown._xlogx(x).sum() for x in (t,)) - brown._xlogx(t.sum(0)).sum() - brown._xlogx(t.sum(1)).sum()
    for word in range(7):
        after, before = np.zeros(5), np.zeros(5)
        for other in range(9):
            if other != word:
                after[classes[other]] += bigrams[word, other]
                before[classes[other]] += bigrams[other, word]
        tried = []
        for c in range(3):
            moved = classes.copy()
            moved[word] = c
            tried.append(likelihood(moved))
        assert brown.best_class(int(classes[word]), after, before, bigrams[word, word], table(classes), 3) == int(np.argmax(tried))


def test_line_dedup(spark, docs, empty):
    a, b, c, d = ("this line is long enough to be a rare line %s" % x for x in "abcd")
    rows = [(3, "\n".join([a, "short", b, c])), (1, "\n".join([d, a, "short", b])), (2, "\n".join([a, "short", b, c])), (4, d), (5, "short"), (None, c)]
    got = {r.doc_id: (r.text, r.n_deleted) for r in line_dedup.dedup_lines(_table(spark, rows)).collect()}
    assert got == {1: (rows[1][1], 0), 2: (c, 3), 3: ("", 4), 4: ("", 1), 5: ("short", 0), None: ("", 1)}
    same = line_dedup.dedup_lines(docs)
    assert same.columns == [*docs.columns, "n_deleted"] and same.count() == docs.count()
    assert line_dedup.dedup_lines(empty).count() == 0


def _repeated_blocks(rows, least):
    """Positions of each document in a block shared with an earlier one: all pairs, all blocks."""
    order = sorted(range(len(rows)), key=lambda n: _place(rows[n][0]))
    lines = {n: [x.strip() for x in (rows[n][1] or "").split("\n")] for n in order}
    out = {n: set() for n in order}
    for at, n in enumerate(order):
        for m in order[:at]:
            a, b = lines[n], lines[m]
            for i in range(len(a)):
                for j in range(len(b)):
                    size = 0
                    while i + size < len(a) and j + size < len(b) and a[i + size] == b[j + size]:
                        size += 1
                    if sum(map(len, a[i:i + size])) >= least:
                        out[n] |= set(range(i, i + size))
    return out


def _cut_lines(spark, rows, **settings):
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(_table(spark, rows), **settings).collect()}
    return [got[i] for i, _ in rows]


def test_line_dedup_of_passages_in_another_order(spark):
    p1, p2 = ("this passage has more than forty characters, number %d" % i for i in (1, 2))
    rows = [(1, f"{p1}\n{p2}"), (2, f"{p2}\n{p1}\nnew"), (3, f"{p2}\n{p1}\nnew"), (4, "\n".join([p1, "x", p2, "y"]))]
    assert _cut_lines(spark, rows) == [rows[0][1], "new", "", "x\ny"]


def test_line_dedup_of_repeated_and_of_short_lines(spark):
    hot = "a footer that stands on every page of a document"
    rows = [(1, f"y1\n{hot}\ny2\n{hot}\ny3"), (2, f"x1\n{hot}\nx2\n{hot}\nx3\n{hot}"), (3, f"z1\n{hot}\nz2")]
    assert _cut_lines(spark, rows) == [rows[0][1], "x1\nx2\nx3", "z1\nz2"]
    short = "\n".join(["for x in table:", "    if x:", "        count += 1", "", "日本語の行です。", "return count"])
    rows = [(1, f"head\n{short}\ntail"), (2, f"other\n{short}"), (3, "for x in table:\nno")]
    assert _cut_lines(spark, rows) == [rows[0][1], "other", rows[2][1]]


def test_line_dedup_equals_all_blocks_of_all_pairs(spark):
    rng = np.random.default_rng(8)
    words = ["", " ", "a", "bc", "def", "ghij", "k" * 6]
    rows = [(i, "\n".join(words[x] for x in rng.integers(0, len(words), rng.integers(1, 14)))) for i in range(40)]
    want = _repeated_blocks(rows, 8)
    assert any(want.values())
    lines = {n: rows[n][1].split("\n") for n in want}
    left = [rows[n][1] if not want[n] else "\n".join(x for i, x in enumerate(lines[n]) if i not in want[n]) for n in range(len(rows))]
    assert _cut_lines(spark, rows, least_chars=8) == left


def _side(lines, least):
    hashes, chars = line_dedup.line_hashes("\n".join(lines))
    return line_dedup.Side(hashes, chars.tobytes(), least)


def test_aligned_pairs_equal_all_blocks():
    rng = np.random.default_rng(1)
    words = ["", " ", "a", "bc", "def", "ghij", "k" * 6]
    for n in range(500):
        a, b = ([words[x] for x in rng.integers(0, len(words), rng.integers(1, 25))] for _ in range(2))
        if n % 2:  # passages in another order, and twice
            b = b[len(b) // 2:] + a[len(a) // 2:] + b[:len(b) // 2] + a[:len(a) // 2] + a[-3:]
        least = int(rng.integers(1, 14))
        got = {i for s, e in line_dedup.aligned(_side(a, least), _side(b, least)) for i in range(s, e)}
        assert got == _repeated_blocks([(1, "\n".join(b)), (2, "\n".join(a))], least)[1]


def test_alignment_of_long_documents():
    a = [f"line {i} of a very long document, in which every line is long enough" for i in range(20_000)]
    assert line_dedup.aligned(_side(a, 40), _side(a[::-1], 40)) == [(0, len(a))]
    assert line_dedup.aligned(_side(["x" * 50] * 20_000, 40), _side(["y", "x" * 50, "z"], 40)) == [(0, 20_000)]
    assert line_dedup.aligned(_side(["w" * 20, *[""] * 50_000, "v" * 20], 40), _side(["v" * 20, *[""] * 50_000, "w" * 20], 40)) == []


def test_patience_matches_are_ordered_and_equal():
    rng = np.random.default_rng(6)
    for _ in range(200):
        a, b = rng.integers(0, 12, 15).tolist(), rng.integers(0, 12, 15).tolist()
        found = line_dedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in found)
        assert all(i < k and j < m for (i, j), (k, m) in zip(found, found[1:], strict=False))
    assert line_dedup.patience([1, 2, 3], [1, 2, 3]) == [(0, 0), (1, 1), (2, 2)]


def test_warc_round_trip(spark):
    big, other = "<p>é</p>" * 300, "<b>x</b>" * 300
    rows = [(1, "http://a/ b", big), (2, None, big), (9, "u", big), (3, "u", "small"), (4, "u", "small"), (5, "u", None),
            (6, "u", ""), (None, "u", other), (7, "u", other), (7, "u", other), (8, "u", "y" * 1000), (10, "u", "y" * 999), (11, "u", "y" * 999)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, shard string")
    for sizes in ({}, {"roll_bytes": 300, "shard_bytes": 1000}):
        got = Counter(tuple(r) for r in warc.archives(pages, **sizes).collect())
        want = Counter()
        for i, _, html in rows:
            data = (html or "").encode()
            same = [r[0] for r in rows if (r[2] or "").encode() == data and r[0] is not None]
            revisit = len(data) >= 1000 and same and i != max(same)
            want[i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", max(same) if revisit else None] += 1
        assert got == want
    assert warc.archives(pages.limit(0)).count() == 0


def test_warc_files_do_not_depend_on_the_layout(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"page {i} " * (i % 50)) for i in range(400)], "page_id long, url string, html string")
    seen = []
    for n in (1, 5):
        folder = f"file://{tmp_path}/{n}"
        warc.write_archives(pages.repartition(n), folder, shard_bytes=20_000, roll_bytes=2_000)
        seen.append(sorted((r.file, r.records, r.sha1) for r in spark.read.parquet(f"{folder}/manifest").collect()))
    assert seen[0] == seen[1] and len(seen[0]) > 3


def test_warc_shards_are_even_whatever_the_ids(spark):
    ids = [*range(200), 10 ** 12, 2 ** 63 - 1, -2 ** 63, *[77] * 60, *[None] * 60]
    pages = spark.createDataFrame([(x, "u", f"{i} " + "y" * 500) for i, x in enumerate(ids)], "page_id long, url string, html string")
    shard, n = warc._shards(pages, 10_000, 1)
    rows = warc.marked_pages(pages).select(shard.alias("shard"), "page_id").collect()
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) <= set(range(n)) and max(sizes.values()) <= 25 and len(sizes) >= 30
    single = sorted((r["shard"], r["page_id"]) for r in rows if r["page_id"] not in (None, 77))
    assert [x for _, x in single] == sorted(x for _, x in single)
    assert Counter(r["page_id"] for r in warc.archives(pages, shard_bytes=10_000).collect()) == Counter(ids)


def test_toxicity_separates_marked_documents(spark, empty):
    rng = np.random.default_rng(1)
    words = [f"{a}{b}{c}" for a in ("ba", "de", "fi", "go") for b in ("la", "me", "ni") for c in ("to", "ru", "sa", "")]
    rows, labels = [], []
    for i in range(600):
        own = rng.choice(words, int(rng.integers(20, 80))).tolist()
        bad = i % 4 == 0
        if bad:
            for at in rng.integers(0, len(own), 4):
                own[at] = str(rng.choice(["horrible", "wretched", "despicable"]))
        rows.append((i, " ".join(own)))
        labels.append((i, int(bad)))
    rows += [(600, ""), (601, None), (None, "ba"), (5, rows[5][1])]
    table = _table(spark, rows)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.toxicity(table, marks).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 600]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in held]) > 0.9
    assert {r.score for r in toxicity.toxicity(table, marks.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity(empty, marks).count() == 0


def test_nearest_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((900, 16)).astype(np.float32)
    x[200:500] = x[200]  # a third are one vector
    rows = [(i, v.tolist(), "q") for i, v in enumerate(x)]
    rows += [(900, None, "q"), (901, [0.0] * 16, "q"), (902, [float("nan")] * 16, "q"), (903, [1.0, None] * 8, "q"), (904, [1.0], "q"), (7, x[7].tolist(), "q")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node string")
    got = nn_descent.nearest(table, F.col("vec_id") % 100 == 0).collect()
    hit = total = 0
    for q in range(0, 900, 100):
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        d[q] = np.inf
        best = np.lexsort((np.arange(900), d))[:10]
        assert [r["rank"] for r in own] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        assert np.allclose([r.score for r in own], [d[r.vec_id] for r in own])
        hit, total = hit + len({*best.tolist()} & {r.vec_id for r in own}), total + 10
    assert {r.query_id for r in got} == set(range(0, 900, 100)) and hit / total >= 0.9
    assert nn_descent.nearest(table.limit(0), F.lit(True)).count() == 0
    few = spark.createDataFrame(rows[:4], table.schema)
    assert nn_descent.nearest(few, F.lit(True)).count() == 12


def test_nearest_neighbours_in_clusters_without_an_entry(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "ENTRIES", 4)  # as few among these as 1024 are in a large table
    rng = np.random.default_rng(12)
    centres = rng.standard_normal((20, 16))
    x = np.concatenate([centres[i % 20] + 1e-2 * rng.standard_normal(16) for i in range(1000)]).reshape(1000, 16).astype(np.float32)
    x[500:520] = x[:20]  # copies
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = {}
    for r in nn_descent.nearest(rows, F.col("vec_id") < 100).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(100):
        d = nn_descent.exact_distance(x[q], x)
        d[q] = np.inf
        hits += len(found[q] & set(np.lexsort((np.arange(1000), d))[:10].tolist()))
    assert hits >= 950 and all(q + 500 in found[q] for q in range(20))


def test_nn_descent_of_repeated_ids(spark):
    rng = np.random.default_rng(12)
    rows = [(int(i), rng.integers(-9, 10, 3).astype(float).tolist()) for i in rng.integers(0, 60, 150)]
    rows += [(0, [1.0, 0.0, 0.0]), (1, [2.0, 0.0, 0.0]), (1, [3.0, 0.0, 0.0]), (1, [3.0, 0.0, 0.0]), (2, [9.0, 9.0, 9.0])]
    rows = [x for x in rows if any(x[1])]
    got = nn_descent.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 10 == 0, k=5).collect()
    want = set()
    for q in {i for i, _ in rows if i % 10 == 0}:
        best = {}
        for i, x in rows:
            if i != q:
                d = min(math.dist(x, y) for j, y in rows if j == q)
                best[i] = min(d, best.get(i, d))
        want |= {(q, n + 1, i, round(d, 9)) for n, (d, i) in enumerate(sorted((d, i) for i, d in best.items())[:5])}
    assert len(got) == len(want) and {(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got} == want


@pytest.fixture
def moving_splits(spark, monkeypatch):
    """Scans are split in another way after every stored table, as when executors come and go."""
    from ragloom.llm import tables
    key, calls = "spark.sql.files.maxPartitionBytes", []
    before, write = spark.conf.get(key), tables.stored

    def moved(df, name):
        out = write(df, name)
        calls.append(name)
        spark.conf.set(key, "300b" if len(calls) % 2 else before)
        return out
    for module in (tables, line_dedup, exact_dedup, jaccard_rtree, brown):
        monkeypatch.setattr(module, "stored", moved)
    yield
    spark.conf.set(key, before)


def test_rows_keep_their_numbers_when_splits_move(spark, moving_splits):
    copy = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(i, copy if i % 2 else f"a{i} b{i} c{i} d{i} e{i} f{i} g{i} h{i}") for i in range(30)]
    table = _table(spark, rows)
    left = {0, 1, *range(2, 30, 2)}
    assert sorted(r.doc_id for r in exact_dedup.drop_copies(table).collect()) == sorted(left)
    assert sorted(r.doc_id for r in jaccard_rtree.drop_near_copies(table).collect()) == sorted(left)
    want = [t if i in left else "" for i, t in rows]
    assert _cut_lines(spark, rows) == want
    got = {r.doc_id: r.n_tokens for r in brown.brown_scores(table, vocabulary=5, classes=2, rounds=1).collect()}
    assert got == {i: len(t.split()) + 1 for i, t in rows}


def test_pipeline_stages(spark):
    import corpus_pipeline
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns, name
        kept = spark.createDataFrame(kept.collect(), docs.schema).repartition(2)
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        ids = {r.doc_id for r in kept.collect()}
        if name == "exact_dedup":
            import re
            first = {}
            for i, t in sorted(rows):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), i)
            assert ids == set(first.values())
        if name == "near_dedup":
            assert ids == {c for _, _, c in _components(rows, 5, 80, 100)}
        path = f"{spark.conf.get('spark.checkpoint.dir')}/test-{name}"
        kept.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).select("doc_id").distinct().count() == docs.count()
