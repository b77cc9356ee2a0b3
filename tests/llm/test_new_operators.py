"""Operators 11 to 13 against brute force on small tables with nulls, empty
and long texts, ties, repeated rows and extra columns."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ragloom.llm import fill_middle, hard_negatives, jaccard_rtree, set_blocks, setsketch
from ragloom.llm.jaccard_rtree import Limit, shingle_set
from test_llm import TEXTS, _components, _place, _rows, _table, docs, empty  # noqa: F401


# ---------------------------------------------------- 11: hard negatives ----

VECTORS = ("vec_id long, label int, embedding array<double>, block long, score long, w int, pack string, curve string, anchor string, "
           "ids array<int>, rank int")


def _vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "p", "c", "a", [1], 4) for r in rows], VECTORS)


def _mined(rows, is_anchor):
    ok = [(i, lab, [int(np.floor(x * 256)) for x in v]) for i, lab, v in rows
          if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = Counter()
    for n, (i, lab, v) in enumerate(ok):
        if not is_anchor(i):
            continue
        scored = sorted(((dot(v, w), j, other) for m, (j, other, w) in enumerate(ok) if m != n), key=lambda s: (-s[0], s[1]))
        for ps, pid, _ in [s for s in scored if s[2] == lab][:5]:
            window = [s for s in scored if s[2] != lab and 80 * ps <= 100 * s[0] <= 100 * ps][:5]
            for rank, (ns, nid, _) in enumerate(window, 1):
                out[i, pid, rank, nid, ps, ns] += 1
    return out


@pytest.mark.parametrize("dims", [3, 20])
def test_hard_negatives(spark, dims, monkeypatch):
    rng = np.random.default_rng(dims)
    for name, value in (("BLOCK", 7), ("PACK", 4), ("ZONES", 5), ("SEEDS", 1)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = [(int(i), int(i % 3), [float(x) for x in rng.normal(size=dims)]) for i in range(240)]
    rows += [(1000 + i, 1, rows[5][2]) for i in range(40)]  # one vector that many rows have
    rows += [(2000 + i, 2, rows[5][2]) for i in range(20)]
    rows += [rows[0], (0, 1, rows[9][2]), (20, 2, rows[0][2])]  # repeated ids, of anchors too
    rows += [(None, 1, rows[1][2]), (3000, None, rows[1][2]), (3020, 1, None), (3040, 1, [None] * dims), (3060, 0, [float("nan")] * dims),
             (3080, 0, [float("inf")] * dims), (3100, 0, []), (3120, 1, [1.0]), (3140, 9, [0.0] * dims), (3160, 5, [300.0] * dims)]
    got = hard_negatives.hard_negatives(_vectors(spark, rows), F.col("vec_id") % 20 == 0).collect()
    assert Counter(tuple(r) for r in got) == _mined(rows, lambda i: i % 20 == 0)
    assert got


def test_hard_negatives_of_empty_and_single_label_tables(spark):
    for rows in ([], [(0, 1, [1.0, 2.0])], [(0, 1, [1.0, 2.0]), (1, 1, [1.0, 2.0])], [(0, None, None)]):
        assert hard_negatives.hard_negatives(_vectors(spark, rows), F.col("vec_id") % 20 == 0).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(0, 1, [2.0**21, 1.0]), (1, 1, [2.0**21, 2.0]), (2, 2, [2.0**21, 1.5]), (3, 2, [2.0**20, 0.0]), (4, 2, [2.0**21 * 0.9, 3.0])]
    got = hard_negatives.hard_negatives(_vectors(spark, rows), F.col("vec_id") == 0).collect()
    assert Counter(tuple(r) for r in got) == _mined(rows, lambda i: i == 0)


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        side = 1 << bits
        cells = np.stack(np.meshgrid(*[np.arange(side)] * dims), axis=-1).reshape(-1, dims)
        key = hard_negatives.hilbert_key(cells, bits)
        assert sorted(key) == list(range(side**dims))
        path = cells[np.argsort(key)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_zone_bounds_enclose_every_product_and_skip_blocks():
    rng = np.random.default_rng(2)
    centres = rng.integers(-200, 200, (6, 8)) * 4
    blocks = [c + rng.integers(-9, 9, (30, 8)) for c in centres]
    anchors = np.concatenate([c + rng.integers(-9, 9, (3, 8)) for c in centres])
    low, high = np.array([b.min(axis=0) for b in blocks]), np.array([b.max(axis=0) for b in blocks])
    least, most = hard_negatives._bounds(anchors, low, high)
    for j, b in enumerate(blocks):
        score = anchors @ b.T
        assert (least[:, j] <= score.min(axis=1)).all() and (most[:, j] >= score.max(axis=1)).all()
    best = np.array([(anchors @ b.T).max(axis=1) for b in blocks]).max(axis=0)
    assert (most < best[:, None]).sum() > len(anchors)  # clustered vectors: most blocks are ruled out


# ------------------------------------------------------- 12: fill in middle ----

def _cut(doc_id, text, split, join):
    h = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    units = split(text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text, text
    p, m, s = join(units[:a]), join(units[a:b]), join(units[b:])
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return doc_id, n, form, a, b - a, out, text


def _words(text):
    import re
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", text)
    tail = text[len("".join(units)):]
    return [*units[:-1], units[-1] + tail] if units else [text] if text else []


ODD = ["a<P>b", "<S>", "<", "<M", "P>x<", "é" * 3000, "日本語のテキスト " * 400, "\U0001f600 x\U0001f601\n", "á b", "\x00\x01", "  lead and tail  "]


@pytest.mark.parametrize(("units", "split"), [("chars", list), ("words", _words)])
def test_fill_in_middle(spark, docs, empty, units, split, monkeypatch):  # noqa: F811
    monkeypatch.setattr(fill_middle, "STRETCH", 1000)  # long texts go through in many stretches
    rows = _rows(docs) + [(100 + 37 * j + i, t) for i, t in enumerate([*ODD, *TEXTS[-3:]]) for j in range(6)]
    table = _table(spark, rows)
    got = fill_middle.restore(fill_middle.fill_in_middle(table, units=units)).collect()
    want = Counter(_cut(i, t or "", split, "".join) for i, t in rows)
    assert Counter(tuple(r) for r in got) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fill_middle.restore(fill_middle.fill_in_middle(empty, units=units)).count() == 0


def test_very_long_text_in_one_batch():
    text = "añ😀" * 700_000  # 4.9 MB, several stretches
    texts = pa.array([text, "", "xyz"], pa.string())
    low, high = np.array([1_000_001, 0, 1]), np.array([1_500_000, 0, 1])
    pieces = [p.to_pylist() for p in fill_middle._pieces(texts, "chars", low, high)]
    assert pieces[0] == [text[:1_000_001], "", "x"]
    assert pieces[1] == [text[1_000_001:1_500_000], "", ""]
    assert pieces[2] == [text[1_500_000:], "", "yz"]


# ------------------------------------------------------------ 13: SetSketch ----

def _near_rows(rng):
    rows = []
    passage = [f"p{i}" for i in range(60)]
    for g in range(14):
        words = [f"t{x}" for x in rng.integers(0, 500, int(rng.integers(3, 240)))] + passage * (g % 3)
        for _ in range(int(rng.integers(1, 9))):
            own = list(words)
            for at in rng.integers(0, len(own), int(rng.integers(0, 1 + len(own) // 16))):
                own[at] = f"e{rng.integers(0, 9999)}"
            rows.append((1000 + len(rows), " ".join(own)))
    return rows


@pytest.mark.parametrize(("k", "num", "small"), [(2, 80, 48), (5, 85, 48), (2, 80, 2)])
def test_near_duplicates(spark, docs, empty, k, num, small, monkeypatch):  # noqa: F811
    monkeypatch.setattr(setsketch, "SMALL", small)  # 2: most groups are large components, cut into blocks
    if small == 2:
        monkeypatch.setattr(set_blocks, "PACK", 3)
    rows = _rows(docs) + _near_rows(np.random.default_rng(k))
    got = setsketch.near_duplicates(_table(spark, rows), k, num, 100).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == _components(rows, k, num, 100)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert setsketch.near_duplicates(empty, k, num, 100).count() == 0


def test_registers_merge_and_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(1)
    for share in (0.3, 0.6, 0.8, 0.95):
        agree = []
        for _ in range(30):
            tokens = rng.integers(0, 1 << 63, 400, np.uint64)
            both = int(400 * share)
            a, b = np.r_[tokens[:both], tokens[both::2]], np.r_[tokens[:both], tokens[both + 1::2]]
            x, y = setsketch.registers(a), setsketch.registers(b)
            assert (np.maximum(x, y) == setsketch.registers(np.r_[a, b])).all()
            agree.append((x == y).mean())
        j = both / 400
        assert abs(np.mean(agree) - j) < 0.025


def test_estimate_is_near_the_similarity_and_drops_no_linked_pair():
    rng, limit = np.random.default_rng(9), Limit(80, 100)
    regs, sizes, true, linked = [], [], [], []
    for _ in range(600):
        n = int(rng.integers(4, 500))
        base = rng.integers(0, 1 << 63, n, np.uint64)
        drop = rng.random() * 0.3
        a, b = base[rng.random(n) > drop], base[rng.random(n) > drop]
        if not len(a) or not len(b):
            continue
        inter, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        regs.append((setsketch.registers(a), setsketch.registers(b)))
        sizes.append((len(a), len(b)))
        true.append(inter / union)
        linked.append(limit.linked(inter, len(a), len(b)))
    x, y = (np.array([r[i] for r in regs]) for i in (0, 1))
    n = np.array(sizes, np.float64)
    share = n[:, 0] / n.sum(axis=1)
    ahead, behind = (x > y).sum(axis=1), (x < y).sum(axis=1)
    found = setsketch.estimate(share, ahead, behind, setsketch.REGISTERS - ahead - behind)
    assert np.sqrt(np.mean((found - np.array(true)) ** 2)) < 0.03
    kept = setsketch.likely(x, y, n[:, 0], n[:, 1], 0.8)
    assert kept[np.array(linked)].all() and not kept[np.array(true) < 0.45].any()


def test_overlaps_of_sets():
    rng = np.random.default_rng(6)
    a, b = ([np.unique(rng.integers(0, 90, int(rng.integers(0, 60))).astype(np.uint64)) for _ in range(n)] for n in (7, 11))
    want = [[len(np.intersect1d(x, y)) for y in b] for x in a]
    for columns in (5, 2048):
        assert set_blocks.overlaps(a, b, columns).tolist() == want
    assert set_blocks.overlaps([], b).shape == (0, 11)


def test_members_far_from_the_centre_are_compared_with_the_whole_group(spark, monkeypatch):
    """A chain of copies, each linked with the next alone: the centre links
    few of them, and the others must still be found."""
    monkeypatch.setattr(setsketch, "SMALL", 3)
    monkeypatch.setattr(set_blocks, "PACK", 4)
    words = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words)))
        words[(i * 7) % 100] = f"x{i}"
        words[(i * 7 + 50) % 100] = f"y{i}"
    got = setsketch.near_duplicates(_table(spark, rows), 2).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == _components(rows, 2, 80, 100)


def test_group_of_near_copies_gives_pairs_in_proportion(spark):
    """A bucket's centre meets its members: far from all pairs of a group."""
    rng = np.random.default_rng(4)
    words = [f"t{x}" for x in range(120)]
    rows = []
    for i in range(300):
        own = list(words)
        own[int(rng.integers(0, 120))] = f"e{i}"
        rows.append((i, " ".join(own)))
    table = _table(spark, rows)
    nodes = table.select(F.col("doc_id").alias("uid"), "doc_id", "text").mapInArrow(setsketch._sketches(2), setsketch.SKETCH).select(
        "digest", F.col("uid").alias("node"), "doc_id", "n", "registers")
    pairs = setsketch._stars(setsketch._buckets(nodes), Limit(80, 100))
    assert 299 <= pairs.count() <= 300 * 20
    got = setsketch.near_duplicates(table, 2).collect()
    assert {r.component_id for r in got} == {0} and sum(r.kept for r in got) == 1
    assert shingle_set("a b", 2, setsketch._cache()).size == 1 and _place(None)


# ----------------------------------------- 10: large parts of the R-tree join ----

def test_jaccard_components_through_blocks_of_large_parts(spark, docs, monkeypatch):  # noqa: F811
    monkeypatch.setattr(jaccard_rtree, "LARGE", 2)
    monkeypatch.setattr(jaccard_rtree, "LEAF", 4)
    monkeypatch.setattr(set_blocks, "PACK", 3)
    rows = _rows(docs) + _near_rows(np.random.default_rng(11))
    words = [f"w{i}" for i in range(90)]
    for i in range(30):  # a chain, each linked with its neighbours
        rows.append((5000 + i, " ".join(words)))
        words[(i * 11) % 90] = f"x{i}"
    got = jaccard_rtree.jaccard_components(_table(spark, rows), 4, 85, 100).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == _components(rows, 4, 85, 100)
