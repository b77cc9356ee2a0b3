"""Fill-in-the-middle transformation with pyarrow.compute (operator 12).

Two cuts divide a document's n units into prefix, middle and suffix.  A batch
of texts becomes one list array of units: the units are flattened with the
index of the list that each comes from, the ordinal inside its list says in
which of the three roles a unit is, and for every role the units are filtered,
the lists rebuilt and ``binary_join`` makes the pieces.  The units are views of
the text's own bytes (code points: every byte that begins one; words: every
word with the white space before it), so nothing is split by value.

A text goes through that in stretches of at most ``STRETCH`` bytes, whose
ordinals go on from one to the next, and a batch holds ``STRETCH`` bytes or
one stretch; memory does not grow with a document's length beyond its text.

The cuts, the form and which documents stay plain come from the hash of a seed
and the doc_id alone, so any task that runs again writes the same.  ``restore``
rebuilds the text from an output and its form: a text that holds a marker stays
plain, so the three markers of an output are its only ones.

Defined results: a null text is empty; an empty text is plain; rows that
repeat a doc_id are rows of their own, cut at the same places if equal; a null
doc_id hashes as the word ``null``; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = MARKERS = ("<P>", "<S>", "<M>")  # fixed values
STRETCH = 1 << 20
UNITS = ("chars", "words")
CUT = "doc_id long, n long, form string, prefix_units long, middle_units long, output string"


def _starts(data: np.ndarray, units: str) -> np.ndarray:
    """Bytes of UTF-8 text at which a unit begins."""
    if units == "chars":
        return np.flatnonzero((data & 0xC0) != 0x80)
    blank = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    ends_word = np.r_[False, blank[1:] & ~blank[:-1]] if len(data) else blank
    if len(data):
        ends_word[0] = True  # the first unit has the white space before it
        if blank.all():
            ends_word[1:] = False
        else:
            last = len(blank) - 1 - int(np.argmax(~blank[::-1]))
            ends_word[last + 1:] = False  # white space at the end belongs to the last word
    return np.flatnonzero(ends_word)


def _bytes_of(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string array without nulls."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return offsets - offsets[0], data[offsets[0]:offsets[-1]]


def unit_lists(texts: pa.StringArray, units: str) -> pa.ListArray:
    """The units of every text, as views of its bytes."""
    offsets, data = _bytes_of(texts)
    if units == "chars":
        starts = _starts(data, units)
        lists = np.searchsorted(starts, offsets)
    else:
        per = [_starts(data[a:b], units) + a for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        starts = np.concatenate(per) if per else np.empty(0, np.int64)
        lists = np.r_[0, np.cumsum([len(p) for p in per])]
    cuts = np.r_[starts, len(data)].astype(np.int32)
    flat = pa.StringArray.from_buffers(len(starts), pa.py_buffer(cuts), pa.py_buffer(data))
    return pa.ListArray.from_arrays(pa.array(lists, pa.int32()), flat)


def roles(texts: pa.StringArray, units: str, before: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[pa.Array]:
    """The prefix, middle and suffix pieces of every text: units whose ordinal
    (``before`` the text's first) lies below ``low``, below ``high``, beyond."""
    lists = unit_lists(texts, units)
    parent = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(lists)
    first = lists.offsets.to_numpy()[:-1]
    ordinal = np.arange(len(flat)) - first[parent] + before[parent]
    role = (ordinal >= low[parent]).astype(np.int8) + (ordinal >= high[parent])
    pieces = []
    for r in range(3):
        mine = role == r
        kept = flat.filter(pa.array(mine))
        counts = np.bincount(parent[mine], minlength=len(texts))
        rebuilt = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), kept)
        pieces.append(pc.binary_join(rebuilt, ""))
    return pieces


def _count_units(texts: pa.StringArray, units: str) -> np.ndarray:
    if units == "chars":
        return pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    offsets, data = _bytes_of(texts)
    return np.array([len(_starts(data[a:b], units)) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], np.int64)


def _stretches(texts: pa.StringArray, units: str) -> Iterator[tuple[pa.StringArray, np.ndarray]]:
    """The texts in order, in stretches, with each stretch's row; a batch's
    stretches have about ``STRETCH`` bytes.  Words are never cut (a text is a
    single stretch then)."""
    offsets, data = _bytes_of(texts)
    held, rows, size = [], [], 0
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        while True:
            end = b
            if units == "chars" and b - a > STRETCH:
                end = a + STRETCH
                while data[end] & 0xC0 == 0x80:
                    end -= 1
            held.append((a, end))
            rows.append(row)
            size += end - a
            if size >= STRETCH:
                yield _strings(data, held), np.array(rows)
                held, rows, size = [], [], 0
            a = end
            if a >= b:
                break
    if held:
        yield _strings(data, held), np.array(rows)


def _strings(data: np.ndarray, spans: list[tuple[int, int]]) -> pa.StringArray:
    """Adjacent spans of ``data`` as strings."""
    low = spans[0][0]
    cuts = np.array([low, *(e for _, e in spans)], np.int64) - low
    return pa.StringArray.from_buffers(len(spans), pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data[low:spans[-1][1]]))


def _pieces(texts: pa.StringArray, units: str, low: np.ndarray, high: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix of every text of a batch."""
    parts: list[list] = [[], [], []]
    owner: list[np.ndarray] = []
    seen = np.zeros(len(texts) + 1, np.int64)  # units of a row in the stretches so far
    for stretch, rows in _stretches(texts, units):
        n = _count_units(stretch, units)
        sums = np.cumsum(n) - n
        first = np.searchsorted(rows, rows)  # the row's first stretch here
        before = sums - sums[first] + seen[rows]
        for r, piece in enumerate(roles(stretch, units, before, low[rows], high[rows])):
            parts[r].append(piece)
        owner.append(rows)
        np.add.at(seen, rows, n)
    counts = np.bincount(np.concatenate(owner), minlength=len(texts)) if owner else np.zeros(len(texts), np.int64)
    lists = pa.array(np.r_[0, np.cumsum(counts)], pa.int32())
    return [pc.binary_join(pa.ListArray.from_arrays(lists, pa.concat_arrays(p)), "") if p else pa.array([], pa.string()) for p in parts]


def _concat(*columns) -> pa.Array:
    return pc.binary_join_element_wise(*columns, "")


def _transform(units: str, plain_share: int, spm_share: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.string())
            n = _count_units(texts, units)
            h = [batch.column(f"h{i}").to_numpy() for i in range(1, 5)]
            a, b = h[0] % (n + 1), h[1] % (n + 1)
            low, high = np.minimum(a, b), np.maximum(a, b)
            marked = np.zeros(len(texts), bool)
            for m in MARKERS:
                marked |= pc.match_substring(texts, m).to_numpy(zero_copy_only=False)
            plain = marked | (pc.binary_length(texts).to_numpy(zero_copy_only=False) == 0) | (h[2] % 100 >= 100 - plain_share)
            spm = ~plain & (h[3] % 100 < spm_share)
            prefix, middle, suffix = _pieces(texts, units, low, high)
            output = pc.case_when(pa.StructArray.from_arrays([pa.array(plain), pa.array(spm)], ["plain", "spm"]), texts,
                                  _concat(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle),
                                  _concat(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
            form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                 pa.array(low, pa.int64(), mask=plain), pa.array(high - low, pa.int64(), mask=plain), output],
                ["doc_id", "n", "form", "prefix_units", "middle_units", "output"])
    return run


def fill_in_middle(docs: DataFrame, units: str = "chars", plain_share: int = 10, spm_share: int = 20, seed: int = 1) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n (units), form
    (plain, psm or spm), prefix_units, middle_units (null if plain), output.

    ``plain_share`` of a hundred documents stay plain, ``spm_share`` of a
    hundred of the others have the suffix first.
    """
    if units not in UNITS:
        raise ValueError(f"units must be one of {UNITS}")
    name = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("null"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), name), 256)
    hashes = [F.conv(F.substring("digest", 8 * i - 7, 8), 16, 10).cast("long").alias(f"h{i}") for i in range(1, 5)]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), digest.alias("digest"))
    return rows.select("doc_id", "text", *hashes).mapInArrow(_transform(units, plain_share, spm_share), CUT)


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        output, form = batch.column("output").cast(pa.string()), batch.column("form")
        plain = pc.equal(form, "plain")
        # a plain text may hold markers of its own, and is not looked at
        parts = pc.split_pattern_regex(pc.if_else(plain, PREFIX + SUFFIX + MIDDLE, output), "<[PSM]>")
        first, second, middle = (pc.list_element(parts, i) for i in (1, 2, 3))
        spm = pc.equal(form, "spm")
        text = pc.if_else(plain, output, _concat(pc.if_else(spm, second, first), middle, pc.if_else(spm, first, second)))
        yield pa.RecordBatch.from_arrays([*batch.columns, text], [*batch.schema.names, "text"])


def restore(cut: DataFrame) -> DataFrame:
    """``cut`` (at least form and output) with the text that each output was
    made of."""
    return cut.mapInArrow(_restored, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in cut.schema.fields)}, text string")
