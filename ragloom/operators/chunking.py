"""Page table, chunkers and chunk ids.

* ``page_docs`` turns a document table into the page table: source basename
  (P7) and a page number per source in ``doc_id`` order, computed by the
  skew-safe hierarchical prefix sums of :mod:`ragloom.operators.numbering`.
* ``window_chunks`` (P2) is pure SQL: positions are exploded from an
  arithmetic sequence and cut with ``substring``; the number of chunks of a
  page is known from its length, so page numbers and global chunk ids come out
  of one pass over the page rows.
* ``recursive_chunks`` (P1) runs a recursive separator splitter per page inside
  ``mapInPandas`` (Arrow batches, one Python call per batch), then numbers the
  chunk rows with the same hierarchical prefix sums.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragloom.functions.text import basename_or_unknown
from ragloom.operators.numbering import ordered_offsets
from ragloom.session import cut_lineage

# Fixed values of the reference's chunker: 1000 characters per chunk, 200 of
# overlap, separators paragraph, line, space, character.
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 200
SEPARATORS = ("\n\n", "\n", " ", "")


def page_docs(documents: DataFrame, id_col: str = "doc_id", source_col: str = "source",
              text_col: str | None = "text", keep: tuple[str, ...] = ("lang",)) -> DataFrame:
    """documents -> (doc_id, source, page, text, ...): ``source`` is the file
    basename (``unknown`` when missing), ``page`` numbers the documents of a
    source from 0 in ``doc_id`` order.  With ``text_col=None`` only the keys
    and ``keep`` columns are numbered -- the numbering shuffles the rows, so
    a caller that needs only facts about the text (its length) computes them
    first and keeps the text out of the shuffle."""
    extra = [c for c in keep if c in documents.columns]
    text = [F.col(text_col).alias("text")] if text_col else []
    df = documents.select(F.col(id_col).alias("doc_id"),
                          basename_or_unknown(source_col).alias("source"),
                          *text, *extra)
    return ordered_offsets(df, by=["source"], num="doc_id",
                           weights={"page": F.lit(1)}, reset_by={"page": ["source"]})


def document_pages(documents: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                   text_col: str = "text") -> DataFrame:
    """documents -> (doc_id, source basename, text), not yet numbered: the
    input of :func:`recursive_chunks`, which numbers pages and chunks in one
    pass."""
    return documents.select(F.col(id_col).alias("doc_id"),
                            basename_or_unknown(source_col).alias("source"),
                            F.col(text_col).alias("text"))


def _window_count(length, size: int, step: int):
    """Number of windows of ``size`` with stride ``step`` covering ``length``."""
    return (F.when(length <= 0, F.lit(0))
            .when(length <= size, F.lit(1))
            .otherwise(F.lit(1) + F.floor((length - F.lit(size) + F.lit(step - 1)) / F.lit(step)))
            .cast("bigint"))


def _length_col(documents: DataFrame):
    """Text length for the chunk counts.  A stored ``n_chars`` column is used
    when the table has one, so that the offset aggregates read a narrow column
    instead of the text; it is checked against the text where the text is cut."""
    if "n_chars" in documents.columns:
        return F.coalesce(F.col("n_chars"), F.lit(0)).cast("bigint")
    return F.coalesce(F.length("text"), F.lit(0)).cast("bigint")


def window_chunk_total(documents: DataFrame, size: int = CHUNK_SIZE,
                       overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Number of window chunks of a document table (one narrow aggregate)."""
    return documents.agg(F.coalesce(F.sum(_window_count(_length_col(documents), size, size - overlap)),
                                    F.lit(0)).cast("bigint").alias("n"))


def window_chunks(documents: DataFrame, size: int = CHUNK_SIZE,
                  overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """P2 + P3: fixed windows of ``size`` characters every ``size - overlap``.

    Output: doc_id, source, page, pos, start, chunk_no, chunk_id, text.
    """
    step = size - overlap
    if step <= 0:
        raise ValueError("overlap must be smaller than size")
    df = documents.select(F.col("doc_id"), basename_or_unknown("source").alias("source"),
                          F.col("text"), _length_col(documents).alias("__len"))
    df = df.withColumn("__n", _window_count(F.col("__len"), size, step))
    # the stored length is checked against the text where the rows are read,
    # before the numbering shuffle: the checked count rides along as a number,
    # so a caller that does not output the chunk text shuffles no text, and
    # the offset branches read only the stored length
    df = df.withColumn("__n_checked", F.when(
        F.coalesce(F.length("text"), F.lit(0)) != F.col("__len"),
        F.raise_error(F.lit("documents.n_chars differs from length(text)"))).otherwise(F.col("__n")))
    df = ordered_offsets(df, by=["source"], num="doc_id",
                         weights={"page": F.lit(1), "__base": F.col("__n")},
                         reset_by={"page": ["source"]})
    out = (df.where(F.col("__n") > 0)
           .withColumn("pos", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__n_checked") - 1)))
           .withColumn("start", F.col("pos") * F.lit(step))
           .withColumn("chunk_no", F.col("__base") + F.col("pos"))
           .withColumn("chunk_id", F.concat(F.lit("chunk_"), F.col("chunk_no").cast("string")))
           .withColumn("text", F.expr(f"substring(text, start + 1, {size})")))
    return out.select("doc_id", "source", "page", "pos", "start", "chunk_no", "chunk_id", "text")


# --------------------------------------------------------------------------
# Separator splitter over break offsets (per page, inside mapInPandas)
# --------------------------------------------------------------------------

def _breaks(text: str, sep: str, start: int, end: int):
    """Offsets in ``start .. end`` at which a unit may begin: each occurrence
    of the separator, or every character; the ends included."""
    if not sep:
        return range(start, end + 1)
    found = [m.start() for m in re.compile(re.escape(sep)).finditer(text, start, end)]
    return [start, *(found[1:] if found and found[0] == start else found), end]


def _trimmed(text: str, start: int, end: int) -> tuple[int, int] | None:
    part = text[start:end]
    kept = part.strip()
    if not kept:
        return None
    low = start + len(part) - len(part.lstrip())
    return low, low + len(kept)


def _run_spans(text: str, at, first: int, last: int, size: int, overlap: int, out: list) -> None:
    """Chunks of the short units between the breaks ``at[first .. last]``."""
    begin = first
    while True:
        end = bisect_right(at, at[begin] + size, begin + 1, last + 1) - 1
        span = _trimmed(text, at[begin], at[end])
        if span:
            out.append(span)
        if end == last:
            return
        begin = bisect_left(at, max(at[end] - overlap, at[end + 1] - size), begin, end + 1)


def chunk_spans(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                separators: tuple[str, ...] = SEPARATORS) -> list[tuple[int, int]]:
    """Chunks of ``text`` as (start, end) offsets, white space trimmed.

    A stretch of text is cut at the coarsest separator that it holds.  Runs of
    units shorter than ``size`` become chunks: a chunk ends at the last break
    that keeps it within ``size``, and the next begins at the first break that
    keeps what they share within ``overlap`` and leaves room for the unit that
    follows, both found by search over the offsets.  A unit of ``size`` or more
    is a stretch of its own, cut at the next separators (as deep as there are
    separators).  No piece of text is built.
    """
    out: list[tuple[int, int]] = []

    def cut(start: int, end: int, level: int) -> None:
        while level < len(separators) and separators[level] and text.find(separators[level], start, end) < 0:
            level += 1
        if level == len(separators):  # nothing left to cut at
            out.append((start, end))
            return
        at = _breaks(text, separators[level], start, end)
        short = [b - a < size for a, b in zip(at[:-1], at[1:])] if separators[level] else None
        first = 0
        while first < len(at) - 1:
            if (short[first] if short else size > 1):
                last = next((i for i in range(first, len(short)) if not short[i]), len(short)) if short else len(at) - 1
                _run_spans(text, at, first, last, size, overlap, out)
                first = last
            else:
                cut(at[first], at[first + 1], level + 1)
                first += 1

    if text:
        cut(0, len(text), 0)
    return out


def split_recursive(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                    separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """The chunks themselves.  Lengths are in code points."""
    return [text[a:b] for a, b in chunk_spans(text or "", size, overlap, separators)]


RECURSIVE_SCHEMA = "doc_id bigint, source string, page bigint, pos bigint, start bigint, text string"


def _recursive_batches(size: int, overlap: int, numbered: bool = True):
    """Chunks of each page.  Without page numbers (``numbered=False``) the
    page column is a placeholder and a document without any chunk emits one
    marker row (pos -1, no text), so that it still counts as a page."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = {"doc_id": [], "source": [], "page": [], "pos": [], "start": [], "text": []}
            pages = pdf["page"] if numbered else [-1] * len(pdf)
            for doc_id, source, page, text in zip(pdf["doc_id"], pdf["source"], pages, pdf["text"]):
                spans = chunk_spans(text or "", size, overlap)
                if not spans and not numbered:
                    spans, first = [(0, None)], -1
                else:
                    first = 0
                for pos, (start, end) in enumerate(spans, start=first):
                    rows["doc_id"].append(doc_id)
                    rows["source"].append(source)
                    rows["page"].append(page)
                    rows["pos"].append(pos)
                    rows["start"].append(start)
                    rows["text"].append(None if end is None else text[start:end])
            yield pd.DataFrame(rows).astype({"doc_id": "int64", "page": "int64", "pos": "int64", "start": "int64"})
    return run


def recursive_chunks(pages: DataFrame, size: int = CHUNK_SIZE,
                     overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """P1 + P3 over a page table (doc_id, source, page, text), or over a
    document table (doc_id, source, text) whose page numbers -- the position
    of a document among those of its source, in ``doc_id`` order -- are
    counted here.

    Output: doc_id, source, page, pos, start (offset in the page), chunk_no,
    chunk_id, text.

    Without page numbers, both numbers come from one pass over the chunk
    rows in (source, doc_id, pos) order: the chunk id counts the chunks
    before a row, the page the documents before it (each document's first
    row, or its marker row when it has no chunk, counts one).  So the page
    text is never shuffled to number the pages; only the chunk rows are.
    """
    numbered = "page" in pages.columns
    cols = ["doc_id", "source", "page", "text"] if numbered else ["doc_id", "source", "text"]
    chunks = (pages.select(*cols)
              .mapInPandas(_recursive_batches(size, overlap, numbered), RECURSIVE_SCHEMA))
    # the numbering reads the chunks in two branches (rows and block totals);
    # materialise them once so the Python splitter runs once per page
    chunks = cut_lineage(chunks)
    if numbered:
        # blocks are cut on the page number; chunks of a page follow by position
        out = ordered_offsets(chunks, by=["source"], num="page", then=["pos"],
                              weights={"chunk_no": F.lit(1)})
    else:
        first_row = F.col("pos") <= 0
        out = ordered_offsets(chunks.drop("page"), by=["source"], num="doc_id", then=["pos"],
                              weights={"chunk_no": (F.col("pos") >= 0).cast("int"),
                                       "__docs": first_row.cast("int")},
                              reset_by={"__docs": ["source"]})
        # the documents before this row, less the row's own document once
        # its first row has passed
        out = (out.where(F.col("pos") >= 0)
               .withColumn("page", F.col("__docs") - (F.col("pos") > 0).cast("bigint")))
    return (out
            .withColumn("chunk_id", F.concat(F.lit("chunk_"), F.col("chunk_no").cast("string")))
            .select("doc_id", "source", "page", "pos", "start", "chunk_no", "chunk_id", "text"))
