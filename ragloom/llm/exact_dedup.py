"""Exact duplicates by deterministic block naming (operator 3).

A text is cut into blocks of fixed size.  All distinct blocks are sorted and
numbered, which names them; then adjacent names are paired, the distinct pairs
sorted and numbered again, until every document has one name.  Two texts have
the same name and number of blocks exactly when they are equal: no hash
decides anything (blocks are grouped with their content; a hash only carries
the name back to the documents, and blocks that share a hash go by content).

The text is shuffled as distinct blocks only, so copies cost one row per task.
A name's join with the documents is an inner join on the name, which Spark
splits where a group of copies is large.

Defined results: a null text counts as empty; empty texts are equal; rows that
repeat a doc_id are rows of their own, of which the first in the table's order
stays; a null doc_id comes after all others; an empty table gives no rows;
other columns are ignored.  ``docs`` is read more than once and must give the
same rows in the same partitions each time, as a table scan does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import numbered, rows_of, stored

BLOCK_BYTES = 8192
SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _blocks(text: Column, block_bytes: int) -> Column:
    """The text's bytes in blocks of ``block_bytes``; none for an empty text."""
    data = text.cast("binary")
    count = F.ceil(F.octet_length(data) / block_bytes).cast("int")
    cut = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(data, i * block_bytes + 1, F.lit(block_bytes)))
    return F.when(count > 0, cut).otherwise(F.array().cast("array<binary>"))


def _numbered(distinct: DataFrame, order: list[str]) -> DataFrame:
    """Distinct rows in sorted order with an integer name each."""
    return (distinct.repartitionByRange(*order)
            .sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id()))


def _block_names(rows: DataFrame, block_bytes: int, hash_bits: int, texts: DataFrame) -> DataFrame:
    """(uid, n_blocks, pos, name) of every block."""
    contents = texts.select("uid", F.posexplode(_blocks(F.col("norm"), block_bytes)).alias("pos", "block"))
    contents = contents.withColumn("h", _hash(F.col("block"), hash_bits))
    distinct = contents.select("h", "block").distinct()
    # a row for every different content, without the content: equal hashes get consecutive numbers
    named = stored(distinct.select("h").repartitionByRange("h").sortWithinPartitions("h")
                   .select("h", F.monotonically_increasing_id().alias("name")), "block-names")
    # stored, so that the joins below have an exchange of their own on either side, which Spark can split
    per_hash = stored(named.groupBy("h").agg(F.min("name").alias("name"), F.count("*").alias("variants")), "hashes")
    placed = rows.select("uid", "n_blocks", F.posexplode("hashes").alias("pos", "h"))
    out = placed.join(per_hash, "h")
    single = out.where("variants = 1").select("uid", "n_blocks", "pos", "name")
    shared = per_hash.where("variants > 1")
    if not shared.take(1):
        return single
    # blocks of different content under one hash: told apart by the content
    variants = (distinct.join(shared, "h").groupBy("h")
                .agg(F.min("name").alias("name"), F.array_sort(F.collect_set("block")).alias("blocks"))
                .select("h", "name", F.posexplode("blocks").alias("i", "block"))
                .select("h", "block", (F.col("name") + F.col("i")).alias("name")))
    told = (contents.join(variants, ["h", "block"]).join(rows.select("uid", "n_blocks"), "uid")
            .select("uid", "n_blocks", "pos", "name"))
    return single.unionByName(told)


def _hash(block: Column, bits: int) -> Column:
    h = F.xxhash64(block)
    return h if bits >= 64 else F.pmod(h, F.lit(1 << bits))


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES, hash_bits: int = 64, uid: str | None = None) -> DataFrame:
    """One row per row of ``docs``: uid (column ``uid``, else the row's number in the scan), doc_id,
    keep_id, group_size, kept, text_sha256."""
    texts = docs.select((F.col(uid) if uid else F.monotonically_increasing_id()).alias("uid"), F.col("doc_id").cast("long").alias("doc_id"),
                        normalised(F.col("text")).alias("norm"))
    blocks = _blocks(F.col("norm"), block_bytes)
    rows = stored(texts.select(
        "uid", "doc_id", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
        F.transform(blocks, lambda b: _hash(b, hash_bits)).alias("hashes"))
        .withColumn("n_blocks", F.size("hashes")), "dedup-rows")

    level = stored(_block_names(rows, block_bytes, hash_bits, texts), "names-0")
    size = rows.agg(F.max("n_blocks")).first()[0] or 0
    named = rows.where("n_blocks = 0").select("uid", "n_blocks", F.lit(0).cast("long").alias("name"))
    done, width, depth = [named], 1, 0
    while True:
        done.append(level.where(F.col("n_blocks") <= width).select("uid", "n_blocks", "name"))
        if size <= width:
            break
        pairs = (level.where(F.col("n_blocks") > width)
                 .groupBy("uid", "n_blocks", F.expr("pos div 2").cast("int").alias("pos"))
                 .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
                      F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right")))
        names = _numbered(pairs.select("left", "right").distinct(), ["left", "right"])
        width, depth = width * 2, depth + 1
        level = stored(pairs.join(names, ["left", "right"]).select("uid", "n_blocks", "pos", "name"), f"names-{depth}")
    identity = done[0]
    for part in done[1:]:
        identity = identity.unionByName(part)

    members = rows.select("uid", "doc_id", "text_sha256").join(identity, "uid")
    groups = stored(members.groupBy("n_blocks", "name").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")).alias("first"),
        F.count("*").alias("group_size")), "groups")
    return members.join(groups, ["n_blocks", "name"]).select(
        "uid", "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("uid") == F.col("first.uid")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows, uid = numbered(docs)
    return rows_of(rows, uid, exact_dedup(rows, uid=uid, **settings).where("kept"))
