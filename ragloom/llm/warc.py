"""Deterministic sharded WARC archives (operator 5).

Writing: payload digests come from the pages; of equal payloads of at least
``REVISIT_BYTES`` bytes the one with the largest page_id is the response and
the others revisit it.  The pages are range-sorted by page_id into shards
whose bounds follow from the sorted ids and payload bytes alone, not from the
table's files or a random sample; each task writes its shard record by record,
one gzip member each, and begins a new file when the compressed size reaches
``roll_bytes``.  An id, or no id, with more bytes than a shard is dealt over
several by a hash of the payload; only equal payloads of one id stay together.
Headers are generated anew and hold nothing that changes from run to run, so
the same pages give the same files byte for byte.

Committing: files are written under temporary names of the task attempt; the
manifest, a table with file, records, bytes and digest, holds those of the
attempts that succeeded, and only these are renamed to their final names.  A
lost or repeated task leaves nothing that a reader takes for an archive.

Reading streams the manifest's files record by record and checks the length
and the digest of every block.

Defined results: null html is an empty payload, null urls are empty; a null
page_id (read back as null) sorts first and never is a group's response unless
no other id has that payload; rows that repeat page_id and payload of a
group's response are all responses; an empty table gives no file and no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import file_system, shared_folder, stored

REVISIT_BYTES = 1000
ROLL_BYTES = 64 << 20
SHARD_BYTES = 256 << 20
RANGES = 4096
MANIFEST = "shard long, part int, temporary string, file string, records long, bytes long, sha1 string"
#: Fixed values of the format: the records carry no fetch time of their own.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit without."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = refers_to is not None
    block = http if revisit else http + payload
    uri = "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url)
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
        *([("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")] if revisit else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    """A gzip member without a time stamp."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def marked_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, refers_to."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
                        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload"),
                             "strong": F.sha2("payload", 256)})
    large = F.col("payload_bytes") >= REVISIT_BYTES
    groups = stored(rows.where(large).groupBy("payload_bytes", "strong")
              .agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1").drop("n"), "copies")
    joined = rows.join(groups, ["payload_bytes", "strong"], "left")
    refers = F.when(F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response")), F.col("response"))
    return joined.select("page_id", "url", "payload", "payload_bytes", "payload_digest", refers.alias("refers_to"))


def _cells(sizes: DataFrame, step: int) -> dict[int, tuple[int, int]]:
    """Ranges of ids: first id -> (last id, bytes).  A range of more than
    ``step`` bytes is cut again until it holds one id, so sparse or uneven ids
    give even ranges.  Their number follows from the bytes, not from the rows."""
    low, high, total = sizes.where("page_id is not null").agg(F.min("page_id"), F.max("page_id"), F.sum("b")).first()
    waiting, done = [] if low is None else [(low, high, total)], {}
    while waiting:
        cells = []
        for first, last, size in waiting:
            width = last - first + 1
            parts = min(max(2 * size // step, 2), RANGES, width)
            cuts = [first + i * width // parts for i in range(parts + 1)]
            cells += [(x, y - 1) for x, y in zip(cuts, cuts[1:], strict=False)]
        starts, ends = (np.array([c[i] for c in cells], np.int64) for i in (0, 1))
        cell = F.pandas_udf(_cell_of(starts, ends), "long")
        held = sizes.where("page_id is not null").groupBy(cell("page_id").alias("cell")).agg(F.sum("b").alias("b")).where("cell >= 0").collect()  # one row per cell
        waiting = []
        for r in held:
            first, last = cells[r["cell"]]
            if r["b"] > step and last > first:
                waiting.append((first, last, r["b"]))
            else:
                done[first] = last, r["b"]
        waiting.sort()
    return done


def _cell_of(starts: np.ndarray, ends: np.ndarray):
    def run(ids: pd.Series) -> pd.Series:
        at = np.searchsorted(starts, ids.to_numpy(), side="right") - 1
        return pd.Series(np.where((at >= 0) & (ids.to_numpy() <= ends[at]), at, -1))
    return run


def _shard_of(starts: np.ndarray, base: np.ndarray, ways: np.ndarray):
    def run(ids: pd.Series, salt: pd.Series) -> pd.Series:
        at = np.maximum(np.searchsorted(starts, ids.to_numpy(), side="right") - 1, 0)
        return pd.Series(base[at] + salt.to_numpy() % ways[at])
    return run


def _shards(pages: DataFrame, shard_bytes: int, least: int) -> tuple[Column, int]:
    """The shard of a page, by page_id, and the number of shards.  An id (or
    none) with more bytes than a shard has several, told apart by payload."""
    sizes = stored(pages.select(F.col("page_id").cast("long").alias("page_id"), (F.coalesce(F.octet_length("html"), F.lit(0)) + 500).cast("long").alias("b")), "page-sizes")
    total, unnamed = sizes.agg(F.sum("b"), F.sum(F.when(F.col("page_id").isNull(), F.col("b")))).first()
    step = max(min(shard_bytes, (total or 0) // least), 1)
    n = none = -(-(unnamed or 0) // step)
    starts, base, ways, room = [], [], [], 0
    for first, (_, size) in sorted(_cells(sizes, step).items()):
        if size > room:
            starts.append(first)
            base.append(n)
            ways.append(-(-size // step))
            n, room = n + ways[-1], step
        room = 0 if size > step else room - size
    salt = F.pmod(F.xxhash64("payload"), F.lit(1 << 30))
    lookup = F.pandas_udf(_shard_of(*(np.array(x or [0], np.int64) for x in (starts, base, ways or [1]))), "long")
    named = lookup(F.coalesce("page_id", F.lit(0)), salt)
    return F.when(F.col("page_id").isNull(), salt % max(none, 1)).otherwise(named), max(n, 1)


class Roller:
    """Files of one shard, each begun when the last has reached its size."""

    def __init__(self, folder: str, shard: int, roll_bytes: int):
        self._fs, self._path = file_system(folder)
        self._fs.create_dir(self._path, recursive=True)
        self._shard, self._roll, self._attempt = shard, roll_bytes, uuid.uuid4().hex
        self._part, self._file, self.done = 0, None, []

    def add(self, data: bytes) -> None:
        if self._file is None:
            name = f"{self._attempt}-{self._part:05d}.tmp"
            self._file, self._entry = self._fs.open_output_stream(f"{self._path}/{name}"), [name, 0, 0, hashlib.sha1()]
        member = _member(data)
        self._file.write(member)
        self._entry[1] += 1
        self._entry[2] += len(member)
        self._entry[3].update(member)
        if self._entry[2] >= self._roll:
            self.close()

    def close(self) -> None:
        if self._file is not None:
            self._file.close()
            name, records, size, sha1 = self._entry
            self.done.append((self._shard, self._part, name, f"shard-{self._shard:07d}-{self._part:05d}.warc.gz", records, size, sha1.hexdigest()))
            self._part, self._file = self._part + 1, None


def _write(folder: str, roll_bytes: int):
    names = ["shard", "part", "temporary", "file", "records", "bytes", "sha1"]
    types = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, current, done = None, None, []
        for batch in batches:
            columns = [batch.column(c) for c in ("shard", "page_id", "url", "payload", "payload_digest", "refers_to")]
            for row in zip(*columns, strict=True):
                shard, page_id, url, payload, digest, refers_to = (x.as_py() for x in row)
                if shard != current:
                    if files:
                        files.close()
                        done += files.done
                    files, current = Roller(folder, shard, roll_bytes), shard
                files.add(record(page_id, url, payload, digest, refers_to))
        if files:
            files.close()
            done += files.done
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate(types)], names)
    return run


def _commit(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(folder)
        for batch in batches:
            for old, new in zip(batch.column("temporary").to_pylist(), batch.column("file").to_pylist(), strict=True):
                if fs.get_file_info(f"{path}/{old}").is_file:  # else an earlier attempt renamed it
                    fs.move(f"{path}/{old}", f"{path}/{new}")
            yield batch.select(["file"])
    return run


def write_archives(pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES) -> None:
    """Archives of ``pages`` (page_id, url, html) under ``folder``."""
    spark = pages.sparkSession
    least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    shard, n = _shards(pages, shard_bytes, least)
    dealt = marked_pages(pages).withColumn("shard", shard).repartitionById(n, F.col("shard").cast("int")).sortWithinPartitions(
        "shard", "page_id", "url", "payload_digest")
    dealt.mapInArrow(_write(folder, roll_bytes), MANIFEST).write.parquet(f"{folder}/manifest")
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    files.select("temporary", "file").mapInArrow(_commit(folder), "file string").write.parquet(f"{folder}/committed")


def records(stream) -> Iterator[tuple[dict, bytes]]:
    """Headers (by lower-case name) and block of each record of a .warc.gz
    stream, one member at a time."""
    z, waiting = zlib.decompressobj(31), b""
    out = io.BytesIO()
    while True:
        data = waiting or stream.read(1 << 16)  # small, as what is left is copied at every record
        if not data:
            break
        out.write(z.decompress(data))
        waiting = z.unused_data
        if z.eof:
            yield _parse(out.getvalue())
            z, out = zlib.decompressobj(31), io.BytesIO()
    if out.tell():
        raise ValueError("the archive ends within a record")


def _parse(data: bytes) -> tuple[dict, bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[:int(headers["content-length"])]
    if len(rest) != len(block) + 4 or f"sha1:{hashlib.sha1(block).hexdigest()}" != headers["warc-block-digest"]:
        raise ValueError(f"damaged record {headers['warc-record-id']}")
    return headers, block


def _page_of(uri: str | None) -> int | None:
    return int(uri[len("<urn:page:"):-1]) if uri and uri != "<urn:page:>" else None


def _read(folder: str):
    fields = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)], [n for n, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows = []
                with fs.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for headers, block in records(stream):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(http.rpartition(b": ")[2])
                        digest = headers["warc-payload-digest"].removeprefix("sha1:")
                        kind = headers["warc-type"]
                        if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                            raise ValueError(f"damaged payload {headers['warc-record-id']}")
                        rows.append((_page_of(headers["warc-record-id"]), size, digest, kind, _page_of(headers.get("warc-refers-to"))))
                        if len(rows) >= 10_000:
                            yield table(rows)
                            rows = []
                yield table(rows)
    return run


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Per record, from the archives: page_id, payload_bytes, payload_digest,
    record_type, refers_to."""
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    spread = files.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "file")
    return spread.select("file").mapInArrow(_read(folder), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archives(pages: DataFrame, **sizes) -> DataFrame:
    """Write the archives to the shared folder and read them back."""
    folder = shared_folder(pages.sparkSession, "warc")
    write_archives(pages, folder, **sizes)
    return read_archives(pages.sparkSession, folder)
