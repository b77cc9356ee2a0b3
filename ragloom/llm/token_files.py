"""Token ids in Arrow files of fixed-size lists (operator 7).

Every shard is an Arrow IPC file whose batches hold two columns of fixed-size
lists, the ids (16 bits each while the vocabulary fits them, else 32) and the
mask (a bit each) of sequences of equal length; the documents of a
shard lie in it one after the other, the last sequence is padded under mask 0.
The file's footer has the place of every batch and a list's place follows from
its number, so a memory-mapped reader gets any sequence without copying or
decoding.  A second Arrow file beside it has each document's start and length.

The documents are range-sorted by doc_id; each task encodes its range and
writes its shard under a temporary name of its own, holding one batch in
memory.  The manifest (a table of the shards whose tasks succeeded) is written
last; the shards that it names are then renamed, so a lost or repeated task
leaves nothing that a reader could take for a shard.

Defined results: a null text is an empty text (its end id alone); rows that
repeat a doc_id follow each other, in order of their text; null doc_ids come
first; an empty table gives no shard and no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import batches_of, file_system, shared_folder, worker_state
from .words import gpt2_unit_lists, library_ids, library_tokenizer, parts_of, spelled

SEQUENCE = 2048
BATCH_SEQUENCES = 256
AT_ONCE = 1000  # documents in a batch that holds their texts
MANIFEST = "shard long, file string, documents long, tokens long"


def sequence_schema(length: int, ids: pa.DataType) -> pa.Schema:
    return pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length))])


DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class Encoder:
    """texts -> ids as bytes, equal to encoding the whole texts with the
    library; in 16 bits while the vocabulary's numbers fit them, else in 32."""

    def __init__(self, tokenizer_path: str):
        tokenizer = library_tokenizer(tokenizer_path)
        self.width = "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self._tokenizer = tokenizer
        self.forget()

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        for part in parts_of(texts):
            yield from self._ids.lists(*spelled(gpt2_unit_lists(part)))

    def forget(self) -> None:
        """Gives the memory of the cache back."""
        self._ids = library_ids(self._tokenizer, self.width)


class ShardWriter:
    """The two files of one shard; holds one batch of sequences at most."""

    def __init__(self, folder: str, name: str, length: int, width: str):
        fs, path = file_system(folder)
        fs.create_dir(path, recursive=True)
        self._length, self._step, self._width = length, length * BATCH_SEQUENCES, np.dtype(width)
        self._schema = sequence_schema(length, pa.from_numpy_dtype(self._width))
        self._files = [fs.open_output_stream(f"{path}/{name}.{kind}.tmp") for kind in ("sequences", "documents")]
        self._sequences = pa.ipc.new_file(self._files[0], self._schema)
        self._documents = pa.ipc.new_file(self._files[1], DOCUMENTS)
        self._ids: list[bytes] = []
        self._held = self.tokens = self.documents = 0
        self._index: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // self._width.itemsize
        self._index.append((doc_id, self.tokens, n))
        self.documents, self.tokens, self._held = self.documents + 1, self.tokens + n, self._held + n
        self._ids.append(ids)
        if self._held >= self._step:
            self._write_full()
        if len(self._index) >= 50_000:
            self._write_index()

    def _write_full(self) -> None:
        data = np.frombuffer(b"".join(self._ids), self._width)
        end = len(data) // self._step * self._step
        for i in range(0, end, self._step):
            self._batch(data[i:i + self._step], np.ones(self._step, bool))
        self._ids, self._held = [data[end:].tobytes()], len(data) - end

    def _batch(self, ids: np.ndarray, mask: np.ndarray) -> None:
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self._length) for x in (ids, mask)]
        self._sequences.write_batch(pa.RecordBatch.from_arrays(columns, schema=self._schema))

    def _write_index(self) -> None:
        columns = [pa.array([x[i] for x in self._index], pa.int64()) for i in range(3)]
        self._documents.write_batch(pa.RecordBatch.from_arrays(columns, schema=DOCUMENTS))
        self._index = []

    def close(self) -> None:
        data = np.frombuffer(b"".join(self._ids), self._width)
        padded = -(-len(data) // self._length) * self._length
        if padded:
            self._batch(np.r_[data, np.zeros(padded - len(data), self._width)], np.arange(padded) < len(data))
        self._write_index()
        for x in (self._sequences, self._documents, *self._files):
            x.close()


def _write(folder: str, tokenizer_path: str, end_id: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard, name, writer = TaskContext.get().partitionId(), uuid.uuid4().hex, None
        encoder = worker_state(f"encoder of {tokenizer_path}", lambda: Encoder(tokenizer_path))
        end = np.array([end_id], encoder.width).tobytes()
        for batch in batches:
            if writer is None and batch.num_rows:
                writer = ShardWriter(folder, name, length, encoder.width)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text")), strict=True):
                writer.add(doc_id, ids + end)
        encoder.forget()  # the worker lives on, and stages of other operators need its memory
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "file": [name], "documents": [writer.documents], "tokens": [writer.tokens]})
    return run


def _commit(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                for kind in ("sequences", "documents"):
                    if fs.get_file_info(f"{path}/{name}.{kind}.tmp").is_file:  # else an earlier attempt renamed it
                        fs.move(f"{path}/{name}.{kind}.tmp", f"{path}/{name}.{kind}.arrow")
            yield batch.select(["file"])
    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, length: int = SEQUENCE) -> None:
    """Encode ``docs`` (doc_id, text) into shards under ``folder``."""
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    with batches_of(docs.sparkSession, AT_ONCE):
        ordered.mapInArrow(_write(folder, tokenizer_path, end_id, length), MANIFEST).write.parquet(f"{folder}/manifest")
    shards = docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    shards.select("file").mapInArrow(_commit(folder), "file string").write.parquet(f"{folder}/committed")


def open_map(folder: str, name: str) -> pa.ipc.RecordBatchFileReader:
    """Reader of a committed file; memory-mapped where the folder is mounted."""
    fs, path = file_system(folder)
    local = folder.startswith("file:")
    return pa.ipc.open_file(pa.memory_map(f"{path}/{name}") if local else fs.open_input_file(f"{path}/{name}"))


class Sequences:
    """Random access to the sequences of a shard."""

    def __init__(self, reader: pa.ipc.RecordBatchFileReader, length: int):
        self._reader, self._length, self._at, self._batch = reader, length, -1, None

    def _load(self, i: int) -> pa.RecordBatch:
        if i != self._at:
            self._at, self._batch = i, self._reader.get_batch(i)
        return self._batch

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of the i-th sequence: the ids are a view of the file's
        pages, the mask's bits are unpacked."""
        batch, row = self._load(i // BATCH_SEQUENCES), i % BATCH_SEQUENCES
        return tuple(batch.column(c).values[row * self._length:(row + 1) * self._length].to_numpy(zero_copy_only=not c) for c in (0, 1))

    def tokens(self, start: int, n: int) -> np.ndarray:
        """The shard's ids start .. start + n, padding left out."""
        step, out = self._length * BATCH_SEQUENCES, []
        while n:
            i, at = divmod(start, step)
            values, mask = (self._load(i).column(c).values[at:at + n].to_numpy(zero_copy_only=not c) for c in (0, 1))
            out.append(values[mask])
            start, n = start + len(values), n - len(values)
        return np.concatenate(out) if out else np.empty(0, "<u4")


def _read(folder: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, before in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist(), strict=True):
                sequences, documents = Sequences(open_map(folder, f"{name}.sequences.arrow"), length), open_map(folder, f"{name}.documents.arrow")
                for i in range(documents.num_record_batches):
                    index = documents.get_batch(i)
                    crcs = [zlib.crc32(sequences.tokens(s, n).astype("<u4").tobytes())
                            for s, n in zip(index.column("start").to_pylist(), index.column("n_tokens").to_pylist(), strict=True)]
                    start = pa.array(index.column("start").to_numpy() + before, pa.int64())
                    yield pa.RecordBatch.from_arrays([index.column("doc_id"), start, index.column("n_tokens"), pa.array(crcs, pa.int64())],
                                                     ["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read_token_files(spark: SparkSession, folder: str, length: int = SEQUENCE) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32."""
    shards = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").collect()  # a row a file, as many as there were tasks
    placed, before = [], 0
    for row in sorted(shards, key=lambda r: r.shard):
        placed.append((row.file, before))
        before += row.tokens
    placed = spark.createDataFrame(placed, "file string, before long")
    spread = placed.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "file")
    return spread.select("file", "before").mapInArrow(_read(folder, length), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 2, length: int = SEQUENCE) -> DataFrame:
    """Write the files to the shared folder and read them back."""
    folder = shared_folder(docs.sparkSession, "token-files")
    write_token_files(docs, folder, tokenizer_path, end_id, length)
    return read_token_files(docs.sparkSession, folder, length)
