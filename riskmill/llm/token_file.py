"""Token ids in Arrow stream files of equal-length sequences and masks."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmill.llm.common import as_bytes
from riskmill.llm.tokens import default_tokenizer, packed, word_table
from riskmill.sources.workspace import fresh_path, stage

SPAN_SCHEMA = "doc_id bigint, part int, path string, first bigint, n_tokens bigint"
SEQUENCES_PER_BATCH = 64
TEXTS_AT_ONCE = 500


def file_schema(length: int) -> pa.Schema:
    """``ids`` (16 bits each, enough for 65,536 tokens) and ``mask`` (true: a token, false: padding)."""
    return pa.schema([("ids", pa.list_(pa.uint16(), length)), ("mask", pa.list_(pa.bool_(), length))])


def open_store(uri: str):
    """The Arrow file system of a path or address, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class SequenceWriter:
    """Takes packed ids and writes full batches of sequences; ``close`` pads the last sequence."""

    def __init__(self, uri: str, length: int):
        self.length, self.schema = length, file_schema(length)
        store, path = open_store(uri)
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.sink = store.open_output_stream(path)
        self.writer = pa.ipc.new_stream(self.sink, self.schema)
        self.pending, self.size, self.written = [], 0, 0

    def add(self, ids: bytes) -> None:
        self.pending.append(ids)
        self.size += len(ids)
        if self.size >= 2 * self.length * SEQUENCES_PER_BATCH:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.pending), "<u2")
        whole = len(ids) if last else len(ids) - len(ids) % (self.length * SEQUENCES_PER_BATCH)
        self.pending, self.size = [ids[whole:].tobytes()], 2 * (len(ids) - whole)
        step = self.length * SEQUENCES_PER_BATCH
        for first in range(0, whole, step):
            self._write(ids[first : min(first + step, whole)])
        self.written += whole

    def _write(self, ids: np.ndarray) -> None:
        padding = -len(ids) % self.length
        mask = np.ones(len(ids) + padding, bool)
        if padding:
            mask[len(ids) :] = False
            ids = np.concatenate([ids, np.zeros(padding, ids.dtype)])
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(ids.astype(np.uint16, copy=False)), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
        ]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        self._flush(last=True)
        self.writer.close()
        self.sink.close()


class SequenceFile:
    """Sequences of a file by number. A local file is mapped into memory and its arrays are views of it."""

    def __init__(self, uri: str):
        store, path = open_store(uri)
        source = pa.memory_map(path) if store.type_name == "local" else store.open_input_file(path)
        self.batches = list(pa.ipc.open_stream(source))
        self.length = self.batches[0].schema.field("ids").type.list_size if self.batches else 0

    def __len__(self) -> int:
        return sum(b.num_rows for b in self.batches)

    def _values(self, batch: pa.RecordBatch, name: str) -> pa.Array:
        return batch.column(name).flatten()

    def sequence(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask."""
        batch = self.batches[number // SEQUENCES_PER_BATCH]
        at = number % SEQUENCES_PER_BATCH * self.length
        ids = self._values(batch, "ids").slice(at, self.length).to_numpy()
        return ids, self._values(batch, "mask").slice(at, self.length).to_numpy(zero_copy_only=False)

    def tokens(self, first: int, count: int) -> np.ndarray:
        """``count`` ids from position ``first``; a view unless they cross batches."""
        per = SEQUENCES_PER_BATCH * self.length
        parts = []
        while count > 0:
            batch, at = self.batches[first // per], first % per
            taken = min(count, per - at)
            parts.append(self._values(batch, "ids").slice(at, taken).to_numpy())
            first, count = first + taken, count - taken
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str | None = None,
    end_id: int = 2,
    length: int = 2048,
) -> DataFrame:
    """Encode every text, end each with ``end_id``, and write the ids in ascending ``doc_id`` order.

    The documents are range-partitioned by id; each task writes one file under ``folder`` and packs its
    documents into sequences of ``length`` ids without gaps; only the last sequence is padded. Returns the
    stored index: doc_id, part (order of the file), path, first (position in the file), n_tokens. A file's
    name is new in each attempt and known only through the index, which Spark commits, so a repeated task
    leaves at most an unused file.

    NULL texts are empty (the end id alone); NULL ids come first; rows with equal ids are ordered by text;
    other columns are ignored; an empty table gives an empty index.
    """
    path = tokenizer_path or default_tokenizer("word_bpe_49k.json")
    end = packed([end_id])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        table, writer, position, target = word_table(path, packed), None, 0, f"{folder}/{uuid.uuid4().hex}.arrows"
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                writer = writer or SequenceWriter(target, length)
                firsts, counts = [], []
                for parts in table.rows([t.split() for t in as_bytes(batch.column(1))]):
                    ids = b"".join(parts) + end
                    writer.add(ids)
                    firsts.append(position)
                    counts.append(len(ids) // 2)
                    position += counts[-1]
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([part] * n, pa.int32()),
                        pa.array([target] * n, pa.string()),
                        pa.array(firsts, pa.int64()),
                        pa.array(counts, pa.int64()),
                    ],
                    ["doc_id", "part", "path", "first", "n_tokens"],
                )
        if writer:
            writer.close()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stage(ordered.mapInArrow(run, SPAN_SCHEMA), "token-index")


def read_token_files(index: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, read from the files of ``index``.

    ids_crc32 is taken over the ids as little-endian 32-bit integers.
    """
    files = index.groupBy("part", "path").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    starts = files.select("path", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for batch in batches:
            sums = []
            for path, first, count in zip(*(batch.column(c).to_pylist() for c in ("path", "first", "n_tokens"))):
                if path != name:
                    name, file = path, SequenceFile(path)
                sums.append(zlib.crc32(file.tokens(first, count).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "path", "first", "n_tokens")] + [pa.array(sums, pa.int64())],
                ["doc_id", "path", "first", "n_tokens", "ids_crc32"],
            )

    read = index.mapInArrow(run, "doc_id bigint, path string, first bigint, n_tokens bigint, ids_crc32 bigint")
    return read.join(starts, "path").select(
        "doc_id", (F.col("file_start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )


def encode_documents(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Write the files to the shared folder and read them back."""
    folder = fresh_path(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, folder, tokenizer_path))
