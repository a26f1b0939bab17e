"""Operator 7: token ids in binary files, with Elias-Fano coded document boundaries.

A file holds documents in ascending id order: a header, the code of the boundaries (one more than documents), the code of
the ids' distances from the smallest one, and the token ids, 16 bits each if the vocabulary allows it, else 32. Files of one
task follow each other, as do the tasks, so the files in the manifest's order are one id array.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.staging import staged, staged_path
from . import elias_fano
from .common import arrow_map, running_total, text_table
from .library_ids import encoder

MAGIC = b"IDS1"
#: Bytes of ids after which a task begins another file.
FILE_BYTES = 16 * 1024 * 1024
MANIFEST = "path string, task long, file long, n_docs long, n_ids long"
HEADER = "<4sQQQQqQQ"  # magic, bytes of an id, documents, documents without an id, ids, smallest id, bytes of either code


def _pack(doc_ids: list[int | None], tokens: list[np.ndarray], width: int) -> bytes:
    known = np.array([x for x in doc_ids if x is not None], np.int64)
    first = int(known[0]) if len(known) else 0
    ends = elias_fano.encode(np.cumsum([0, *map(len, tokens)]).astype(np.uint64))
    names = elias_fano.encode(known.astype(np.uint64) - np.uint64(first % 2**64))
    body = np.concatenate(tokens).astype("<u2" if width == 2 else "<u4").tobytes()
    return struct.pack(HEADER, MAGIC, width, len(doc_ids), len(doc_ids) - len(known), len(body) // width, first, len(ends), len(names)) + ends + names + body


class TokenFile:
    """One file: ``doc_ids``, ``bounds`` (an Elias-Fano select structure) and the ids of any document."""

    def __init__(self, data: bytes):
        magic, width, self.n_docs, nulls, _, first, a, b = struct.unpack_from(HEADER, data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = struct.calcsize(HEADER)
        self.bounds = elias_fano.Select(data[at : at + a])
        names = elias_fano.Select(data[at + a : at + a + b]).all() + np.uint64(first % 2**64)
        self.doc_ids: list[int | None] = [None] * nulls + names.astype(np.int64).tolist()
        self.ids = np.frombuffer(data, "<u2" if width == 2 else "<u4", offset=at + a + b)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.bounds[i] : self.bounds[i + 1]]


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", width: int = 2) -> DataFrame:
    """Encode whole texts, append ``end_id``, write files below ``folder``, and give the manifest (staged).

    A null or empty text is ``end_id`` alone. Documents without an id come first, repeated ids stay side by side. An id that
    does not fit ``width`` bytes is an error. A file counts only when its task's row is in the manifest, so files left by lost
    tasks are never read. No documents: an empty manifest.
    """
    filesystem, root = fs.FileSystem.from_uri(folder)
    filesystem.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, base = fs.FileSystem.from_uri(folder)
        ids_of, task, name, number = encoder(tokenizer), TaskContext.get().partitionId(), uuid.uuid4().hex, 0
        held: tuple[list, list] = ([], [])
        size = 0

        def flush() -> pa.RecordBatch:
            path = f"{base}/{task:06d}-{number:06d}-{name}.ids"
            with target.open_output_stream(path) as out:
                out.write(_pack(*held, width))
            return pa.RecordBatch.from_pylist(
                [{"path": path, "task": task, "file": number, "n_docs": len(held[0]), "n_ids": sum(map(len, held[1]))}],
                schema=pa.schema([("path", pa.string()), *[(c, pa.int64()) for c in ("task", "file", "n_docs", "n_ids")]]),
            )

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), ids_of(batch.column("text").to_pylist())):
                held[0].append(doc_id)
                held[1].append(np.append(ids, np.uint32(end_id)))
                if width == 2 and held[1][-1].max() > 0xFFFF:
                    raise ValueError("a token id does not fit 16 bits: use width=4")
                size += width * len(held[1][-1])
                if size >= FILE_BYTES:
                    yield flush()
                    held, size, number = ([], []), 0, number + 1
        if held[0]:
            yield flush()

    rows = text_table(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return staged(arrow_map(rows, write, MANIFEST), "manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document of the files: ``doc_id, start, n_tokens, ids_crc32``; ``start`` counts the ids of all documents before it."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                with source.open_input_stream(path) as data:
                    found = TokenFile(data.read())
                bounds = found.bounds.all().astype(np.int64)
                crcs = [zlib.crc32(found.ids[a:b].astype("<u4").tobytes()) for a, b in zip(bounds, bounds[1:])]
                columns = [pa.array(found.doc_ids, pa.int64()), pa.array(bounds[:-1] + base), pa.array(np.diff(bounds)), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    order = Window.partitionBy("task").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("within", F.coalesce(F.sum("n_ids").over(order), F.lit(0)))
    tasks = running_total(manifest.groupBy("task").agg(F.sum("n_ids").alias("total")), "task", "total", "base")
    files = files.join(tasks.select("task", "base"), "task").select("path", (F.col("base") + F.col("within")).alias("base"))
    return arrow_map(files.repartition("path"), read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Write and read back."""
    folder = folder or staged_path(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, folder, tokenizer, end_id), folder)
