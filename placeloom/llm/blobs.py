"""Arrays and token batches as compact binary columns."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from placeloom.llm.store import numbered


def pack(values: np.ndarray, level: int = 1) -> bytes:
    """Bytes of an array, its byte planes side by side, compressed."""
    flat = np.ascontiguousarray(values)
    return zstandard.ZstdCompressor(level=level).compress(flat.view(np.uint8).reshape(len(flat), flat.itemsize).T.tobytes())


def unpack(blob: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def pack_words(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"\n".join(words))


def unpack_words(blob: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(blob).split(b"\n")


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def column(batch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def rows_of(parts: Iterator[pa.RecordBatch], *names: str) -> Iterator[list]:
    """The rows of large cells one by one, so that only one is there as Python objects."""
    for part in parts:
        columns = [part.column(part.schema.get_field_index(n)) for n in names]
        for k in range(part.num_rows):
            yield [c[k].as_py() for c in columns]


TOKENISED = "batch long, words binary, ids binary, lengths array<int>, doc_ids array<long>, rows array<long>"


def tokenised(docs: DataFrame, row: str | None = None, max_tokens: int = 1 << 21) -> DataFrame:
    """Whole texts as batches of at most about `max_tokens` words: the batch's distinct words, the texts as indices into them, and
    the length, id and row number of each document. Words are what lies between ASCII white space, A-Z lower-cased."""
    schema = pa.schema([("batch", pa.int64()), ("words", pa.binary()), ("ids", pa.binary()), ("lengths", pa.list_(pa.int32())),
                        ("doc_ids", pa.list_(pa.int64())), ("rows", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        known: dict[bytes, int] = {}
        ids, lengths, doc_ids, rows, waiting = [], [], [], [], []

        def fold() -> None:
            found = pa.array(waiting, pa.binary()).dictionary_encode()
            place = np.fromiter((known.setdefault(w, len(known)) for w in found.dictionary.to_pylist()), np.int32)
            ids.append(place[found.indices.to_numpy(zero_copy_only=False)] if len(waiting) else np.zeros(0, np.int32))
            waiting.clear()

        def flush() -> pa.RecordBatch:
            nonlocal made
            fold()
            row = [[(part << 32) | made], [pack_words(list(known))], [pack(np.concatenate(ids))], [lengths], [doc_ids], [rows]]
            made += 1
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for text, doc_id, row in zip(text_bytes(batch), column(batch, "doc_id"), column(batch, "_row")):
                words = text.lower().split() if text else []
                waiting.extend(words)
                lengths.append(len(words))
                doc_ids.append(doc_id)
                rows.append(row)
                if len(waiting) > 250_000:
                    fold()
                if len(lengths) >= 1 << 16 or sum(map(len, ids)) + len(waiting) >= max_tokens:
                    yield flush()
                    known, ids, lengths, doc_ids, rows = {}, [], [], [], []
        if lengths:
            yield flush()

    return numbered(docs, row).mapInArrow(run, TOKENISED)


def tasks(df: DataFrame) -> int:
    """Shuffle partitions of the session."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
