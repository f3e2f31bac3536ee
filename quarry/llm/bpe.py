"""Byte-level BPE over a corpus: every distinct pre-token is encoded once.

Documents are packed into batches. A batch keeps its pre-tokens as places in
its own word list (the positions) and sends each distinct word once to the
partition its hash names; there, whatever the number of batches, a word is
encoded once and its ids go back to the batches that asked. A batch then
puts ids in the places of its words, which wait in a file of the shared
folder meanwhile, as they need not travel with the words. Decoding looks ids up in the
token-byte table, which the vocabulary bounds.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import new_path, release, released
from quarry.llm.files import Replacing, opened
from quarry.llm.pretoken import splitter

#: Characters of text per batch; one longer document is a batch by itself.
BATCH_CHARS = 4_000_000
#: Largest vocabulary whose token-byte table is given to every task.
MAX_VOCABULARY = 2_000_000
_ROWS = "batch bigint, bucket int, names array<bigint>, sizes array<bigint>, codes binary, words binary, file string"


def read_ranks(path: str) -> list[tuple[bytes, int]]:
    """The token-byte table of a rank file: one base64 token and its id per line."""
    with open(path, "rb") as f:
        ranks = [(base64.b64decode(t), int(r)) for t, r in (line.split() for line in f if line.strip())]
    if len(ranks) > MAX_VOCABULARY:
        raise ValueError(f"{len(ranks)} tokens; the table is meant for at most {MAX_VOCABULARY}")
    return ranks


def _squeeze(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte planes apart, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unsqueeze(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _join(pieces: list[bytes]) -> bytes:
    """Byte strings with their lengths, compressed."""
    head = np.array([len(pieces), *map(len, pieces)], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(pieces))


def _split(blob: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    ends = np.cumsum(np.frombuffer(raw, "<u4", n, 4).astype(np.int64)) + 4 * (n + 1)
    starts = np.concatenate([[4 * (n + 1)], ends[:-1]]) if n else ends
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


def _pack(pattern: str, buckets: int, folder: str):
    """mapInArrow body: (doc_id, text) to batches. One row per batch names the file of its codes, one per word bucket holds its words."""
    def rows(part: int, number: int, names, sizes, codes, words: dict[str, int]):
        batch = (part << 32) | number
        flat = np.array(codes, np.int64)
        order = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")  # frequent words get low codes
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        spelled = [w.encode("utf-8", "surrogatepass") for w in words]
        home = np.fromiter((xxhash.xxh32_intdigest(w) % buckets for w in spelled), np.int64, len(spelled))
        name = f"{batch:016x}-{uuid.uuid4().hex}"  # of this attempt only: a row and its file belong together
        with Replacing(folder, name) as out:
            out.write(_squeeze(rank[flat] if len(flat) else flat))
        yield batch, -1, names, sizes, None, None, f"{folder}/{name}"
        by_home = np.lexsort((rank, home))
        edges = np.flatnonzero(np.diff(home[by_home], prepend=-1))
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(by_home)]):
            mine = by_home[a:b]
            yield batch, int(home[mine[0]]), None, None, _squeeze(np.diff(rank[mine], prepend=0)), _join([spelled[i] for i in mine.tolist()]), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, split = TaskContext.get().partitionId(), 0, splitter(pattern)
        names, sizes, codes, words, chars = [], [], [], {}, 0

        def flush():
            out = list(zip(*rows(part, number, names, sizes, codes, words)))
            types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                              names=["batch", "bucket", "names", "sizes", "codes", "words", "file"])

        for arrow in batches:
            for name, text in zip(arrow.column(0).to_pylist(), arrow.column(1).to_pylist()):
                if names and chars + len(text or "") > BATCH_CHARS:
                    yield flush()
                    number += 1
                    names, sizes, codes, words, chars = [], [], [], {}, 0
                found = split(text) if text else []
                names.append(name)
                sizes.append(len(found))
                codes += [words.setdefault(w, len(words)) for w in found]
                chars += len(text or "")
        if names:
            yield flush()
    return run


def _encode(ranks_path: str):
    """mapInArrow body: the words of each row become their ids; the memo of a partition sees every word it owns once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        whole = tiktoken.Encoding("pieces", pat_str=r"(?s:.+)", mergeable_ranks=dict(read_ranks(ranks_path)), special_tokens={})
        memo: dict[bytes, bytes] = {}
        for arrow in batches:
            out = []
            for blob in arrow.column(5).to_pylist():
                if blob is None:
                    out.append(None)
                    continue
                words = _split(blob)
                for w in words:
                    if w not in memo:
                        memo[w] = np.array(whole.encode_ordinary(w.decode("utf-8", "surrogatepass")), "<u4").tobytes()
                out.append(_join([memo[w] for w in words]))
            yield arrow.set_column(5, "words", pa.array(out, pa.binary()))
    return run


def _place(table: pa.Table) -> pa.Table:
    """One batch: its words' ids into the places of its codes, cut at its documents' ends."""
    code_row, ids = None, {}
    for row in table.to_pylist():
        if row["bucket"] < 0:
            code_row = row
        else:
            ids.update(zip(np.cumsum(_unsqueeze(row["codes"]).astype(np.int64)).tolist(), _split(row["words"])))
    with opened(code_row["file"]) as f:
        codes = _unsqueeze(f.read()).astype(np.int64)
    pieces = [ids[i] for i in range(len(ids))]
    docs, at = [], 0
    for size in code_row["sizes"]:
        docs.append(b"".join([pieces[c] for c in codes[at:at + size].tolist()]))
        at += size
    out = pa.table({"doc_id": pa.array(code_row["names"], pa.int64()),
                    "n_tokens": pa.array([len(d) // 4 for d in docs], pa.int64()), "ids": pa.array(docs, pa.binary())})
    del table, code_row, ids, pieces, docs, codes
    release()
    return out


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, ids`` (unsigned 32-bit little-endian).

    Null and empty texts have no ids. Null and repeated ids stay, each row
    with its own text; other columns are not read; an empty table gives an
    empty result. Special tokens are ordinary text."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    packed = texts.mapInArrow(released(_pack(pattern, 2 * n, new_path(docs.sparkSession, "bpe-codes"))), _ROWS)
    # the code row of a batch needs no encoder and is dealt by its batch
    dealt = packed.repartition(n, F.when(F.col("bucket") >= 0, F.col("bucket").cast("bigint")).otherwise(F.xxhash64("batch")))
    return dealt.mapInArrow(released(_encode(ranks_path)), _ROWS).groupBy("batch").applyInArrow(_place, "doc_id bigint, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ``ids`` by the token-byte table. Null ids decode to null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {i: t for t, i in read_ranks(ranks_path)}
        for arrow in batches:
            ids = arrow.column(arrow.schema.get_field_index("ids")).to_pylist()
            out = [None if b is None else b"".join(map(table.__getitem__, np.frombuffer(b, "<u4").tolist())) for b in ids]
            yield pa.RecordBatch.from_arrays([*arrow.columns, pa.array(out, pa.binary())], names=[*arrow.schema.names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(released(run), f"{fields}, decoded binary")
