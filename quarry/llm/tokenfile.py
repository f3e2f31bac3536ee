"""Token files: one zstandard frame per document, a trailing seek table with
a checksum per frame, so that a reader decompresses only what it asks for.

Layout of a file: the documents' frames in ascending doc_id; a skippable
frame with their ids; a skippable frame with the seek table in the public
seekable layout (compressed size, size, low 32 bits of XXH64 per frame;
frame count, flags and magic number at the end). Token ids are unsigned
16-bit or 32-bit little-endian numbers, as the vocabulary needs.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import new_path, released, written
from quarry.llm.files import Replacing, opened
from quarry.llm.pretoken import splitter, starts, strings

#: Numbers of the public frame and seekable layouts; fixed values.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
IDS_FRAME = 0x184D2A50
#: Words whose ids a worker remembers, twice: those of late, and those of the time before.
MEMO = 400_000
#: Bytes of text encoded together; one longer text is alone.
CHUNK_BYTES = 1 << 20
#: Bytes of text per file.
FILE_BYTES = 256 << 20
_MANIFEST = "part int, file string, n_docs bigint, n_tokens bigint, width int"


class Words(dict):
    """Ids by word. A word not met before is encoded; when the table is full it becomes the one before, from which words come back."""

    def __init__(self, encode, most: int):
        self.encode, self.most, self.before = encode, most, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = self.encode(word)
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        self[word] = ids
        return ids


class WordEncoder:
    """Ids of whole texts by a byte-level vocabulary of the tokenizers library, one pre-token at a time.

    Texts are cut into pre-tokens together, and each distinct one is looked up once for all of them. The
    library's model encodes those not met of late; a text that holds an added token goes to the library whole."""

    def __init__(self, path: str, pattern: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.split, self.tokenize = splitter(pattern), self.whole.model.tokenize
        self.published = pattern == public_tokenizers.PATTERN
        self.width = np.dtype("<u2" if self.whole.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.words = Words(self.word, MEMO)
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        # bytes that are no printable Latin-1 character take the code points from U+0100 on, in order
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = [chr(b) for b in range(256)]
        for i, b in enumerate(hidden):
            self.letters[b] = chr(256 + i)
        self.blank, self.format = self.letters[0x20], "<%dH" if self.width.itemsize == 2 else "<%dI"

    def word(self, w: str) -> bytes:
        if w.isascii() and w.isprintable():
            spelled = w.replace(" ", self.blank)
        else:
            spelled = "".join(map(self.letters.__getitem__, w.encode("utf-8", "surrogatepass")))
        ids = [t.id for t in self.tokenize(spelled)]
        return struct.pack(self.format % len(ids), *ids)

    def together(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts without added tokens, by the published pattern."""
        ends = np.cumsum([len(t) for t in texts])
        data = np.frombuffer(b"".join(texts), np.uint8)
        if not len(data):
            return [b""] * len(texts)
        at = starts(data, ends)
        words = strings(data, at).dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = pa.array(list(map(self.words.__getitem__, distinct)), pa.large_binary()).take(words.indices)
        _, edges, body = ids.buffers()
        cuts = np.frombuffer(edges, np.int64)[np.searchsorted(at, ends)].tolist()
        return [body[a:b].to_pybytes() for a, b in zip([0, *cuts], cuts)]

    def __call__(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text, in order. Reads ahead by CHUNK_BYTES."""
        chunk, size = [], 0
        for text in texts:
            text = text or ""
            if any(a in text for a in self.added):
                yield from self.together(chunk)
                chunk, size = [], 0
                yield np.array(self.whole.encode(text, add_special_tokens=False).ids, self.width).tobytes()
            elif not self.published:
                yield b"".join(map(self.words.__getitem__, self.split(text)))
            else:
                raw = text.encode()
                if size + len(raw) > CHUNK_BYTES:
                    yield from self.together(chunk)
                    chunk, size = [], 0
                chunk.append(raw)
                size += len(raw)
        yield from self.together(chunk)


_ENCODERS: dict[tuple[str, str], WordEncoder] = {}


def _encoder(path: str, pattern: str) -> WordEncoder:
    """The worker's encoder: its memo serves all tasks the worker runs."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = WordEncoder(path, pattern)
    return _ENCODERS[path, pattern]


def write_file(out, docs: Iterable[tuple[int | None, bytes]], width: int) -> tuple[int, int]:
    """Write (doc_id, ids of ``width`` bytes each) in the given order; returns the numbers of documents and ids."""
    press, table, names, tokens = zstandard.ZstdCompressor(level=3), [], [], 0
    for name, ids in docs:
        frame = press.compress(ids)
        out.write(frame)
        table.append(struct.pack("<III", len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        names.append(name)
        tokens += len(ids) // width
    known = bytes(n is not None for n in names)
    body = bytes([width]) + known + np.array([n or 0 for n in names], "<i8").tobytes()
    out.write(struct.pack("<II", IDS_FRAME, len(body)) + body)
    body = b"".join(table) + struct.pack("<IBI", len(table), 0x80, SEEKABLE)
    out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
    return len(table), tokens


class Reader:
    """Documents of one file by number or id; reads the tables at the end, then only the frames asked for."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        n, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != SEEKABLE or not flags & 0x80:
            raise ValueError("no seek table with checksums at the end")
        at = size - 9 - 12 * n
        rows = np.frombuffer(file.read_at(12 * n, at), "<u4").reshape(n, 3).astype(np.int64)
        self.sizes, self.checks = rows[:, 0], rows[:, 2]
        self.ends = np.cumsum(self.sizes)
        body = file.read_at(1 + 9 * n, at - 9 - 9 * n)
        self.width, known, names = body[0], body[1:1 + n], np.frombuffer(body[1 + n:], "<i8").tolist()
        self.names = [v if k else None for k, v in zip(known, names)]

    def __len__(self) -> int:
        return len(self.names)

    def ids(self, i: int) -> bytes:
        frame = self.file.read_at(int(self.sizes[i]), int(self.ends[i] - self.sizes[i]))
        data = zstandard.ZstdDecompressor().decompress(frame) if len(frame) else b""
        if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.checks[i]:
            raise ValueError(f"checksum of frame {i} does not match")
        return data


def write_tokens(docs: DataFrame, tokenizer_path: str, pattern: str, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Write token files and return their manifest: ``part, file, n_docs, n_tokens, width`` (bytes of an id).

    Files cover ascending ranges of doc_id, about FILE_BYTES of text each when there are more than shuffle partitions; ``part`` orders them. Nulls in
    the id column come first. Rows with equal ids stand in the order of
    their texts' hashes, each with its own frame. A null or empty text is
    the end id alone. Other columns are not read. An empty table gives
    files without documents."""
    folder = folder or new_path(docs.sparkSession, "tokens")
    n_bytes = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // FILE_BYTES))
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    texts = texts.withColumn("_tie", F.xxhash64("text"))
    ordered = texts.repartitionByRange(n, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encode = _encoder(tokenizer_path, pattern)
        end = np.array([end_id], encode.width).tobytes()
        pieces = (b.slice(low, 256) for b in batches for low in range(0, b.num_rows, 256))
        pairs = ((name, ids + end) for b in pieces for name, ids in zip(b.column(0).to_pylist(), encode(b.column(1).to_pylist())))
        name = f"tokens-{part:06d}.zst"
        with Replacing(folder, name) as out:
            n_docs, n_tokens = write_file(out, pairs, encode.width.itemsize)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([f"{folder}/{name}"]), pa.array([n_docs], pa.int64()),
                                          pa.array([n_tokens], pa.int64()), pa.array([encode.width.itemsize], pa.int32())],
                                         names=["part", "file", "n_docs", "n_tokens", "width"])

    return written(ordered.select("doc_id", "text").mapInArrow(released(run), _MANIFEST), "token-manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """One row per document of the files: ``doc_id, start, n_tokens, ids`` (bytes as stored), ``width`` (bytes of an id, which
    each file tells); ``start`` counts the ids of all documents before it."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per file, not per document
    files = written(manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).select("file", "start"), "token-files")
    files = files.repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with opened(path) as f:
                    reader = Reader(f)
                    for low in range(0, len(reader), 256):
                        ids = [reader.ids(i) for i in range(low, min(low + 256, len(reader)))]
                        sizes = np.array([len(x) // reader.width for x in ids], np.int64)
                        starts = start + np.cumsum(sizes) - sizes
                        start += int(sizes.sum())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(reader.names[low:low + len(ids)], pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()),
                             pa.array(ids, pa.binary()), pa.array([reader.width] * len(ids), pa.int32())],
                            names=["doc_id", "start", "n_tokens", "ids", "width"])

    return files.mapInArrow(released(run), "doc_id bigint, start bigint, n_tokens bigint, ids binary, width int")


def checksums(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` over the ids as unsigned 32-bit little-endian numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for b in batches:
            crc = [zlib.crc32(np.frombuffer(x, f"<u{w}").astype("<u4").tobytes()) for x, w in zip(b.column(3).to_pylist(), b.column(4).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.mapInArrow(released(run), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
