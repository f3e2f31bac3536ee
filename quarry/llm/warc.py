"""WARC archives and their capture index.

Records are built as DataFrame expressions and written by Spark's text
writer as gzip-compressed archive files: a record ends with two line
breaks, which is the writer's line separator, so the files are plain WARC
and no task handles a file system itself. Reading splits at the same
separator and joins the pieces by each record's Content-Length.

Every archive read gives a locally sorted run of captures. Runs are dealt
by ranges of (URL key, timestamp) and merged within each range by a
loser tree, which gives capture histories in global order.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import heavy_keys, new_path, small, spread_join, written

#: Records per archive file; it bounds the captures that a reader sorts at once.
RECORDS_PER_FILE = 20_000
#: Captures per range of the merge.
CAPTURES_PER_RANGE = 200_000
_END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CAPTURE = ("url_key string, ts string, page_id bigint, url string, record_type string, payload_digest string, "
            "payload_bytes bigint, refers_to bigint, file string, record int")


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hexadecimal digits make four base32 digits."""
    hexed = F.sha1(payload.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def url_key(url: Column) -> Column:
    """Sort key of a URL: host labels reversed and joined by commas, then ``)`` and the rest, ASCII letters in lower case."""
    low = F.translate(F.coalesce(url, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    host = F.regexp_extract(low, r"(?s)^.*?://([^/?#]*)", 1)
    rest = F.regexp_extract(low, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    keyed = F.concat(F.array_join(F.reverse(F.split(host, "\\.")), ","), F.lit(")"), rest)
    return F.when(host == "", low).otherwise(keyed)


def _first_copies(pages: DataFrame, min_bytes: int) -> DataFrame:
    """Payload digests that occur twice or more, with the smallest page_id that has them."""
    counts = pages.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(
        F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    return counts.filter("copies > 1")


def _with_first(df: DataFrame, firsts: DataFrame) -> DataFrame:
    """``df`` with ``first_id`` of its digest. Beyond the broadcast bound narrow rows meet the digests, those of many pages dealt to
    pieces, and whole pages are joined to them by page and digest, so copies of one page do not meet in one task."""
    key = "payload_digest"
    if small(firsts, 64):
        return df.join(F.broadcast(firsts.select(key, "first_id")), key, "left")
    narrow = spread_join(df.select("page_id", key), firsts.select(key, "first_id"), key, heavy_keys(firsts, key, "copies"), "page_id")
    marks = written(narrow.distinct(), "copied-pages").withColumnsRenamed({"page_id": "_id", key: "_digest"})
    return df.join(marks, (df[key] == F.col("_digest")) & df["page_id"].eqNullSafe(F.col("_id")), "left").drop("_id", "_digest")


def write_archives(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", ts_col: str | None = None, min_bytes: int = 0) -> str:
    """Write one record per page and return the folder.

    Of pages with equal payloads of at least ``min_bytes``, those with the
    smallest page_id are responses and the others revisit it. A null page
    id stands after all others; without any id all copies are responses.
    Null html is an empty payload, a null url has no target header. Without
    ``ts_col`` (a timestamp) the date is the epoch plus page_id seconds.
    Other columns are not read. An empty table gives an archive without records."""
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    html = F.coalesce(F.col(html_col), F.lit(""))
    ts = F.col(ts_col) if ts_col else F.timestamp_seconds(F.coalesce(F.col(id_col), F.lit(0)))
    df = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.regexp_replace(F.col(url_col), "[\\r\\n]", "").alias("url"),
        html.alias("html"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
        F.octet_length(html).cast("bigint").alias("payload_bytes"), base32_sha1(html).alias("payload_digest"))
    df = _with_first(df, written(_first_copies(df, min_bytes), "first-copies"))
    revisit = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    block = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                     F.col("payload_bytes").cast("string"), F.lit(_END), F.when(revisit, "").otherwise(F.col("html")))
    df = df.withColumn("_revisit", revisit).withColumn("_block", block)

    def field(name, value):
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))).otherwise("")

    def page(i):
        return F.concat(F.lit("<urn:x-page:"), i.cast("string"), F.lit(">"))

    record = F.concat(
        F.lit("WARC/1.1\r\n"), field("WARC-Type", F.when(F.col("_revisit"), "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), F.coalesce(page(F.col("page_id")), F.lit("<urn:x-page:none>")), F.lit("\r\n")),
        field("WARC-Target-URI", F.col("url")), field("WARC-Date", F.col("date")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        field("WARC-Payload-Length", F.col("payload_bytes")),
        field("WARC-Refers-To", F.when(F.col("_revisit"), page(F.col("first_id")))),
        field("WARC-Profile", F.when(F.col("_revisit"), F.lit(_PROFILE))),
        F.concat(F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "),
                 F.octet_length("_block").cast("string"), F.lit(_END)), F.col("_block"))
    (df.select(record.alias("value")).write.option("lineSep", _END).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder))
    return folder


def _records(pieces: Iterable[tuple[str, bytes]]) -> Iterator[tuple[str, int, dict[str, str], bytes]]:
    """(file, number, headers, block) from the pieces between separators, in file order.

    Bytes beyond a block's Content-Length and the separator, which are there if
    the block ends with a line break, start the next record's head."""
    end = _END.encode()
    file, number, head, block, size, have = None, 0, None, [], 0, 0

    def opened(piece):
        lines = piece.decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"{file}: record {number} has no version line")
        fields = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
        if not fields.get("Content-Length", "").isdigit():
            raise ValueError(f"{file}: the head of record {number} is cut")
        return fields, int(fields["Content-Length"])

    for path, piece in pieces:
        if path != file:
            if head is not None:
                raise ValueError(f"{file}: the last record is cut")
            file, number = path, 0
        if head is None:
            head, size = opened(piece)
            block, have = [], -len(end)
            continue
        block.append(piece)
        have += len(end) + len(piece)
        if have >= size:
            whole = end.join(block)
            yield file, number, head, whole[:size]
            number, head, rest = number + 1, None, whole[size:]
            if rest and not rest.startswith(end):
                raise ValueError(f"{file}: record {number - 1} is longer than its Content-Length")
            if len(rest) > len(end):
                head, size = opened(rest[len(end):])
                block, have = [], -len(end)
    if head is not None:
        raise ValueError(f"{file}: the last record is cut")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Captures of all archives, as one sorted run per file; the digest of every response is checked against its payload."""
    raw = spark.read.option("lineSep", _END).text(folder)
    raw = raw.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = ((f, v) for b in batches for f, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        file, rows = None, []
        for path, number, head, block in _records(pieces):
            if path != file and rows:
                yield _captures(rows)
                rows = []
            file = path
            digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
            if head["WARC-Type"] == "response":
                payload = block.split(_END.encode(), 1)[1]
                if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest or len(payload) != int(head["WARC-Payload-Length"]):
                    raise ValueError(f"{path}: payload of record {number} does not match its digest")
            rows.append((head.get("WARC-Date", ""), _page(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), head["WARC-Type"], digest,
                         int(head["WARC-Payload-Length"]), _page(head.get("WARC-Refers-To")), path, number))
        if rows:
            yield _captures(rows)

    found = raw.mapInArrow(run, _CAPTURE.removeprefix("url_key string, "))
    found = found.withColumn("url_key", url_key(F.col("url"))).select(*[c.split()[0] for c in _CAPTURE.split(", ")])
    return found.sortWithinPartitions("file", "url_key", "ts", "page_id", "record")


def _page(urn: str | None) -> int | None:
    name = (urn or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(name) if name.lstrip("-").isdigit() else None


def _captures(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in _CAPTURE.split(", ")[1:]]
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


class LoserTree:
    """Merge of k sorted sequences: each inner node keeps the loser of its match, the root's winner is next.

    One step replays the winner's path, log2(k) comparisons."""

    def __init__(self, runs: Sequence[Iterable]):
        self.runs = [iter(r) for r in runs]
        self.heads = [next(r, None) for r in self.runs]
        k = len(self.runs)
        self.losers = [-1] * max(k, 1)
        for i in range(k):
            self._play(i)

    def _beats(self, a: int, b: int) -> bool:
        """Whether run a's head goes before run b's; ended runs go last, ties to the smaller number."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return x < y or (x == y and a < b)

    def _play(self, winner: int) -> None:
        node = (winner + len(self.runs)) // 2
        while node > 0:
            held = self.losers[node]
            if held < 0:  # first to arrive waits here for its opponent
                self.losers[node] = winner
                return
            if self._beats(held, winner):
                self.losers[node], winner = winner, held
            node //= 2
        self.losers[0] = winner

    def __iter__(self):
        while self.runs:
            winner = self.losers[0]
            head = self.heads[winner]
            if head is None:
                return
            yield head
            self.heads[winner] = next(self.runs[winner], None)
            self._replay(winner)

    def _replay(self, winner: int) -> None:
        node = (winner + len(self.runs)) // 2
        while node > 0:
            if self._beats(self.losers[node], winner):
                self.losers[node], winner = winner, self.losers[node]
            node //= 2
        self.losers[0] = winner


def merge_runs(runs: DataFrame) -> DataFrame:
    """All captures in global order of (url_key, ts, page_id), with ``place``: the range's number and the place in it.

    ``runs`` has one sorted run per file. A range holds about
    ``CAPTURES_PER_RANGE`` captures whatever their keys are, since equal
    URLs are told apart by time and page; the runs' parts of a range are
    merged by a loser tree. Nulls come first."""
    n = max(int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")), runs.count() // CAPTURES_PER_RANGE)
    order = ["url_key", "ts", "page_id"]
    dealt = runs.repartitionByRange(n, *order).sortWithinPartitions("file", *order, "record")
    fields = [c.split()[0] for c in _CAPTURE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tables = [pa.Table.from_batches([b]) for b in batches]
        if not tables:
            return
        part, table = TaskContext.get().partitionId(), pa.concat_tables(tables)
        parts: dict[str, list[tuple]] = {}
        keys = zip(*[table.column(c).to_pylist() for c in ("url_key", "ts", "page_id", "file")])
        for i, (key, ts, page, file) in enumerate(keys):
            parts.setdefault(file, []).append((key, ts, page is not None, page or 0, i))
        merged = table.take(pa.array([x[-1] for x in LoserTree(list(parts.values()))], pa.int64())).combine_chunks()
        place = pa.array(range(part << 32, (part << 32) + len(merged)), pa.int64())
        yield from merged.append_column("place", place).to_batches(10_000)

    return dealt.select(*fields).mapInArrow(run, f"{_CAPTURE}, place bigint")


def capture_index(pages: DataFrame, **names) -> DataFrame:
    """Write the archives of ``pages``, read them back and merge their captures. See ``write_archives`` for the rows."""
    spark = pages.sparkSession
    runs = written(read_archives(spark, write_archives(pages, **names)), "capture-runs")
    return merge_runs(runs)
