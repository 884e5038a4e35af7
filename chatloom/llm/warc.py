"""WARC archives of pages, and their index merged into global capture order.

Writing.  Each page becomes one record: ``response`` with the payload behind an
HTTP head, or ``revisit`` without it when an equal payload of at least
``MIN_REVISIT`` bytes belongs to a page of smaller id.  Payloads are matched by
digest: the least id per digest is found by partial aggregation, only digests
that occur twice are joined back.  Records end in CR LF CR LF, which is the line
separator of Spark's text sink, so archives are written through its commit
protocol to any file system, gzip-compressed.

Archives hold at most ``RECORDS`` records, and so many fewer that their payloads can't
exceed ``ARCHIVE`` bytes, as the longest payload shows; a longer payload is an archive alone.

Reading.  Files are read whole and parsed record by
record while decompressing; a payload's digest and length come from its bytes, a
revisit's from its header.

Index.  The captures of one archive, sorted by (URL key, time, id), are a run, and
runs are written to the shared folder.  They are dealt into ranges of that order,
the id included, so one much captured address is spread too; the number of ranges
grows with the captures, about ``RANGE`` in each.  Within a range a loser tree merges
the runs' parts as they arrive: nothing is sorted again, rows stay in Arrow, and of
each run only ``BUFFER`` keys are Python objects at a time.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.shared import cut, partitions, scratch

MIN_REVISIT = 0
RECORDS = 1000
ARCHIVE = 1 << 29
#: Captures that a range holds, about, and keys read ahead from each run of it.
RANGE = 100_000
BUFFER = 64
#: RFC 4648's alphabet, and the end of a record.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n\r\n"
URL = re.compile(r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]+)?([^#]*)")


def base32_of_hex(digest: Column) -> Column:
    """Base32 of a digest in hex of 40 digits: five hex digits give four letters."""
    out = []
    for at in range(1, 41, 5):
        bits = F.conv(F.substring(digest, at, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(BASE32), F.shiftright(bits, right).bitwiseAND(F.lit(31)) + 1, 1) for right in (15, 10, 5, 0)]
    return F.concat(*out)


def url_key(url: str) -> str:
    """Host labels from the top down, then path and query: captures of a site sort together."""
    found = URL.match(url)
    if not found:
        return url
    return ",".join(reversed(found[1].lower().split("."))) + ")" + (found[2] or "/")


def write_warc(pages: DataFrame, captured: Column, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit: int = MIN_REVISIT) -> str:
    """Writes the archives and returns their folder.

    ``captured`` is each page's capture time.  Null payloads are empty; a null
    address is left out of the record, null ids are written as an empty name;
    control characters and blanks in an address are percent-encoded.  Rows that
    repeat the response's id are responses too.  A long payload takes memory in
    proportion to its length; an empty table gives a folder without records.
    """
    spark = pages.sparkSession
    payload = F.coalesce(pages[payload_col].cast("string"), F.lit(""))
    rows = pages.select(pages[id_col].alias("_id"), pages[url_col].alias("_url"), payload.alias("_payload"), captured.alias("_at"))
    rows = rows.select("*", F.sha1(F.col("_payload").cast("binary")).alias("_sha"), F.octet_length("_payload").alias("_n"))
    firsts = rows.filter(F.col("_n") >= min_revisit).groupBy("_sha").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    firsts = cut(firsts.select(F.col("_sha").alias("_same"), "_first"), "warc-firsts")
    together = min(RECORDS, max(1, ARCHIVE // max(1, rows.agg(F.max("_n")).first()[0] or 0)))
    rows = rows.join(firsts, rows["_sha"] == firsts["_same"], "left")

    revisit = F.col("_same").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_first"))
    encoded = F.col("_url")
    for code in [*range(33), 127]:
        encoded = F.replace(encoded, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("_n").cast("string"), F.lit(END))
    block = F.concat(head, F.when(revisit, F.lit("")).otherwise(F.col("_payload")))
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("_id").cast("string"), F.lit("")), F.lit(">"))
    fields = [
        F.when(revisit, F.lit("WARC-Type: revisit")).otherwise(F.lit("WARC-Type: response")),
        F.concat(F.lit("WARC-Record-ID: "), name),
        F.date_format("_at", "'WARC-Date: 'yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.concat(F.lit("WARC-Target-URI: "), encoded),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32_of_hex(F.col("_sha"))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("_first").cast("string"), F.lit(">\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        F.concat(F.lit("X-Payload-Length: "), F.col("_n").cast("string")),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    record = F.concat(F.concat_ws("\r\n", F.lit("WARC/1.1"), *fields), F.lit(END), block)
    path = scratch(spark, "warc-archives")
    rows.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", together).text(path)
    return path


def records(stream: io.BufferedIOBase) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset in the uncompressed archive, header fields, block) of each record."""
    at = 0
    while True:
        start, fields = at, {}
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {start}")
        at += len(line)
        while (line := stream.readline()) not in (b"\r\n", b""):
            at += len(line)
            key, _, value = line.decode().rstrip("\r\n").partition(": ")
            fields[key.lower()] = value
        block = stream.read(int(fields["content-length"]))
        if len(block) < int(fields["content-length"]) or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"the record at byte {start} is cut short")
        at += len(line) + len(block) + 4
        yield start, fields, block


CAPTURES = "url_key string, captured_at string, id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, archive string, offset bigint"


def read_warc(spark, path: str) -> DataFrame:
    """The captures of all archives below ``path``, each archive's sorted by URL key, time and id.

    ``offset`` counts uncompressed bytes.  An archive that is cut short raises.
    """

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                run = []
                with gzip.open(pa.BufferReader(content.as_buffer())) as stream:
                    for offset, fields, block in records(io.BufferedReader(stream, 1 << 20)):
                        kind, digest, n = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:"), int(fields["x-payload-length"])
                        if kind == "response":
                            payload = memoryview(block)[block.index(b"\r\n\r\n") + 4 :]
                            digest, n = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
                        of = lambda key, f=fields: f[key][len("<urn:page:") : -1] or None if key in f else None
                        run.append((url_key(fields.get("warc-target-uri", "")), fields.get("warc-date", ""), of("warc-record-id"), n, digest, kind, of("warc-refers-to"), name.rsplit("/", 1)[-1], offset))
                run.sort(key=order)
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in run], kind) for i, kind in enumerate(KINDS)], names=NAMES)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(parsed, CAPTURES)


NAMES = [f.split()[0] for f in CAPTURES.split(", ")]
KINDS = [pa.int64() if f.endswith("bigint") else pa.string() for f in CAPTURES.split(", ")]


def order(row: tuple) -> tuple:
    """Index order: URL key, time, id (null first, then as text), offset."""
    return row[0], row[1], row[2] or "", row[7], row[8]


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, so a step replays one path to the root."""

    def __init__(self, runs: list[Iterator[tuple]], key=order):
        self.runs, self.key = [iter(r) for r in runs], key
        self.heads: list[tuple | None] = [next(r, None) for r in self.runs]
        self.keys = [None if h is None else key(h) for h in self.heads]
        self.losers = [-1] * max(1, len(self.runs))
        self.winner = -1
        for leaf in range(len(self.runs)):
            self.replay(leaf)

    def beats(self, a: int, b: int) -> bool:
        """Whether run a's head comes before run b's; ended runs come last, ties go to the earlier run."""
        x, y = self.keys[a], self.keys[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def replay(self, run: int) -> None:
        node = (run + len(self.runs)) // 2
        while node:
            other = self.losers[node]
            if other < 0:  # while the tree is being built, the first to arrive waits
                self.losers[node] = run
                return
            if self.beats(other, run):
                self.losers[node], run = run, other
            node //= 2
        self.winner = run

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and self.heads[self.winner] is not None:
            run = self.winner
            yield self.heads[run]
            self.heads[run] = next(self.runs[run], None)
            self.keys[run] = None if self.heads[run] is None else self.key(self.heads[run])
            self.replay(run)


def ascending(table: pa.Table) -> list[tuple[int, int]]:
    """The stretches (from, to) of rows in index order: one run's part each, or several where they happen to follow on.

    A part that the shuffle brings in pieces out of turn is several stretches, so the merge never relies on how rows travel.
    """
    ends, last, n = [0], None, 0
    for batch in table.to_batches(max_chunksize=4096):
        for key in keyed(batch):
            if last is not None and key < last:
                ends.append(n)
            last, n = key, n + 1
    return [(at, to) for at, to in zip(ends, [*ends[1:], n], strict=True) if to > at]


def keyed(rows: pa.Table | pa.RecordBatch) -> Iterator[tuple]:
    """``order`` of each row."""
    url, at, name, archive, offset = (rows.column(c).to_pylist() for c in ("url_key", "captured_at", "id", "archive", "offset"))
    return zip(url, at, [i or "" for i in name], archive, offset, strict=True)


def ahead(table: pa.Table, at: int, to: int) -> Iterator[tuple[tuple, int]]:
    """(key, row number) of rows ``at`` to ``to``, ``BUFFER`` of them read at a time."""
    for start in range(at, to, BUFFER):
        yield from zip(keyed(table.slice(start, min(BUFFER, to - start))), range(start, to), strict=False)


def merge_runs(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """The rows in index order, merged from the table's ascending stretches."""
    table = table.combine_chunks()
    rows: list[int] = []
    for _, row in LoserTree([ahead(table, at, to) for at, to in ascending(table)], key=lambda head: head[0]):
        rows.append(row)
        if len(rows) == 10_000:
            yield from table.take(rows).to_batches()
            rows = []
    if rows:
        yield from table.take(rows).to_batches()


def merge_index(captures: DataFrame) -> DataFrame:
    """All captures in global order: partitions are consecutive ranges, each merged from its archives' runs."""
    spark = captures.sparkSession
    captures = cut(captures, "warc-runs")
    ranges = max(partitions(spark), -(-captures.count() // RANGE))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            yield from merge_runs(pa.Table.from_batches(held))

    dealt = captures.repartitionByRange(ranges, "url_key", "captured_at", F.coalesce("id", F.lit("")), "archive", "offset")
    return dealt.mapInArrow(merged, CAPTURES)


def warc_index(pages: DataFrame, captured: Column, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Writes the pages as archives, reads those back, and merges their index.

    One row per input row: id, payload_bytes, payload_digest, record_type,
    refers_to, url_key, captured_at, archive, offset, in capture order.  Digest and
    length are of the full payload for revisits too.  An empty table gives an
    empty index; other columns are ignored.
    """
    spark = pages.sparkSession
    kind = pages.schema[id_col].dataType
    index = merge_index(read_warc(spark, write_warc(pages, captured, id_col, url_col, payload_col, min_revisit)))
    return index.select(F.col("id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"), "url_key", "captured_at", "archive", "offset")
