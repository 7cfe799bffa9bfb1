"""WARC archives: a writer with revisit records, and a reader that can start anywhere in a file.

Writing: one gzip member per record, through Spark's text writer, so files appear by its commit
protocol in any store Spark reaches. That writer puts a separator after each row; here the
separator is an empty gzip member, so a file stays a valid series of members.

Reading: tasks scan byte ranges of the files for the gzip magic; the text reader does it with the
magic as its separator, and gives a candidate to the range it starts in. A candidate is a member
if its gzip header is sound, its data can be inflated and they begin with a WARC header. Compressed
data can hold the magic by chance; then the candidate isn't complete and the next one is no
member, and they are put together again: within a range at once, across ranges by a second step
over these rare pieces. Each chain of pieces, from the range in which a member starts to the next one that holds a
whole member, is a group of its own. Members that stay incomplete or damaged are left out.

Spark's reader would inflate a file whose name ends in ``.gz`` whole, in one task. Ranges of such files are rows, and their
tasks open the file themselves, through Arrow's file systems: they look for the magic in their own range, and read on
behind it for the last record that starts inside. The rules for members are the same.

Very long html makes a long record, which a task holds whole. An empty table gives archives without records, and a
folder of them no rows. Columns of ``pages`` beside page_id, url and html are not read, so they may have any names.

Null html is an empty payload, a null url an empty target. Control characters and spaces of a url are
percent-encoded. Rows with equal payloads and the same, largest page_id are all responses; a row
without page_id has an id without number, and is a response unless an equal payload has one.
"""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfold.llm.common import BATCH_ROWS, map_batches
from docfold.session import materialize

#: Equal payloads of fewer bytes are all written in full.
REVISIT_BYTES = 1000
LEVEL = 6
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"
#: Bytes a task reads at a time, and hands to the unpacker at a time.
BLOCK, STEP = 1 << 20, 1 << 16


def gzip_member(data: bytes, level: int = LEVEL) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


_EMPTY = gzip_member(b"")


def response_ids(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Columns page_id, url, payload, digest (hex), refers_to (null for responses)."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = rows.where(F.octet_length("payload") >= least_bytes)
    # Only payloads that come more than once have to be found again.
    first = large.groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    first = first.where("n > 1").select("digest", "first")
    refers = F.when(F.col("page_id") == F.col("first"), None).otherwise(F.col("first"))
    return rows.join(first, "digest", "left").select(
        "page_id", "url", "payload", "digest", refers.alias("refers_to")
    )


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC record."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
    http = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        + f"Content-Length: {len(payload)}\r\n\r\n".encode()
    )
    block = http if refers_to is not None else http + payload
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _name(page_id),
        "WARC-Date": date,
        "WARC-Target-URI": target,
        "WARC-Payload-Digest": f"sha1:{sha1}",
    }
    if refers_to is not None:
        head |= {"WARC-Refers-To": _name(refers_to), "WARC-Profile": PROFILE}
    head |= {
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.0\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def _name(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def write(
    pages: DataFrame,
    folder: str,
    least_bytes: int = REVISIT_BYTES,
    date: str = DATE,
    level: int = LEVEL,
) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) into ``folder``."""
    schema = T.StructType([T.StructField("member", T.BinaryType())])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            names = ("page_id", "url", "payload", "digest", "refers_to")
            rows = zip(*(batch.column(c).to_pylist() for c in names), strict=True)
            yield {"member": [gzip_member(record(*r, date), level) for r in rows]}

    members = map_batches(response_ids(pages, least_bytes), step, schema)
    # The cast keeps the bytes as they are.
    writer = members.select(F.col("member").cast("string")).write
    writer.option("encoding", "ISO-8859-1").text(folder, lineSep=_EMPTY.decode("latin-1"))


RECORD = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("intact", T.BooleanType()),
        T.StructField("payload", T.BinaryType()),
    ]
)
_PIECE = T.StructType(
    [
        T.StructField("record", RECORD),
        T.StructField("file", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("found", T.BooleanType()),
        T.StructField("before", T.ArrayType(T.BinaryType())),
        T.StructField("after", T.ArrayType(T.BinaryType())),
    ]
)


def member(candidate: bytes, payload: bool = True) -> dict | None | bool:
    """The record of a complete member, None if more bytes are wanted, False if it is no member."""
    if len(candidate) > 3 and candidate[3] & 0xE0:  # reserved flags
        return False
    unpacker = zlib.decompressobj(31)
    try:
        data = unpacker.decompress(candidate)
    except zlib.error:
        return False
    if data[:5] != b"WARC/"[: len(data)]:
        return False
    return (parse(data, payload) or False) if unpacker.eof else None


def parse(data: bytes, payload: bool = True) -> dict | None:
    """Fields of a record; None if it is cut off. ``intact``: its payload has the digest it names."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    if not fields.get("content-length", "").isdigit():
        return None
    block = rest[: (length := int(fields["content-length"]))]
    if len(block) < length:
        return None
    kind, body, full = fields.get("warc-type"), block, None
    if "application/http" in fields.get("content-type", ""):
        http, _, body = block.partition(b"\r\n\r\n")
        if found := re.search(rb"(?im)^content-length:[ \t]*(\d+)", http):
            full = int(found[1])
    named = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    try:
        digest = base64.b32decode(named).hex() if named else None
    except ValueError:
        digest = named.lower()
    if kind != "revisit":
        full, own = len(body), hashlib.sha1(body).hexdigest()
    else:
        own, body = digest, None
    return {
        "record_id": fields.get("warc-record-id"),
        "record_type": kind,
        "date": fields.get("warc-date"),
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
        "payload_digest": own,
        "payload_bytes": full,
        "intact": digest is None or own == digest,
        "payload": body if payload else None,
    }


class _Range:
    """Candidates of one byte range, in order.

    ``open`` may be the start of a member; ``before`` are those before the first complete member, which
    may belong to a member that starts in an earlier range.
    """

    def __init__(self, payload: bool):
        self.payload, self.found, self.before, self.open = payload, False, [], []

    def take(self, candidate: bytes) -> list[dict]:
        """The records that this candidate completes."""
        if not self.found:
            self.before.append(candidate)
        return self._join(candidate)

    def _join(self, candidate: bytes) -> list[dict]:
        self.open.append(candidate)
        record = member(b"".join(self.open), self.payload)
        if record is None:
            return []
        if record:
            if not self.found:
                del self.before[-len(self.open) :]
            self.open, self.found = [], True
            return [record]
        # The first one is no start of a member; the others may be.
        others, self.open = self.open[1:], []
        return [done for c in others for done in self._join(c)]


class _File:
    """A file read in blocks, of which one is held."""

    def __init__(self, uri: str):
        scheme, _, path = uri.partition(":")
        # Names come as they are; addresses need them quoted.
        system, name = fs.FileSystem.from_uri(f"{scheme}:{urllib.parse.quote(path)}")
        self.source, self.at, self.held = system.open_input_file(name), 0, b""

    def _load(self, at: int) -> None:
        self.at, self.held = at, self.source.read_at(BLOCK, at)

    def piece(self, at: int) -> memoryview:
        """Some bytes from a position; none behind the end."""
        if not self.at <= at < self.at + len(self.held):
            self._load(at)
        return memoryview(self.held)[at - self.at : at - self.at + STEP]

    def magic(self, at: int, end: int) -> int | None:
        """The first position of the magic from ``at`` on and before ``end``."""
        while at < end:
            self.piece(at)
            found = self.held.find(MAGIC, at - self.at)
            if found >= 0:
                return self.at + found if self.at + found < end else None
            if self.at + len(self.held) <= at + 2:  # the end of the file
                return None
            at = self.at + len(self.held) - 2
            self._load(at)
        return None

    def member(self, start: int, payload: bool) -> tuple[dict | None, int]:
        """The record of the member at ``start`` and its length in the file; no record if it is no member."""
        unpacker, data, at = zlib.decompressobj(31), bytearray(), start
        while not unpacker.eof:
            piece = self.piece(at)
            if not piece:
                return None, 0
            try:
                data += unpacker.decompress(piece)
            except zlib.error:
                return None, 0
            if data[:5] != b"WARC/"[: len(data)]:
                return None, 0
            at += len(piece)
        return parse(bytes(data), payload), at - len(unpacker.unused_data) - start

    def records(self, start: int, end: int, payload: bool) -> Iterator[dict]:
        """The records that start in a byte range, wherever they end."""
        while (at := self.magic(start, end)) is not None:
            record, length = self.member(at, payload)
            start = at + (length if record else 1)
            if record:
                yield record


def _named_gz(spark: SparkSession, folder: str, payload: bool) -> DataFrame | None:
    """The records of the files whose names end in ``.gz``; null if there are none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    files = files.where("length > 0").select("path", "length")
    if files.isEmpty():
        return None
    size = int(spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("bB"))
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long"))
    ranges = files.select("path", F.explode(starts).alias("start"))
    n = ranges.count()
    # A range is a partition's worth of work.
    ranges = ranges.withColumn("size", F.lit(size)).repartition(min(n, 100_000), "path", "start")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for path, start, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held = []
                for record in _File(path).records(start, start + size, payload):
                    held.append(record)
                    if len(held) == BATCH_ROWS:
                        yield {k: [r[k] for r in held] for k in RECORD.names}
                        held = []
                yield {k: [r[k] for r in held] for k in RECORD.names}

    return map_batches(ranges, step, RECORD)


def read(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """The records of all archives in ``folder``, with the columns of ``RECORD``."""
    named = _named_gz(spark, folder, payload)
    plain = _plain(spark, folder, payload)
    return plain if named is None else plain.unionByName(named)


def _plain(spark: SparkSession, folder: str, payload: bool) -> DataFrame:
    """The records of the files whose names don't end in ``.gz``."""
    chunks = (
        spark.read.option("lineSep", MAGIC.decode("latin-1"))
        .option("encoding", "ISO-8859-1")
        .option("pathGlobFilter", "{*[!z],*[!g]z,*[!.]gz}")
        .text(folder)
        .select(
            F.col("value").cast("binary").alias("value"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
        )
    )

    def rows(records: list[dict], at: list | None = None, state: _Range | None = None) -> dict:
        pieces = [(r, None, None, None, None, None) for r in records]
        if state and (state.before or state.open):
            after = state.open if state.found else []
            pieces.append((None, *at, state.found, state.before, after))
        columns = zip(*pieces, strict=True) if pieces else [[]] * len(_PIECE)
        return dict(zip(_PIECE.names, map(list, columns), strict=True))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        at, state = None, None
        for batch in batches:
            records = []
            names = ("value", "file", "start")
            for value, *place in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if place != at:
                    yield rows([], at, state)
                    at, state = place, _Range(payload)
                    if place[1] == 0:
                        continue  # what stands before the first magic of a file
                records.extend(state.take(MAGIC + value))
            yield rows(records)
        yield rows([], at, state)

    pieces = materialize(map_batches(chunks, step, _PIECE), "warc-read")

    def join_pieces(group: pd.DataFrame) -> pd.DataFrame:
        state, out = _Range(payload), []
        for candidates in group.sort_values("start")["candidates"]:
            for candidate in candidates:
                out += state.take(candidate)
        return pd.DataFrame(out, columns=RECORD.names)

    whole = pieces.where("record IS NOT NULL").select("record.*")
    cut = pieces.where("record IS NULL").drop("record")
    # A chain starts in a range with a whole member and ends in the next such one. Numbering them takes a small row
    # per range; the pieces themselves meet by chain only.
    ends = F.sum(F.col("found").cast("int")).over(W.partitionBy("file").orderBy("start"))
    numbers = cut.select("file", "start", "found").withColumn("chain", ends).drop("found")
    sides = F.array(
        F.struct((F.col("chain") - F.col("found").cast("int")).alias("chain"), F.col("before").alias("candidates")),
        F.struct("chain", F.col("after").alias("candidates")),
    )
    chained = cut.join(numbers, ["file", "start"]).select("file", "start", F.inline(sides))
    chained = chained.where(F.size("candidates") > 0)
    return whole.unionByName(chained.groupBy("file", "chain").applyInPandas(join_pieces, RECORD))
