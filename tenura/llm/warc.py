"""WARC archives: a writer that stores equal payloads once, and a splittable reader.

An archive is a folder of files of gzip members, one record each, as Spark's text writer lays
them down. A member's last byte is the top byte of its length, 0 below 16 MB, so the members
end in the writer's separator by themselves; a longer record is followed by an empty member.
Files must not be named ``.gz``, or Spark would inflate them as a whole.

To read, tasks scan byte ranges for the gzip magic. What follows a magic is a record only if it
inflates to a WARC header; otherwise the bytes belong to the record before. A task owns the
records that start inside its range. A record that a false magic cuts at the end of a range is
put together afterwards from the parts that the ranges report.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.llm.storage import stored

MAGIC = b"\x1f\x8b\x08"
EMPTY_MEMBER = bytes.fromhex("1f8b08 00 00000000 00 ff 0300 00000000 00000000")
PAGE = "urn:page:"
RECORD = ("page_id string, url string, record_type string, refers_to string, "
          "payload_bytes bigint, payload_digest string, payload binary, record_id string, refers_to_id string")


def _record(page_id, url, payload: bytes, digest: str, n_bytes: int, refers_to) -> bytes:
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
            f"Content-Length: {n_bytes}\r\n\r\n").encode()
    lines = ["WARC/1.0", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <{PAGE}{'' if page_id is None else page_id}>",
             "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}",
             "Content-Type: application/http; msgtype=response"]
    if url is not None:
        safe = "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url)
        lines.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        payload = b""
        lines += [f"WARC-Refers-To: <{PAGE}{refers_to}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"]
    lines.append(f"Content-Length: {len(http) + len(payload)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"


def _member(record: bytes, level: int) -> bytes:
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    member = pack.compress(record) + pack.flush()
    return member if member[-1] == 0 else member + EMPTY_MEMBER


def _text(head: bytes) -> str:
    try:
        return head.decode()
    except UnicodeDecodeError:
        return head.decode("latin-1")


def _fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name, the first of each; a line that begins with white space goes on with the one before."""
    lines: list[str] = []
    for line in _text(head).replace("\r\n", "\n").split("\n")[1:]:
        if line[:1] in (" ", "\t") and lines:
            lines[-1] += " " + line.strip()
        else:
            lines.append(line)
    fields: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if colon:
            fields.setdefault(name.strip().lower(), value.strip())
    return fields


def _dechunked(body: bytes) -> bytes:
    """The body of a chunked transfer; one that isn't chunked properly stays as it is."""
    out, at = [], 0
    while at < len(body):
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            size = -1
        if size < 0:
            return body
        if size == 0:
            break
        out.append(body[end + 2:end + 2 + size])
        at = end + 2 + size + 2
    return b"".join(out)


def _number(text: str | None) -> int | None:
    return int(text) if text and text.isascii() and text.isdigit() else None


def _parse(data: bytes) -> tuple:
    """A row of RECORD."""
    head, _, block = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    size = _number(fields.get("content-length"))
    block = block[:size] if size is not None else block.removesuffix(b"\r\n\r\n")
    kind = fields.get("warc-type")
    digest = fields.get("warc-payload-digest")
    digest = digest.removeprefix("sha256:") if digest else None
    payload, n_bytes = block, None
    if kind in ("response", "revisit") and block.startswith(b"HTTP/"):
        http, _, payload = block.partition(b"\r\n\r\n")
        http = _fields(http)
        n_bytes = _number(http.get("content-length"))
        if http.get("transfer-encoding", "").lower().split(",")[-1].strip() == "chunked":
            payload = _dechunked(payload)
    if kind == "revisit":
        payload = None
    else:
        n_bytes, digest = len(payload), hashlib.sha256(payload).hexdigest()
    ids = [fields[f].removeprefix("<").removesuffix(">") if f in fields else None for f in ("warc-record-id", "warc-refers-to")]
    own = [i[len(PAGE):] or None if i and i.startswith(PAGE) else None for i in ids]
    return own[0], fields.get("warc-target-uri"), kind, own[1], n_bytes, digest, payload, *ids


def _starts_record(chunk: bytes) -> bool | None:
    """Whether a magic and ``chunk`` begin a member that holds a WARC record, or nothing; None: too short to tell."""
    if chunk == EMPTY_MEMBER[3:]:
        return True
    try:
        begin = zlib.decompressobj(31).decompress(MAGIC + chunk[:1 << 16], 5)
    except zlib.error:
        return False
    return True if begin == b"WARC/" else None if b"WARC/".startswith(begin) else False


def _members(pieces: Iterable[bytes]) -> Iterator[tuple[bool, bytes]]:
    """The members in bytes that begin with one: (True, what it inflates to), at last (False, the bytes of a cut one)."""
    raw, unpack, data = [], zlib.decompressobj(31), []
    for piece in pieces:
        while piece:
            raw.append(piece)
            try:
                data.append(unpack.decompress(piece))
            except zlib.error as broken:
                raise ValueError(f"a record does not inflate: {broken}") from broken
            piece = b""
            if unpack.eof:
                piece = unpack.unused_data
                yield True, b"".join(data)
                raw, unpack, data = [], zlib.decompressobj(31), []
    if raw:
        yield False, b"".join(raw)


def _range(chunks: Iterable[bytes]) -> Iterator[tuple[str, bytes]]:
    """The parts of a byte range's chunks, each of which stood behind a magic: ``tail`` (of a record that
    started before), then each ``record``, inflated, and at most one ``open`` record, cut at the end.

    The first chunk that begins a record is found by its header; from there on the members follow one another.
    """
    chunks = iter(chunks)
    seen: list[bytes] = []
    unsure: list[int] = []
    begin = None
    for chunk in chunks:
        seen.append(MAGIC + chunk)
        told = {i: _starts_record(b"".join(seen[i:])[len(MAGIC):]) for i in (*unsure, len(seen) - 1)}
        unsure = [i for i, t in told.items() if t is None]
        begin = next((i for i, t in told.items() if t), None)
        if begin is not None:
            break
    if seen[:begin]:
        yield "tail", b"".join(seen[:begin])
    if begin is not None:
        for whole, data in _members(chain(seen[begin:], (MAGIC + c for c in chunks))):
            if data:
                yield "record" if whole else "open", data


def plan_records(pages: DataFrame, page_id="page_id", url="url", html="html", least=100) -> DataFrame:
    """``page_id``, ``url``, ``html``, ``digest``, ``n_bytes``, ``refers_to`` (null: a response) for each row."""
    body = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"),
                        F.col(f"`{html}`").alias("html"), F.sha2(body, 256).alias("digest"),
                        F.octet_length(body).cast("bigint").alias("n_bytes"))
    large = F.col("n_bytes") >= least
    first = rows.where(large).groupBy(F.col("digest").alias("same")).agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = rows.join(first, large & (F.col("digest") == F.col("same")), "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.withColumn("refers_to", F.when(again, F.col("first"))).drop("same", "first")


def write(pages: DataFrame, path: str, page_id="page_id", url="url", html="html", least=100,
          level: int = 6) -> None:
    """Write a record for each row of ``pages`` below ``path``.

    Of the rows with equal html of at least ``least`` bytes, those with the smallest page_id are responses
    and the others revisit it; shorter ones are all responses. Null html is an empty payload, a null url is
    left out, a null page_id has an empty name and never is the smallest (unless all are null: then all
    are responses). Repeated rows are repeated records. Other columns are not looked at.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, texts, digests, sizes, refers = (batch.column(c).to_pylist() for c in (
                "page_id", "url", "html", "digest", "n_bytes", "refers_to"))
            members = [_member(_record(i, u, (t or "").encode(), d, n, r), level)[:-1]
                       for i, u, t, d, n, r in zip(ids, urls, texts, digests, sizes, refers)]
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["value"])

    packed = plan_records(pages, page_id, url, html, least).mapInArrow(pack, "value binary")
    packed.select(F.col("value").cast("string")).write.option("lineSep", "\0").text(path)


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records below ``path``: ``page_id`` (string), ``url``, ``record_type``, ``refers_to`` (string),
    ``payload_bytes`` and ``payload_digest`` (of the full payload, for revisits as recorded), ``payload`` (null for
    revisits, or without ``with_payload``), ``record_id`` and ``refers_to_id`` as written.

    Archives of other writers are read too, records of all types. A response's payload is its HTTP body, put together if it was
    sent in chunks; other records' is their whole block. The bare digest is SHA-256, a revisit's of another kind stands
    with its name (``sha1:...``). ``page_id`` and ``refers_to`` are null for ids that ``write`` did not make. Header names are
    in any case, values may go on over lines, and headers that aren't UTF-8 are read as Latin-1.
    An archive without records gives an empty table. Records that do not inflate are errors.
    """
    chunks = spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
    chunks = chunks.select(F.col("value").cast("binary").alias("value"),
                           F.col("_metadata.file_path").alias("file"),
                           F.col("_metadata.file_block_start").alias("at"))

    def rows(parts: list[tuple]) -> pa.RecordBatch:
        """Of (kind, file, at, data)."""
        out = [(*((None,) * 9), k, f, a, d) if k != "record" else
               (*(x := _parse(d))[:6], x[6] if with_payload else None, *x[7:], k, None, None, None)
               for k, f, a, d in parts]
        kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()] + [pa.string()] * 4 + [pa.int64(), pa.binary()]
        names = [x.split()[0] for x in RECORD.split(", ")] + ["kind", "file", "at", "part"]
        columns = list(zip(*out)) if out else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for batch in batches:
                yield from zip(batch.column("file").to_pylist(), batch.column("at").to_pylist(),
                               batch.column("value").to_pylist())

        stream, ahead = each(), []

        def one_range(key):
            while ahead and ahead[0][:2] == key:
                chunk = ahead.pop()[2]
                nxt = next(stream, None)
                if nxt is not None:
                    ahead.append(nxt)
                if chunk or key[1]:  # a file starts with the nothing before its first magic
                    yield chunk

        first = next(stream, None)
        if first is not None:
            ahead.append(first)
        held, size = [], 0
        while ahead:
            key = ahead[0][:2]
            for kind, data in _range(one_range(key)):
                held.append((kind, *key, data))
                size += len(data)
                if size > 4 << 20:
                    yield rows(held)
                    held, size = [], 0
        yield rows(held)

    found = chunks.mapInArrow(scan, RECORD + ", kind string, file string, at bigint, part binary")
    found = stored(found)  # the bytes are scanned once
    whole = found.where("kind = 'record'").drop("kind", "file", "at", "part")

    def stitch(parts: pd.DataFrame) -> pd.DataFrame:
        """The records of a file that were cut between ranges."""
        parts = parts.sort_values(["at", "kind"], ascending=[True, False])  # a range's tail, then its open record
        out = []
        for whole, data in _members(parts["part"]):
            if not whole:
                raise ValueError("the last record of a file is cut")
            out += [_parse(data)] if data else []
        made = pd.DataFrame(out, columns=[x.split()[0] for x in RECORD.split(", ")])
        if not with_payload:
            made["payload"] = None
        return made

    cut = found.where("kind <> 'record'").select("file", "at", "kind", "part")
    return whole.unionByName(cut.groupBy("file").applyInPandas(stitch, RECORD))
