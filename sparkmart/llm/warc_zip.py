"""WARC records in ZIP archives, read by ranges without extraction.

An archive holds two members, both stored uncompressed: ``archive/data.warc.gz`` (each record a gzip
member of its own, as WARC files have it) and ``indexes/index.cdxj`` (one line for each record with
its place in the data). Sizes and places beyond 32 bits go to ZIP64 fields. The reader finds the end
record, follows the ZIP64 locator where there is one, parses the central directory, resolves the
local headers and then reads the index and single records by range.

Of records with equal payloads of at least ``least`` bytes, the one with the largest page_id is a
response, the others are revisits of it; smaller payloads are always responses. Equal payloads are
found by their SHA-1 through a grouped count with map-side combine; only groups of two or more are
joined back.

NULL html is empty; a NULL page_id is smaller than any other and is written as an empty field; rows
repeated with the largest page_id are all responses; an empty table gives no archive. Further
columns are ignored. The folder must be one that pyarrow can open and all executors share.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import zlib
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import shared

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
ARCHIVE_BYTES = 16 << 20
TASK_ARCHIVES = 2  # archives that one task reads back
_LOCAL = struct.Struct("<4sHHHHHIIIHH")
_ENTRY = struct.Struct("<4sHHHHHHIIIHHHHHII")
_END = struct.Struct("<4sHHHHIIH")
_END64 = struct.Struct("<4sQHHIIQQQQ")
_LOCATOR = struct.Struct("<4sIQI")
_FULL = 0xFFFFFFFF
# Fixed value: a date for all archives, so that a repeated task writes the same bytes.
DATE = "2024-01-01T00:00:00Z"
_DOS_DATE = (2024 - 1980) << 9 | 1 << 5 | 1


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def zip_stored(members: list[tuple[str, list[bytes]]], zip64: bool = False) -> bytes:
    """A ZIP of stored members; ``zip64`` writes the wide fields even where they aren't needed."""
    out: list[bytes] = []
    at, directory = 0, []
    for name, parts in members:
        raw = name.encode()
        size, check = sum(map(len, parts)), 0
        for part in parts:
            check = zlib.crc32(part, check)
        wide = zip64 or size >= _FULL or at >= _FULL
        version = 45 if wide else 20
        extra = struct.pack("<HHQQ", 1, 16, size, size) if wide else b""
        short = _FULL if wide else size
        head = _LOCAL.pack(b"PK\3\4", version, 0x800, 0, 0, _DOS_DATE, check, short, short, len(raw), len(extra))
        more = struct.pack("<HHQQQ", 1, 24, size, size, at) if wide else b""
        place = _FULL if wide else at
        directory.append(
            _ENTRY.pack(b"PK\1\2", version, version, 0x800, 0, 0, _DOS_DATE, check, short, short, len(raw), len(more), 0, 0, 0, 0, place)
            + raw + more
        )
        out += [head, raw, extra, *parts]
        at += len(head) + len(raw) + len(extra) + size
    listing = b"".join(directory)
    n, wide = len(members), zip64 or at >= _FULL
    out.append(listing)
    if wide:
        out.append(_END64.pack(b"PK\6\6", _END64.size - 12, 45, 45, 0, 0, n, n, len(listing), at))
        out.append(_LOCATOR.pack(b"PK\6\7", 0, at + len(listing), 1))
    out.append(_END.pack(b"PK\5\6", 0, 0, 0xFFFF if wide else n, 0xFFFF if wide else n, _FULL if wide else len(listing), _FULL if wide else at, 0))
    return b"".join(out)


class StoredZip:
    """Directory of a ZIP and range reads inside its stored members."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        tail = file.read_at(min(size, 65557), max(0, size - 65557))
        found = tail.rfind(b"PK\5\6")
        # A comment may hold the same letters; the end record's own comment reaches the file's end.
        while found >= 0 and found + _END.size + int.from_bytes(tail[found + 20 : found + 22], "little") != len(tail):
            found = tail.rfind(b"PK\5\6", 0, found + 3)
        if found < 0:
            raise ValueError("no end of central directory")
        _, _, _, _, n, length, at, _ = _END.unpack_from(tail, found)
        back = size - len(tail) + found - _LOCATOR.size
        if back >= 0 and (locator := file.read_at(_LOCATOR.size, back))[:4] == b"PK\6\7":
            _, _, place, _ = _LOCATOR.unpack(locator)
            *_, n, length, at = _END64.unpack(file.read_at(_END64.size, place))
        listing = file.read_at(length, at)
        self.members: dict[str, tuple[int, int, int]] = {}
        pos = 0
        for _ in range(n):
            entry = _ENTRY.unpack_from(listing, pos)
            if entry[0] != b"PK\1\2":
                raise ValueError("broken central directory")
            kind, check, packed, plain = entry[4], entry[7], entry[8], entry[9]
            names, extras, notes, place = entry[10], entry[11], entry[12], entry[16]
            pos += _ENTRY.size
            name = listing[pos : pos + names].decode()
            packed, plain, place = self._wide(listing[pos + names : pos + names + extras], packed, plain, place)
            pos += names + extras + notes
            if kind != 0 or packed != plain:
                raise ValueError(f"{name}: only stored members can be read by range")
            self.members[name] = (place, plain, check)
        self.starts: dict[str, int] = {}

    @staticmethod
    def _wide(extra: bytes, packed: int, plain: int, place: int) -> tuple[int, int, int]:
        """Sizes and place, from the ZIP64 field where the short fields are full."""
        pos = 0
        while pos + 4 <= len(extra):
            tag, length = struct.unpack_from("<HH", extra, pos)
            if tag == 1:
                values = iter(struct.unpack_from(f"<{length // 8}Q", extra, pos + 4))
                plain = next(values) if plain == _FULL else plain
                packed = next(values) if packed == _FULL else packed
                place = next(values) if place == _FULL else place
            pos += 4 + length
        return packed, plain, place

    def read(self, name: str, start: int = 0, length: int | None = None) -> bytes:
        place, size, _ = self.members[name]
        if name not in self.starts:
            head = _LOCAL.unpack(self.file.read_at(_LOCAL.size, place))
            if head[0] != b"PK\3\4":
                raise ValueError(f"{name}: no local header")
            self.starts[name] = place + _LOCAL.size + head[9] + head[10]
        length = size - start if length is None else length
        if start < 0 or start + length > size:
            raise ValueError(f"{name}: range outside the member")
        return self.file.read_at(length, self.starts[name] + start)


def record(page_id, url: str, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record as a gzip member. A revisit carries the digest and length of its payload."""
    revisit = refers_to is not None
    body = b"" if revisit else payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", " ".join(url.split())),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Payload-Length", str(len(payload))),
        ("Content-Length", str(len(body))),
    ]
    if revisit:
        fields += [
            ("WARC-Refers-To", f"<urn:page:{refers_to}>"),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(head.encode() + body + b"\r\n\r\n") + pack.flush()


def parse(blob: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record."""
    raw = zlib.decompress(blob, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    return fields, rest[: int(fields["Content-Length"])]


def link(pages: DataFrame, folder: str | None = None, least: int = 0) -> DataFrame:
    """Pages with ``refers_to``: the page whose response a revisit points to, NULL for responses.

    With a ``folder`` the list of repeated payloads is written first: both sides of the join are then plain scans, so that
    adaptive execution splits a payload that very many pages share.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        html.alias("payload"),
        F.sha1(html).alias("digest"),
    )
    big = F.octet_length("payload") >= least
    groups = rows.where(big).groupBy("digest").agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n"))
    groups = groups.where("n > 1").select("digest", "top")
    groups = shared.staged(groups, folder, "repeated") if folder else groups
    joined = rows.join(groups, "digest", "left")
    differs = big & ~F.col("page_id").eqNullSafe(F.col("top"))
    return joined.select("page_id", "url", "payload", F.when(differs, F.col("top")).alias("refers_to"))


def write(linked: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write archives of about ``archive_bytes`` below ``folder``; one row for each."""

    def task(batches) -> Iterator:
        import pyarrow as pa

        part, made = TaskContext.get().partitionId(), 0
        records: list[bytes] = []
        lines: list[str] = []
        at = 0

        def flush():
            nonlocal made, at
            uri = f"{folder}/pages-{part:06d}-{made:05d}.zip"
            index = ["".join(f"{line}\n" for line in lines).encode()]
            shared.put(uri, zip_stored([(DATA, records), (INDEX, index)]))
            row = pa.RecordBatch.from_pydict({"uri": [uri], "records": [len(records)]})
            records.clear()
            lines.clear()
            made, at = made + 1, 0
            return row

        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to"))):
                digest = digest32(payload)
                blob = record(page_id, url, payload, digest, refers_to)
                lines.append(json.dumps({"page": page_id, "offset": at, "length": len(blob), "digest": digest}))
                records.append(blob)
                at += len(blob)
                if at >= archive_bytes:
                    yield flush()
        if records:
            yield flush()

    return linked.mapInArrow(task, "uri string, records long")


def read(archives: DataFrame, window: int = 1 << 20, with_payload: bool = False) -> DataFrame:
    """All records of the archives; the index says where each lies, neighbours are read at once."""
    import pyarrow as pa

    schema = pa.schema(
        [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
         ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())]
        + [("payload", pa.binary())] * with_payload
    )

    def page(urn: str | None) -> int | None:
        number = (urn or "<urn:page:>")[len("<urn:page:") : -1]
        return int(number) if number else None

    def one(blob: bytes, line: dict) -> tuple:
        fields, body = parse(blob)
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = fields["WARC-Type"]
        if kind == "response" and digest32(body) != digest or digest != line["digest"]:
            raise ValueError(f"{fields['WARC-Record-ID']}: digest does not match")
        length = len(body) if kind == "response" else int(fields["WARC-Payload-Length"])
        row = (page(fields["WARC-Record-ID"]), length, digest, kind, page(fields.get("WARC-Refers-To")), fields["WARC-Target-URI"])
        return row + (body if kind == "response" else None,) * with_payload

    def task(batches) -> Iterator:
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                system, path = shared.filesystem(uri)
                with system.open_input_file(path) as file:
                    archive = StoredZip(file)
                    lines = [json.loads(x) for x in archive.read(INDEX).decode().splitlines()]
                    i = 0
                    while i < len(lines):
                        first, j = lines[i]["offset"], i + 1
                        while j < len(lines) and lines[j]["offset"] + lines[j]["length"] - first <= window:
                            j += 1
                        blob = archive.read(DATA, first, lines[j - 1]["offset"] + lines[j - 1]["length"] - first)
                        rows = [one(blob[x["offset"] - first :][: x["length"]], x) for x in lines[i:j]]
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        i = j

    declared = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
    # A number of tasks is given, as adaptive execution would put the few short rows into one.
    tasks = max(1, -(-archives.count() // TASK_ARCHIVES))
    return archives.repartition(tasks).mapInArrow(task, declared + ", payload binary" * with_payload)


def op10_warc_zip(spark, sf_dir: str) -> DataFrame:
    """Write all pages to archives and return what reading the archives back gives."""
    folder = shared.workspace(spark, "warc")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return read(shared.staged(write(link(pages, folder), folder), folder, "manifest")).drop("url")


# Bits of a SHA-1 in groups of five as base32 letters, from hexadecimal digits.
OP10_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
  SELECT hex,
    list_aggregate(list_transform(range(0, 4), lambda k: list_aggregate(list_transform(range(0, 8), lambda j:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + (((('0x' || substr(hex, 10 * k + 1, 10))::BIGINT) >> (35 - 5 * j)) & 31)::INTEGER, 1)
    ), 'string_agg', '')), 'string_agg', '') AS digest
  FROM (SELECT DISTINCT hex FROM p)
), g AS (SELECT hex, max(page_id) AS top FROM p GROUP BY hex)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM p JOIN d USING (hex) JOIN g USING (hex)
"""
