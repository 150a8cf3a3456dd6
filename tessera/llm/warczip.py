"""Operator 2: WARC archives inside ZIP packages, read by range without extraction.

Writing: one package per ``PACKAGE_BYTES`` of records, in the shared folder.  A
package holds two stored members, ``archive/data.warc.gz`` (each record its own
gzip member) and ``indexes/index.cdx`` (a line per record: id, offset, length).  A
payload that other records share is written once, as the response with the
largest id; the others are revisit records that refer to it.

Reading (any package of stored ``archive/X.warc.gz`` members with ``indexes/X.cdx`` beside them): the end record, the ZIP64 locator and end record if there is one, and the
central directory are parsed from the tail of the file; the local header of a
stored member gives where its bytes start; the index member gives every
record's range.  Only those ranges are read (neighbours together up to
``READ_BYTES``); nothing is unpacked to disk.  Large archives are split over tasks
by record ranges.

Recovery: a task writes under a name of its own and the list of packages is a
table committed by Spark, so a retried task's leftovers are never read.

Defined cases: null html is the empty payload.  Records of equal payloads below
``SHARED_LEAST`` bytes are all responses.  Null page ids and repeated rows are
written and read back as records of their own (of repeated largest ids the last
is the response); a null id never is the response if another id shares the
payload.  Null urls give no target header.  Empty table: no packages, no rows.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import fresh, materialize, shared_path, utf8
from tessera.sources.libsvm import _file_system as file_system
from tessera.sources.libsvm import qualified_uri

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
SHARED_LEAST = 1000
PACKAGE_BYTES = 64 << 20
PACKAGE_RECORDS = 50_000
READ_BYTES = 4 << 20
RANGE_RECORDS = 2000
LEVEL = 1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ---- deciding which records carry their payload ----

def plan_records(pages: DataFrame) -> DataFrame:
    """pages plus ``rid`` and, for revisits, ``refers_to`` and ``refers_rid`` (the response's id and row id)."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.monotonically_increasing_id().alias("rid"), "page_id", F.octet_length(payload).alias("bytes"),
                        F.sha1(payload).alias("sha"), F.xxhash64(payload).alias("h"))
    rows = materialize(rows.where(F.col("bytes") >= SHARED_LEAST), "payloads")
    heads = (rows.groupBy("sha", "h", "bytes").agg(F.max(F.struct("page_id", "rid")).alias("last"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("sha", "h", "bytes", "last"))
    again = rows.join(heads, ["sha", "h", "bytes"]).where(F.col("rid") != F.col("last.rid"))
    revisits = again.select("rid", F.col("last.page_id").alias("refers_to"), F.col("last.rid").alias("refers_rid"))
    return (pages.select(F.monotonically_increasing_id().alias("rid"), "page_id", "url", "html")
            .join(revisits, "rid", "left"))


# ---- writing ----

def _header(fields: list[tuple[str, str]]) -> bytes:
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"


def _one_line(text: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in text)


def record_bytes(rid: int, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
                 refers_rid: int | None) -> bytes:
    """One WARC record as a gzip member."""
    revisit = refers_rid is not None
    body = b"" if revisit else payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:tessera:row:{rid}>"),
              ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{hashlib.sha1(payload).hexdigest()}"),
              ("X-Payload-Length", str(len(payload)))]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if url is not None:
        fields.append(("WARC-Target-URI", _one_line(url)))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:tessera:row:{refers_rid}>")]
        if refers_to is not None:
            fields.append(("X-Refers-To-Page-ID", str(refers_to)))
    fields.append(("Content-Length", str(len(body))))
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(_header(fields)) + z.compress(body) + z.compress(b"\r\n\r\n") + z.flush()


class PackageWriter:
    """A ZIP package written front to back; sizes that need it use ZIP64."""

    def __init__(self, filesystem, path: str):
        self.out = filesystem.open_output_stream(path)
        self.zip = zipfile.ZipFile(_Sink(self.out), "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
        self.index, self.size = [], 0

    def add(self, name: str, data: bytes) -> None:
        self.member.write(data)
        self.index.append(f"{name} {self.size} {len(data)}\n")
        self.size += len(data)

    def close(self) -> None:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "".join(self.index))
        self.zip.close()
        self.out.close()


class _Sink:
    """An output stream as the file object that ``zipfile`` expects when it cannot seek."""

    def __init__(self, out):
        self.out = out

    def write(self, data) -> int:
        self.out.write(data)
        return len(data)

    def flush(self) -> None:
        pass


def write_packages(records: DataFrame, folder: str) -> DataFrame:
    """records (rid, page_id, url, html, refers_to, refers_rid) -> committed table of path, records.

    A folder without a scheme is one of Spark's default file system, not each machine's own.
    """
    folder = qualified_uri(records.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = file_system(folder)
        filesystem.create_dir(base, recursive=True)
        done: list[tuple[str, int]] = []
        package = None

        def close():
            nonlocal package
            if package is not None:
                package.close()
                done[-1] = (done[-1][0], len(package.index))
            package = None
        for b in batches:
            cols = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            plain = [cols[n].to_pylist() for n in ("rid", "page_id", "url", "refers_to", "refers_rid")]
            for html, rid, page, url, to, to_rid in zip(utf8(cols["html"]), *plain):
                if package is None:
                    name = f"part-{uuid.uuid4().hex}.wacz"
                    done.append((name, 0))
                    package = PackageWriter(filesystem, f"{base}/{name}")
                package.add(str(rid), record_bytes(rid, page, url, html or b"", to, to_rid))
                if package.size >= PACKAGE_BYTES or len(package.index) >= PACKAGE_RECORDS:
                    close()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{n}" for n, _ in done], pa.string()),
                                          pa.array([n for _, n in done], pa.int64())], ["path", "records"])
    return materialize(records.mapInArrow(run, "path string, records long"), "packages")


# ---- reading ----

def _tail(f, size: int) -> tuple[bytes, int]:
    start = max(0, size - (1 << 16) - 22)
    f.seek(start)
    return f.read(size - start), start


def central_directory(f, size: int) -> dict[str, tuple[int, int, int]]:
    """name -> (local header offset, stored size, method), from the end records of a ZIP file."""
    tail, start = _tail(f, size)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0:
        count, length, offset, comment = struct.unpack_from("<HIIH", tail, at + 10) if at + 22 <= len(tail) else (0, 0, 0, -1)
        if comment >= 0 and at + 22 + comment == len(tail):
            break
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no end of central directory")
    if 0xFFFF == count or 0xFFFFFFFF in (length, offset):
        f.seek(start + at - 20)
        locator = f.read(20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        f.seek(struct.unpack_from("<Q", locator, 8)[0])
        end = f.read(56)
        if end[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        count, length, offset = struct.unpack_from("<QQQ", end, 32)
    f.seek(offset)
    data, found, at = f.read(length), {}, 0
    for _ in range(count):
        if data[at:at + 4] != b"PK\x01\x02":
            raise ValueError("bad central directory entry")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        packed, plain = struct.unpack_from("<II", data, at + 20)
        n, extra, comment = struct.unpack_from("<HHH", data, at + 28)
        local = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46:at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        e, stop = at + 46 + n, at + 46 + n + extra
        while e + 4 <= stop:
            kind, size_of = struct.unpack_from("<HH", data, e)
            if kind == 1:  # ZIP64: only the fields that overflow, in this order
                big = list(struct.unpack_from(f"<{size_of // 8}Q", data, e + 4))
                plain = big.pop(0) if plain == 0xFFFFFFFF else plain
                packed = big.pop(0) if packed == 0xFFFFFFFF else packed
                local = big.pop(0) if local == 0xFFFFFFFF else local
            e += 4 + size_of
        found[name] = (local, packed, method)
        at = stop + comment
    return found


def stored_range(f, entry: tuple[int, int, int]) -> tuple[int, int]:
    """(first byte, size) of a stored member's data in the file."""
    local, size, method = entry
    if method != 0:
        raise ValueError("the member is not stored")
    f.seek(local)
    head = f.read(30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("bad local header")
    return local + 30 + sum(struct.unpack_from("<HH", head, 26)), size


def archive_pairs(names: list[str]) -> list[tuple[str, str]]:
    """(archive member, its index member): ``archive/X.warc.gz`` goes with ``indexes/X.cdx``, or with the only index."""
    archives = sorted(n for n in names if n.startswith("archive/") and n.endswith(".warc.gz"))
    indexes = sorted(n for n in names if n.startswith("indexes/") and n.endswith(".cdx"))
    own = {n.removeprefix("indexes/").removesuffix(".cdx"): n for n in indexes}
    found = [(a, own.get(a.removeprefix("archive/").removesuffix(".warc.gz"), indexes[0] if len(archives) == len(indexes) == 1 else None))
             for a in archives]
    if any(i is None for _, i in found):
        raise ValueError(f"archives without an index: {[a for a, i in found if i is None]}")
    return found


def package_index(f, size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(first byte of an archive member, [(offset, length)] of its records) for every archive of the package."""
    members, out = central_directory(f, size), []
    for archive, index in archive_pairs(list(members)):
        start, _ = stored_range(f, members[archive])
        at, n = stored_range(f, members[index])
        f.seek(at)
        lines = f.read(n).decode().splitlines()
        out.append((start, [(int(a), int(b)) for _, a, b in (x.split(" ") for x in lines)]))
    return out


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of one gzip member's WARC record."""
    z = zlib.decompressobj(31)
    raw = z.decompress(data) + z.flush()
    if not z.eof or z.unused_data:
        raise ValueError("the range is not one gzip member")
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}
    n = int(fields["content-length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("content length and block differ")
    return fields, rest[:n]


def _opened(path: str):
    filesystem, name = file_system(path)
    return filesystem.open_input_file(name)


def read_records(packages: DataFrame, with_payload: bool = False) -> DataFrame:
    """packages(path) -> one row per record, payloads verified against their digests."""
    def split(batches):
        for b in batches:
            out: list[list] = [[], [], [], []]
            for path in b.column(0).to_pylist():
                with _opened(path) as f:
                    archives = package_index(f, f.size())
                for start, ranges in archives:
                    for i in range(0, len(ranges), RANGE_RECORDS):
                        part = ranges[i:i + RANGE_RECORDS]
                        for c, x in zip(out, (path, start, [a for a, _ in part], [n for _, n in part])):
                            c.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()),
                                              pa.array(out[2], pa.list_(pa.int64())), pa.array(out[3], pa.list_(pa.int64()))],
                                             ["path", "start", "offsets", "lengths"])

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"] + ["payload"] * with_payload
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()][:len(names)]

    def rows(f, start, ranges):
        i = 0
        while i < len(ranges):
            j, base = i, ranges[i][0]
            while j < len(ranges) and (j == i or ranges[j][0] + ranges[j][1] - base <= READ_BYTES):
                j += 1
            f.seek(start + base)
            data = f.read(ranges[j - 1][0] + ranges[j - 1][1] - base)
            for at, n in ranges[i:j]:
                h, block = parse_record(data[at - base:at - base + n])
                digest, size, kind = h["warc-payload-digest"].removeprefix("sha1:"), int(h["x-payload-length"]), h["warc-type"]
                if kind == "response" and (len(block), hashlib.sha1(block).hexdigest()) != (size, digest):
                    raise ValueError(f"payload of {h['warc-record-id']} differs from its digest")
                ints = [int(h[k]) if k in h else None for k in ("x-page-id", "x-refers-to-page-id")]
                yield (ints[0], size, digest, kind, ints[1], h.get("warc-target-uri"), block)[:len(names)]
            i = j

    def fetch(batches):
        for b in batches:
            for path, start, offsets, lengths in zip(*(c.to_pylist() for c in b.columns)):
                out, held = [], 0
                with _opened(path) as f:
                    for r in rows(f, start, list(zip(offsets, lengths))):
                        out.append(r)
                        held += r[1] if with_payload else 0
                        if held > READ_BYTES:
                            yield table(out)
                            out, held = [], 0
                yield table(out)

    def table(out):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else
                                          [pa.array([], k) for k in kinds], names)
    schema = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
              + ", payload binary" * with_payload)
    ranges = materialize(packages.select("path").mapInArrow(split, "path string, start long, offsets array<long>, lengths array<long>"),
                         "record-ranges")
    n = ranges.count()
    return ranges.repartition(max(1, n)).mapInArrow(fetch, schema) if n else ranges.sparkSession.createDataFrame([], schema)


def archive_report(pages: DataFrame) -> DataFrame:
    """Write the pages to packages, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    folder = shared_path(pages.sparkSession, "warc")
    return read_records(write_packages(plan_records(pages), folder)).drop("url")
