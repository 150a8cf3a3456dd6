import hashlib
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from tessera.llm import warczip
from tessera.llm.shared import shared_path

SCHEMA = "page_id long, url string, html string"
BIG, SMALL = "é" * 700, "x" * 999
ROWS = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, "http://a/é\r\n: x", BIG), (4, None, SMALL), (5, "u", SMALL), (6, "u", None),
        (7, "u", ""), (8, "u", "y" * 1000), (9, "u", "z" * 3_000_000), (9, "u", "z" * 3_000_000), (None, "n", BIG), (None, "n", "w" * 2000),
        (None, "n", "w" * 2000), (10, "u", "WARC/1.1\r\n\r\nbody\r\n\r\nPK\x05\x06"), (11, "u", BIG.upper())]


def brute(rows):
    groups = {}
    for i, _, h in rows:
        groups.setdefault(h or "", []).append(i)
    out = []
    for payload, ids in groups.items():
        raw = payload.encode()
        ids = sorted(ids, key=lambda x: (x is not None, x or 0))
        for n, i in enumerate(ids):
            revisit = len(raw) >= 1000 and n < len(ids) - 1
            out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", ids[-1] if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [None, 3])
def test_report_equals_brute_force(spark, monkeypatch, limit):
    if limit:
        monkeypatch.setattr(warczip, "PACKAGE_RECORDS", limit)
    got = warczip.archive_report(spark.createDataFrame(ROWS, SCHEMA)).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == brute(ROWS)


def test_payloads_round_trip(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    packages = warczip.write_packages(warczip.plan_records(df), shared_path(spark, "warc"))
    got = warczip.read_records(packages, with_payload=True).collect()
    want = sorted((str(i), (h or "").encode()) for i, _, h in ROWS)
    whole = {r.page_id: bytes(r.payload) for r in got if r.record_type == "response"}
    have = sorted((str(r.page_id), bytes(r.payload) if r.record_type == "response" else whole[r.refers_to]) for r in got)
    assert have == want
    assert packages.agg(F.sum("records")).first()[0] == len(ROWS)


def zip_of(members, force64=False, comment=b""):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members:
            with z.open(zipfile.ZipInfo(name), "w", force_zip64=force64) as f:
                f.write(data)
        z.comment = comment
    return out.getvalue()


def test_directories_of_plain_and_zip64_files(monkeypatch):
    records = [warczip.record_bytes(i, i, f"u{i}", b"p" * i, None, None) for i in range(50)]
    index, at = "", 0
    for i, r in enumerate(records):
        index, at = index + f"{i} {at} {len(r)}\n", at + len(r)
    members = [("other é.txt", b"zz"), (warczip.ARCHIVE, b"".join(records)), (warczip.INDEX, index.encode())]
    for data in (zip_of(members), zip_of(members, True), zip_of(members, comment=b"PK\x05\x06 not the end"),
                 zip_of(members + [(f"m{i}", b"") for i in range(66_000)])):
        [(start, ranges)] = warczip.package_index(io.BytesIO(data), len(data))
        for i, (a, n) in enumerate(ranges):
            head, block = warczip.parse_record(data[start + a:start + a + n])
            assert (head["x-page-id"], block) == (str(i), b"p" * i)
    # sizes and offsets beyond 32 bits, written as ZIP64 fields by lowering the limit
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    data = zip_of(members, True)
    assert b"PK\x06\x06" in data and b"PK\x06\x07" in data
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        want = {i.filename: (i.header_offset, i.file_size, 0) for i in z.infolist()}
    assert warczip.central_directory(io.BytesIO(data), len(data)) == want
    with pytest.raises(ValueError):
        warczip.central_directory(io.BytesIO(b"no zip"), 6)
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(warczip.ARCHIVE, b"a" * 1000)
    with pytest.raises(ValueError):
        warczip.stored_range(packed, warczip.central_directory(packed, len(packed.getvalue()))[warczip.ARCHIVE])


def test_no_pages(spark):
    assert warczip.archive_report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_every_archive_of_a_package_is_read(spark, tmp_path):
    """Two archives, each with its index, among other members; one without an index is an error."""
    def part(ids):
        records = [warczip.record_bytes(i, i, f"u{i}", f"page {i}".encode(), None, None) for i in ids]
        at, index = 0, ""
        for i, r in zip(ids, records):
            index, at = index + f"{i} {at} {len(r)}\n", at + len(r)
        return b"".join(records), index.encode()
    (one, i1), (two, i2) = part(range(5)), part(range(5, 9))
    members = [("pages/pages.jsonl", b"{}"), ("archive/b.warc.gz", two), ("archive/a.warc.gz", one), ("indexes/a.cdx", i1), ("indexes/b.cdx", i2)]
    file = tmp_path / "two.wacz"
    file.write_bytes(zip_of(members))
    got = warczip.read_records(spark.createDataFrame([(f"file://{file}",)], "path string"), with_payload=True).collect()
    assert sorted((r.page_id, bytes(r.payload)) for r in got) == [(i, f"page {i}".encode()) for i in range(9)]
    assert warczip.archive_pairs(["archive/x.warc.gz", "indexes/index.cdx"]) == [("archive/x.warc.gz", "indexes/index.cdx")]
    with pytest.raises(ValueError, match="without an index"):
        warczip.package_index(io.BytesIO(data := zip_of(members[:-1])), len(data))


def test_a_folder_without_a_scheme_is_of_sparks_file_system(spark, tmp_path):
    got = warczip.write_packages(warczip.plan_records(spark.createDataFrame(ROWS, SCHEMA)), str(tmp_path / "plain"))
    assert all(r.path.startswith("file:///") for r in got.collect())
    conf = spark._jsc.hadoopConfiguration()
    old = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://elsewhere/")
    conf.set("fs.viewfs.mounttable.elsewhere.link./data", f"file://{tmp_path}")
    try:
        with pytest.raises(Exception, match="viewfs"):           # asked for there, and not written to this machine's disk
            warczip.write_packages(warczip.plan_records(spark.createDataFrame(ROWS, SCHEMA)), "/data/x").count()
    finally:
        conf.set("fs.defaultFS", old or "file:///")
    assert not (tmp_path / "x").exists()


def test_extra_columns_of_the_plans_names(spark):
    clash = spark.createDataFrame(ROWS, SCHEMA).withColumns({"RID": F.lit(1), "refers_to": F.lit(2), "bytes": F.lit(3), "sha": F.lit("x"), "last": F.lit(0)})
    want = warczip.archive_report(spark.createDataFrame(ROWS, SCHEMA)).collect()
    assert sorted(map(str, warczip.archive_report(clash).collect())) == sorted(map(str, want))
