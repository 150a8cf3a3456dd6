"""Sources and sinks: parsing rules, LibSVM round trip, TFRecord files, day partitions."""

import glob
import os
import random
import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.sources import libsvm as LS
from tessera.sources import text as TX


def lines(spark, vals):
    return spark.createDataFrame([(v,) for v in vals], "value string")


def test_read_ratings_rules(spark):
    df = lines(spark, ["1,2,3", "1,2,3.5", "1,2,-1", "1,,3", "1,2", "", "7,8,9,extra", "4,5,6,"])
    got = sorted(tuple(r) for r in TX.read_ratings(df).collect())
    assert got == [("1", "2", 3.0), ("4", "5", 6.0), ("7", "8", 9.0)]


def test_read_similarity_distinct(spark):
    df = lines(spark, ["(1,2,0.5)", "(1,2,0.5)", "(2,1,0.25)"])
    assert sorted(tuple(r) for r in TX.read_similarity(df).collect()) == [(1, 2, 0.5), (2, 1, 0.25)]


def test_libsvm_round_trip(spark, scratch):
    df = spark.createDataFrame([(0, 0.41, 0.71), (1, 0.0, 2.5), (None, 1.0, 1.0)], "label long, a double, b double")
    text = TX  # noqa: F841
    out = LS.to_libsvm(df, "label").collect()
    assert [r.libsvm for r in out] == ["0.0 1:0.41 2:0.71", "1.0 1:0.0 2:2.5"]
    path = os.path.join(scratch, "svm")
    LS.write_libsvm(df, "label", path)
    back = LS.read_libsvm(spark, path, num_features=3).orderBy("label").collect()
    assert [r.label for r in back] == [0.0, 1.0]
    # file indices are 1-based; the vector is 0-based
    assert back[0].features[0] == 0.41 and back[0].features[1] == 0.71


def test_examples_typing(spark):
    ex = LS.to_examples(lines(spark, ["1 3:5 4:5.0 7:-5"])).collect()[0].example
    assert ex["label"]["i"] == [1]
    assert ex["3"]["i"] == [5] and ex["4"]["f"] == [5.0] and ex["7"]["f"] == [-5.0]


def read_file(path):
    with open(path, "rb") as fh:
        return [p for group in LS.read_records(fh, path) for p in group]


def slow_varint(n):
    n &= (1 << 64) - 1
    out = b""
    while n > 0x7F:
        out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
    return out + bytes([n])


def slow_example(example):
    """A ``tf.train.Example`` built feature by feature."""
    part = lambda num, data: slow_varint(num << 3 | 2) + slow_varint(len(data)) + data
    out = b""
    for name, (ints, floats) in sorted(example.items()):
        data = (part(3, part(1, b"".join(map(slow_varint, ints)))) if ints
                else part(2, part(1, b"".join(struct.pack("<f", x) for x in floats or []))))
        out += part(1, part(1, name.encode()) + part(2, data))
    return part(1, out)


def test_tfrecord_sink(spark, scratch):
    ex = LS.to_examples(lines(spark, ["1 3:5 4:5.5", "0 3:2"])).repartition(2)
    path = os.path.join(scratch, "tfr")
    LS.write_tfrecords(ex, path)
    files = sorted(glob.glob(os.path.join(path, "part-*.tfrecord")))
    assert 1 <= len(files) <= 2
    payloads = [p for f in files for p in read_file(f)]
    assert len(payloads) == 2
    assert slow_example({"label": ([0], None), "3": ([2], None)}) in payloads


def test_whole_files_and_day_partitions(spark, scratch):
    d = os.path.join(scratch, "logs")
    os.makedirs(d)
    for name, body in [("a.log", "fine\nall good"), ("b.log", "line\nERROR boom")]:
        with open(os.path.join(d, name), "w") as fh:
            fh.write(body)
    files = {os.path.basename(r.filename): r.content for r in TX.scan_whole_files(spark, d).collect()}
    assert files == {"a.log": "fine\nall good", "b.log": "line\nERROR boom"}
    ev = spark.createDataFrame([("2024-01-14 10:00:00",), ("2024-01-15 00:00:00",)], "ts string") \
        .select(F.to_timestamp_ntz("ts").alias("ts"))
    p = os.path.join(scratch, "byday")
    TX.write_by_day(ev, "ts", p)
    day = TX.read_day(spark, p, "2024-01-14")
    assert day.count() == 1
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "dt" in plan


def test_crc32c_known_values():
    assert LS.crc32c(b"123456789") == 0xE3069283
    items = [b"", b"a", b"123456789", bytes(range(256)) * 3]

    def slow(data):
        c = 0xFFFFFFFF
        for b in data:
            c ^= b
            for _ in range(8):
                c = c >> 1 ^ (0x82F63B78 if c & 1 else 0)
        return c ^ 0xFFFFFFFF
    assert LS.crc32c_many(items) == [slow(x) for x in items]


def _records(path):
    return sorted(p for f in glob.glob(os.path.join(path, "*.tfrecord")) for p in read_file(f))


def test_tfrecord_append_overwrite_and_failed_job(spark, scratch):
    path = os.path.join(scratch, "tfr2")
    one = LS.to_examples(lines(spark, ["1 3:5 4:5.5", "0 3:2"])).repartition(2)
    two = LS.to_examples(lines(spark, ["1 9:9"])).coalesce(1)
    LS.write_tfrecords(one, path)
    LS.write_tfrecords(two, path)
    LS.write_tfrecords(two, path)
    assert len(_records(path)) == 4
    before = _records(path)
    hit = F.map_contains_key("example", "4") & F.raise_error(F.lit("boom")).isNull()
    broken = one.coalesce(1).select(F.when(hit, F.lit(None)).otherwise(F.col("example")).alias("example"))
    try:
        LS.write_tfrecords(broken, path)
        raise AssertionError("the job should fail")
    except Exception as e:  # noqa: BLE001
        assert "boom" in str(e)
    assert _records(path) == before
    assert [d for d in os.listdir(path) if d.startswith("_job-")] == []
    LS.write_tfrecords(two, path, mode="overwrite")
    assert len(_records(path)) == 1


def test_tfrecord_path_is_of_sparks_default_file_system(spark, scratch):
    conf = spark._jsc.hadoopConfiguration()
    old = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://store/")
    conf.set("fs.viewfs.mounttable.store.link./data", f"file://{scratch}")
    try:
        assert LS.qualified_uri(spark, "/data/x").startswith("viewfs://store/data/x")
    finally:
        conf.set("fs.defaultFS", old or "file:///")
    assert LS.qualified_uri(spark, f"{scratch}/x") == f"file://{scratch}/x"
    with pytest.raises(ValueError):
        LS._file_system("relative/path")


def random_examples(n, seed=5):
    rnd = random.Random(seed)
    names = ["label", "3", "long name " * 20, "é語", "", "a" * 127, "a" * 128]

    def feature():
        kind = rnd.randint(0, 3)
        return {"i": [rnd.choice([0, 1, 127, 128, -1, 2 ** 63 - 1, -2 ** 63, rnd.randint(-10 ** 12, 10 ** 12)]) for _ in range(rnd.randint(0, 40))] if kind > 1 else [],
                "f": [rnd.choice([0.0, 1.5, -2.25, 2.0 ** 90]) for _ in range(rnd.randint(0, 40))] if kind < 2 else []}
    return [None if rnd.random() < 0.05 else {k: feature() for k in rnd.sample(names, rnd.randint(0, 7))} for _ in range(n)]


def test_columnwise_encoding_equals_the_plain_one():
    kind = pa.map_(pa.string(), pa.struct([("i", pa.list_(pa.int64())), ("f", pa.list_(pa.float32()))]))
    examples = random_examples(300)
    want = [slow_example({k: (v["i"], v["f"]) for k, v in (e or {}).items()}) for e in examples]
    arr = pa.array([None if e is None else list(e.items()) for e in examples], kind)
    for part in (arr, arr.slice(7, 100), arr.slice(0, 0), arr.slice(299)):
        data, size = LS.encode_examples(part)
        ends = size.cumsum()
        at = {300: 0, 100: 7, 0: 0, 1: 299}[len(part)]
        assert [data[a - n:a].tobytes() for a, n in zip(ends, size)] == want[at:at + len(part)]
    assert [LS.decode_example(w) for w in want[:50]] == [sorted((k, {"i": v["i"], "f": v["f"]}) for k, v in (e or {}).items()) for e in examples[:50]]


def test_tfrecord_round_trip_and_spoiled_bytes(spark, scratch):
    path = os.path.join(scratch, "round")
    examples = [e or {} for e in random_examples(2500, 6)]
    kind = "example map<string, struct<i: array<bigint>, f: array<float>>>"
    df = spark.createDataFrame([(e,) for e in examples], kind).repartition(3)
    LS.write_tfrecords(df, path)
    back = LS.read_tfrecords(spark, path)
    assert back.rdd.getNumPartitions() == 3
    key = lambda e: repr(sorted((k, list(v.i), list(v.f)) for k, v in e.items()))
    assert sorted(key(r.example) for r in back.collect()) == sorted(repr(sorted((k, v["i"], v["f"]) for k, v in e.items())) for e in examples)
    typed = LS.to_examples(lines(spark, ["1 3:5 4:5.5", "0 3:2"]))
    one = os.path.join(scratch, "typed")
    LS.write_tfrecords(typed, one)
    assert sorted(key(r.example) for r in LS.read_tfrecords(spark, one).collect()) == sorted(key(r.example) for r in typed.collect())
    file = sorted(glob.glob(os.path.join(path, "*.tfrecord")))[0]
    with open(file, "rb") as fh:
        data = fh.read()
    for spoil, what in ((3, "length"), (9, "length"), (20, "data"), (len(data) - 2, "data")):
        with open(file, "wb") as fh:
            fh.write(data[:spoil] + bytes([data[spoil] ^ 1]) + data[spoil + 1:])
        with pytest.raises(ValueError, match=what):
            read_file(file)
    with pytest.raises(Exception, match="wrong CRC"):
        LS.read_tfrecords(spark, path).count()
    with open(file, "wb") as fh:
        fh.write(data[:-1])
    with pytest.raises(ValueError, match="cut off"):
        read_file(file)
    os.makedirs(os.path.join(scratch, "none"))
    assert LS.read_tfrecords(spark, os.path.join(scratch, "none")).count() == 0


def test_lines_of_large_files_keep_words_cut_by_range_borders(spark, scratch):
    """Files of several 4 kB ranges; a word, or one that only the removal makes, lies across a border at every place."""
    d, size = os.path.join(scratch, "cut"), 4096
    os.makedirs(d)
    want = {}
    for word, bad in (("ERROR", True), ("exception", True), ("ERRBindExceptionOR", True), ("BindException", False), ("BindBindExceptionException", True), ("ERR\nOR", False)):
        for shift in range(len(word) + 1):
            name = f"{word[:6].strip()}-{len(word)}-{shift}".replace("\n", "_")
            head = ("fine and well\n" * 400)[:size - shift - 3] + "\n-"
            with open(os.path.join(d, name), "w", newline="") as fh:
                fh.write(head.ljust(size - shift, "-") + word + " rest\n" + "all good\n" * 900)
            want[name] = bad
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        read = TX.scan_lines(spark, d)
        assert read.select("filename", "block").distinct().count() >= 3 * len(want) and read.rdd.getNumPartitions() > len(want)
        got = {os.path.basename(r.filename) for r in TX.error_files(read).collect()}
        kept = {r.filename: r["count"] for r in TX.error_report_lines(read).groupBy("filename").count().collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    whole = {os.path.basename(r.report.split(":\n")[0]) for r in C.error_filter(TX.scan_whole_files(spark, d), "filename", "content").collect()}
    assert got == whole == {n for n, bad in want.items() if bad}
    for f, n in kept.items():
        with open(f.removeprefix("file:").replace("//", "/"), newline="") as fh:
            assert n == fh.read().count("\n")
