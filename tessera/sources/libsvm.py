"""LibSVM lines and TFRecord examples.

``to_libsvm`` is one ``concat_ws`` projection.  ``to_examples`` builds the
typed feature map with higher-order functions.  TFRecord files are a Python Data Source:
records are framed as TFRecord (length, masked CRC32C) around a serialized
``tf.train.Example``.  Writing, every partition encodes its Arrow batches column-wise (numpy) into its own file
in a folder of the job, and the job's commit moves them; reading, a partition per file, all CRCs checked.
"""

from __future__ import annotations

import re
import struct
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

#: Records framed at a time.
FRAME_BATCH = 1000

EXAMPLE_TYPE = T.MapType(T.StringType(), T.StructType([
    T.StructField("i", T.ArrayType(T.LongType())),
    T.StructField("f", T.ArrayType(T.FloatType())),
]))


def to_libsvm(df: DataFrame, label_col: str, name: str = "libsvm") -> DataFrame:
    """Rows without nulls -> ``label i:v i:v ...`` (values as double text).

    The index of a feature is its column position from 0; the label's
    position is skipped, not closed up.  Zeros are written too.
    """
    clean = df.dropna(how="any")
    parts = [F.col(label_col).cast("double").cast("string")]
    for pos, c in enumerate(clean.columns):
        if c == label_col:
            continue
        parts.append(F.concat(F.lit(f"{pos}:"), F.col(c).cast("double").cast("string")))
    return clean.select(F.trim(F.concat_ws(" ", *parts)).alias(name))


def write_libsvm(df: DataFrame, label_col: str, path: str, mode: str = "overwrite") -> None:
    """S9 sink: LibSVM text files, one per partition."""
    to_libsvm(df, label_col).write.mode(mode).text(path)


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """``(label double, features vector)``; indices in the file are 1-based."""
    r = spark.read.format("libsvm")
    if num_features:
        r = r.option("numFeatures", num_features)
    return r.load(path)


def to_examples(lines: DataFrame, col: str = "value", sep: str = " ") -> DataFrame:
    """LibSVM line -> typed map ``name -> {i: int64 list, f: float list}``.

    ``label`` is int64 (a label that is not an integer gives null); a
    feature ``idx:value`` is int64 when the value is all digits, else float.
    Adds column ``example`` to the input.
    """
    toks = F.split(F.trim(F.col(col)), sep)
    label = F.struct(F.array(toks[0].try_cast("bigint")).alias("i"),
                     F.array().cast("array<float>").alias("f"))
    feats = F.transform(F.slice(toks, 2, F.size(toks)), lambda t: F.struct(
        F.substring_index(t, ":", 1).alias("k"),
        F.struct(
            F.when(F.substring_index(t, ":", -1).rlike(r"^\p{Nd}+$"),
                   F.array(F.substring_index(t, ":", -1).cast("bigint"))).otherwise(F.array().cast("array<bigint>")).alias("i"),
            F.when(F.substring_index(t, ":", -1).rlike(r"^\p{Nd}+$"), F.array().cast("array<float>"))
            .otherwise(F.array(F.substring_index(t, ":", -1).try_cast("float"))).alias("f"))
        .alias("v")))
    entries = F.concat(F.array(F.struct(F.lit("label").alias("k"), label.alias("v"))), feats)
    return lines.withColumn("example", F.map_from_entries(entries).cast(EXAMPLE_TYPE))


# ---- TFRecord sink ----------------------------------------------------------

def _crc32c_table():
    poly = 0x82F63B78
    table = []
    for n in range(256):
        c = n
        for _ in range(8):
            c = (c >> 1) ^ poly if c & 1 else c >> 1
        table.append(c)
    return table


_CRC_TABLE = _crc32c_table()


_CRC_ARRAY = np.array(_CRC_TABLE, np.uint32)


def _crc32c_ranges(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32C of data[start:start + size] for every range: one vector step per byte position over all ranges that reach it."""
    order = np.argsort(-size, kind="stable")
    crc = np.full(len(size), 0xFFFFFFFF, np.uint32)
    by_size = -size[order]
    for i in range(int(size.max(initial=0))):
        live = order[:np.searchsorted(by_size, -i, "left")]   # ranges longer than i
        c = crc[live]
        crc[live] = _CRC_ARRAY[(c ^ data[start[live] + i]) & 0xFF] ^ (c >> np.uint32(8))
    return crc ^ np.uint32(0xFFFFFFFF)


def crc32c_many(items: list[bytes]) -> list[int]:
    """CRC-32C of every byte string."""
    size = np.array([len(x) for x in items], np.int64)
    return _crc32c_ranges(np.frombuffer(b"".join(items), np.uint8), np.cumsum(size) - size, size).tolist()


def crc32c(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c = _CRC_TABLE[(c ^ b) & 0xFF] ^ (c >> 8)
    return c ^ 0xFFFFFFFF


def _masked(c):
    """The CRC as TFRecord stores it (an int, or a uint32 array)."""
    c = np.asarray(c).astype(np.uint64)
    out = (((c >> np.uint64(15)) | (c << np.uint64(17))) + np.uint64(0xA282EAD8)) & np.uint64(0xFFFFFFFF)
    return int(out) if out.ndim == 0 else out.astype("<u4")


# Column-wise encoding: all byte strings of a batch are ranges of one pool, put in order by one gather.

def _varints(values: np.ndarray, tag: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all varints in a row, size of each), each behind the byte ``tag`` if given."""
    v = values.astype(np.int64).view(np.uint64)
    shifts = np.arange(10, dtype=np.uint64) * np.uint64(7)
    size = 1 + sum((v >> s != 0).astype(np.int64) for s in shifts[1:])
    cells = ((v[:, None] >> shifts) & np.uint64(0x7F)).astype(np.uint8)
    place = np.arange(10)
    cells |= np.where(place < size[:, None] - 1, 0x80, 0).astype(np.uint8)
    used = place < size[:, None]
    if tag is not None:
        cells = np.concatenate([np.full((len(v), 1), tag, np.uint8), cells], axis=1)
        used = np.concatenate([np.ones((len(v), 1), bool), used], axis=1)
    return cells[used], size + (tag is not None)


class _Weave:
    """Byte ranges of several pools, laid out in any order."""

    def __init__(self):
        self.pools, self.length = [], 0

    def add(self, pool: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Consecutive ranges of the given sizes: (start in all pools, size)."""
        start = self.length + np.cumsum(size) - size
        self.pools.append(pool)
        self.length += len(pool)
        return start, size

    def lay(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        after = np.cumsum(size)
        total = int(after[-1]) if len(after) else 0
        return np.concatenate([*self.pools, np.empty(0, np.uint8)])[np.repeat(start - (after - size), size) + np.arange(total)]


def _list_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _lists(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, values) of a list array; a null list is empty, a null value is refused."""
    if arr.null_count:
        arr = pc.coalesce(arr, pa.array([[]], arr.type)[0])
    offsets = arr.offsets.to_numpy()
    values = arr.flatten()
    if values.null_count:
        raise ValueError("a feature holds a null value")
    return offsets - offsets[0], values.to_numpy()


def encode_examples(examples: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Typed maps -> serialized ``tf.train.Example`` messages: (bytes of all in a row, size of each).

    Features stand by name; one with integers is an int64_list, any other a float_list.  A null
    map is an example without features.
    """
    rows = len(examples)
    examples = examples.take(pa.array(np.arange(rows)))      # a slice becomes an array of its own; a null map has no entries in it
    offsets = examples.offsets.to_numpy()
    keys, items = examples.keys, examples.items
    row = np.repeat(np.arange(rows), np.diff(offsets))
    names = keys.cast(pa.string()).dictionary_encode()
    words = names.dictionary.to_pylist()
    rank = np.argsort(np.argsort(np.array(words, object))) if words else np.empty(0, np.int64)
    code = names.indices.to_numpy().astype(np.int64)
    (i_off, ints), (f_off, floats) = (_lists(pc.struct_field(items, i)) for i in (0, 1))
    w = _Weave()
    is_int = np.diff(i_off) > 0
    int_bytes, int_sizes = _varints(ints)
    int_size, float_size = _list_sums(int_sizes, i_off), 4 * np.diff(f_off)
    int_start, _ = w.add(int_bytes, int_size)
    float_start, _ = w.add(np.frombuffer(floats.astype("<f4").tobytes(), np.uint8), float_size)
    packed = np.where(is_int, int_size, float_size)
    packed_head, packed_n = _varints(packed, 0x0A)                  # Int64List.value / FloatList.value, packed
    inner = packed_n + packed
    int_head, int_n = _varints(inner, 0x1A)                         # Feature.int64_list
    float_head, float_n = _varints(inner, 0x12)                     # Feature.float_list
    feature = int_n + inner
    feature_head, feature_n = _varints(feature, 0x12)               # the map entry's value
    name_bytes = [b"\x0a" + _varint(len(x.encode())) + x.encode() for x in words]
    name_start, name_n = w.add(np.frombuffer(b"".join(name_bytes), np.uint8), np.array([len(x) for x in name_bytes], np.int64))
    entry = name_n[code] + feature_n + feature
    entry_head, entry_n = _varints(entry, 0x0A)                     # Features.feature
    total = np.zeros(rows, np.int64)
    np.add.at(total, row, entry_n + entry)
    head, head_n = _varints(total, 0x0A)                            # Example.features
    parts = [w.add(entry_head, entry_n), (name_start[code], name_n[code]), w.add(feature_head, feature_n)]
    i_head, f_head = w.add(int_head, int_n), w.add(float_head, float_n)
    parts += [(np.where(is_int, i_head[0], f_head[0]), int_n), w.add(packed_head, packed_n), (np.where(is_int, int_start, float_start), packed)]
    heads = w.add(head, head_n)
    # order of all ranges: by row, its head first, then its features by name, each in its parts' order
    by_name = np.lexsort((rank[code], row))
    place = np.empty(len(row), np.int64)
    place[by_name] = np.arange(len(row))
    start = np.concatenate([heads[0], *[p[0] for p in parts]])
    size = np.concatenate([heads[1], *[p[1] for p in parts]])
    of_row = np.concatenate([np.arange(rows), *[row] * 6])
    within = np.concatenate([np.full(rows, -1), *[6 * place + k for k in range(6)]])
    order = np.lexsort((within, of_row))
    return w.lay(start[order], size[order]), head_n + total


def frame_records(data: np.ndarray, size: np.ndarray) -> np.ndarray:
    """TFRecord framing of payloads in a row: length, masked CRC of length, data, masked CRC of data."""
    n, w = len(size), _Weave()
    lengths = np.frombuffer(size.astype("<u8").tobytes(), np.uint8)
    eight, four = np.full(n, 8), np.full(n, 4)
    crc = lambda bytes_, sizes: np.frombuffer(_masked(_crc32c_ranges(bytes_, np.cumsum(sizes) - sizes, sizes)).tobytes(), np.uint8)
    parts = [w.add(lengths, eight), w.add(crc(lengths, eight), four), w.add(data, size), w.add(crc(data, size), four)]
    return w.lay(np.stack([p[0] for p in parts], axis=1).ravel(), np.stack([p[1] for p in parts], axis=1).ravel())


def _varint(n: int) -> bytes:
    return _varints(np.array([n]))[0].tobytes()


def qualified_uri(spark, path: str) -> str:
    """``path`` as a full URI of the file system that Spark itself would use for it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return re.sub("^file:/+", "file:///", uri)


def _file_system(uri: str):
    """pyarrow file system and folder of a full URI (``s3a://`` is Hadoop's name for ``s3://``)."""
    from pyarrow import fs as pafs
    if "://" not in uri:
        raise ValueError(f"{uri!r} has no scheme: executors need a full URI (write_tfrecords makes one)")
    return pafs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", uri))


@dataclass
class _Written(WriterCommitMessage):
    name: str | None     # None: a partition without rows


class _TFRecordWriter(DataSourceArrowWriter):
    """Parts are written to a folder of this job and moved by ``commit`` on the driver."""

    def __init__(self, options, overwrite: bool):
        self.path, self.column, self.overwrite = options["path"], options.get("column", "example"), overwrite
        self.job = uuid.uuid4().hex[:12]

    def write(self, iterator):
        from pyspark import TaskContext
        filesystem, root = _file_system(self.path)
        name = fh = None
        try:
            for batch in iterator:
                if fh is None:      # only once rows have come: a job that fails before leaves no folder behind its cleaning
                    filesystem.create_dir(f"{root}/_job-{self.job}", recursive=True)
                    ctx = TaskContext.get()
                    name = f"part-{self.job}-{ctx.partitionId() if ctx else 0:05d}-{uuid.uuid4().hex[:8]}.tfrecord"
                    fh = filesystem.open_output_stream(f"{root}/_job-{self.job}/{name}")
                examples = batch.column(batch.schema.get_field_index(self.column))
                for at in range(0, len(examples), FRAME_BATCH):
                    fh.write(frame_records(*encode_examples(examples.slice(at, FRAME_BATCH))).tobytes())
        finally:
            if fh is not None:
                fh.close()
        return _Written(name)

    def commit(self, messages):
        filesystem, root = _file_system(self.path)
        filesystem.create_dir(root, recursive=True)
        old = [f.path for f in filesystem.get_file_info(pafs_selector(root)) if f.base_name.endswith(".tfrecord")]
        for m in messages:
            if m is not None and m.name is not None:
                filesystem.move(f"{root}/_job-{self.job}/{m.name}", f"{root}/{m.name}")
        if self.overwrite:   # only files that were there before this job
            for path in old:
                filesystem.delete_file(path)
        self._clean(filesystem, root)

    def abort(self, messages):
        filesystem, root = _file_system(self.path)
        self._clean(filesystem, root)

    def _clean(self, filesystem, root):
        from pyarrow import fs as pafs
        if filesystem.get_file_info(f"{root}/_job-{self.job}").type == pafs.FileType.Directory:
            filesystem.delete_dir(f"{root}/_job-{self.job}")


def pafs_selector(root: str):
    from pyarrow import fs as pafs
    return pafs.FileSelector(root, allow_not_found=True)


def _fields(data: bytes, at: int, end: int):
    """(field, wire type, value or (start, end)) of the protobuf fields in data[at:end]."""
    def varint(i):
        n = shift = 0
        while True:
            b = data[i]
            n |= (b & 0x7F) << shift
            i, shift = i + 1, shift + 7
            if b < 0x80:
                return n, i
    while at < end:
        key, at = varint(at)
        if key & 7 == 0:
            value, at = varint(at)
        else:
            n, at = {2: lambda: varint(at), 1: lambda: (8, at), 5: lambda: (4, at)}[key & 7]()
            value, at = (at, at + n), at + n
        yield key >> 3, key & 7, value


def decode_example(data: bytes) -> list[tuple]:
    """A serialized ``tf.train.Example`` -> (name, {i, f}) pairs by name.  A list of bytes is refused: the map has no place for one."""
    out = {}
    for number, _, features in _fields(data, 0, len(data)):
        for _, _, entry in _fields(data, *features) if number == 1 else ():
            name, ints, floats = "", [], []
            for field, _, value in _fields(data, *entry):
                if field == 1:
                    name = data[slice(*value)].decode()
                    continue
                for kind, _, span in _fields(data, *value):
                    if kind == 1:
                        raise ValueError(f"feature {name!r} is a bytes_list, which an example map does not hold")
                    for _, wire, v in _fields(data, *span):
                        if kind == 2:
                            floats += np.frombuffer(data[slice(*v)], "<f4").tolist()     # packed, or one float
                        elif wire == 0:
                            ints.append(v - (1 << 64) if v >> 63 else v)
                        else:
                            ints += _packed_ints(data[slice(*v)])
            out[name] = {"i": ints, "f": floats}
    return sorted(out.items())


def _packed_ints(data: bytes) -> list[int]:
    out, n, shift = [], 0, 0
    for b in data:
        n |= (b & 0x7F) << shift
        shift += 7
        if b < 0x80:
            out.append(n - (1 << 64) if n >> 63 else n)
            n = shift = 0
    return out


def read_records(fh, name: str):
    """Payloads of an open TFRecord file, ``FRAME_BATCH`` at a time; a wrong CRC or a cut record raises."""
    def take(n):
        got = fh.read(n)
        if len(got) != n:
            raise ValueError(f"{name}: the record at byte {at} is cut off")
        return got
    at, held, sums, places = 0, [], [], []

    def checked():
        for crc, want, place in zip(crc32c_many(held), sums, places):
            if _masked(crc) != want:
                raise ValueError(f"{name}: wrong CRC of the data of the record at byte {place}")
        return held
    while head := fh.read(12):
        if len(head) != 12 or _masked(crc32c(head[:8])) != struct.unpack("<I", head[8:])[0]:
            raise ValueError(f"{name}: wrong CRC of the length of the record at byte {at}")
        body = take(struct.unpack("<Q", head[:8])[0] + 4)
        held.append(body[:-4])
        sums.append(struct.unpack("<I", body[-4:])[0])
        places.append(at)
        at += 12 + len(body)
        if len(held) == FRAME_BATCH:
            yield checked()
            held, sums, places = [], [], []
    if held:
        yield checked()


class _File(InputPartition):
    def __init__(self, uri: str):
        self.uri = uri


class _TFRecordReader(DataSourceReader):
    """A partition per file: records have no marks at which a file could be entered."""

    def __init__(self, options, schema):
        self.path, self.schema = options["path"], schema

    def partitions(self):
        from pyarrow import fs as pafs
        filesystem, root = _file_system(self.path)
        info = filesystem.get_file_info(root)
        files = [root] if info.type == pafs.FileType.File else [
            f.path for f in filesystem.get_file_info(pafs_selector(root)) if f.base_name.endswith(".tfrecord")]
        if not files and info.type != pafs.FileType.Directory:
            raise FileNotFoundError(self.path)
        head = re.match("^[a-z0-9+.-]+://", self.path)[0]
        return [_File(f"{head}{f}") for f in sorted(files)] or [_File("")]

    def read(self, partition):
        if not partition.uri:
            return
        filesystem, path = _file_system(partition.uri)
        kind = pa.map_(pa.string(), pa.struct([("i", pa.list_(pa.int64())), ("f", pa.list_(pa.float32()))]))
        with filesystem.open_input_stream(path, buffer_size=1 << 20) as fh:
            for payloads in read_records(fh, partition.uri):
                yield pa.RecordBatch.from_arrays([pa.array([decode_example(x) for x in payloads], kind)], ["example"])


class TFRecordDataSource(DataSource):
    """``df.write.format("tfrecord").option("path", uri).mode("append").save()`` and ``spark.read.format("tfrecord").load(uri)``."""

    @classmethod
    def name(cls):
        return "tfrecord"

    def schema(self):
        return "example map<string, struct<i: array<bigint>, f: array<float>>>"

    def writer(self, schema, overwrite):
        return _TFRecordWriter(self.options, overwrite)

    def reader(self, schema):
        return _TFRecordReader(self.options, schema)


def write_tfrecords(df: DataFrame, path: str, column: str = "example", mode: str = "append") -> None:
    """S10 sink: one TFRecord file per partition under ``path``.

    A path without a scheme is one of Spark's default file system.  ``append``
    adds files, ``overwrite`` replaces those that were there; files appear
    only when the whole job has succeeded.
    """
    spark = df.sparkSession
    spark.dataSource.register(TFRecordDataSource)
    (df.select(column).write.format("tfrecord").option("path", qualified_uri(spark, path))
     .option("column", column).mode(mode).save())


def read_tfrecords(spark: SparkSession, path: str) -> DataFrame:
    """S10 source: the typed maps of a TFRecord file, or of all ``.tfrecord`` files of a folder, a task per file.

    Every CRC is checked; a wrong one, a cut record and a list of bytes end the job.
    """
    spark.dataSource.register(TFRecordDataSource)
    return spark.read.format("tfrecord").load(qualified_uri(spark, path))
