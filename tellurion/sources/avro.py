"""Avro container files: blocks are found where a file is read, then dealt out and decoded side by side."""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Callable, Iterator
from datetime import date, datetime, timedelta
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Fixed values of the format: how a file begins, and the bytes of a sync marker.
MAGIC, SYNC = b"Obj\x01", 16
#: Rows of one Arrow batch.
ROWS = 2000

_BLOCKS = "path string, at long, n long, codec string, schema string, block binary, reason string"


class Reader:
    """Takes values off bytes; a read beyond the end is an error."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def take(self, n: int) -> bytes:
        if n < 0 or self.at + n > len(self.data):
            raise ValueError("cut off")
        self.at += n
        return self.data[self.at - n : self.at]

    def long(self) -> int:
        """A number in groups of 7 bits, lowest first, its sign in the lowest bit."""
        value = shift = 0
        while True:
            if self.at >= len(self.data) or shift > 63:
                raise ValueError("cut off")
            b = self.data[self.at]
            self.at += 1
            value |= (b & 0x7F) << shift
            if b < 0x80:
                return (value >> 1) ^ -(value & 1)
            shift += 7

    def blob(self) -> bytes:
        return self.take(self.long())

    def items(self, one: Callable[[], object]) -> Iterator[object]:
        """The elements of an array or a map, which stand in runs; a run with its bytes has a negative count."""
        while n := self.long():
            if n < 0:
                n = -n
                self.long()
            for _ in range(n):
                yield one()


def header(data: bytes) -> tuple[dict[str, bytes], bytes, int]:
    """The metadata of a file, its sync marker, and where its blocks begin."""
    r = Reader(data)
    if r.take(4) != MAGIC:
        raise ValueError("not an Avro file")
    meta = dict(r.items(lambda: (r.blob().decode(), r.blob())))
    return meta, r.take(SYNC), r.at


_PLAIN = {"null": T.NullType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(), "bytes": T.BinaryType(), "string": T.StringType()}
_LOGICAL = {("int", "date"): T.DateType(), ("long", "timestamp-millis"): T.TimestampType(), ("long", "timestamp-micros"): T.TimestampType(), ("long", "local-timestamp-millis"): T.TimestampNTZType(), ("long", "local-timestamp-micros"): T.TimestampNTZType()}
_EPOCH = datetime(1970, 1, 1)


class Schema:
    """An Avro schema as a Spark type, and a decoder of its values. Named types may be used again below, but not within themselves."""

    def __init__(self, text: str):
        self.names: dict[str, tuple[T.DataType, Callable[[Reader], object]]] = {}
        self.type, self.decode = self._of(json.loads(text), "", ())

    def _of(self, s, space: str, within: tuple[str, ...]) -> tuple[T.DataType, Callable[[Reader], object]]:
        if isinstance(s, list):
            return self._union(s, space, within)
        if isinstance(s, str):
            if s in _PLAIN:
                return _PLAIN[s], _decoder(s)
            for name in (s, f"{space}.{s}"):
                if name in within:
                    raise ValueError(f"{name} holds itself")
                if name in self.names:
                    return self.names[name]
            raise ValueError(f"no type named {s}")
        kind, logical = s["type"], s.get("logicalType")
        if isinstance(kind, (dict, list)):
            return self._of(kind, space, within)
        if kind == "array":
            inner, one = self._of(s["items"], space, within)
            return T.ArrayType(inner), lambda r: list(r.items(lambda: one(r)))
        if kind == "map":
            inner, one = self._of(s["values"], space, within)
            return T.MapType(T.StringType(), inner), lambda r: list(dict(r.items(lambda: (r.blob().decode(), one(r)))).items())
        if kind in ("record", "error", "enum", "fixed"):
            name = s["name"] if "." in s["name"] or not s.get("namespace", space) else f"{s.get('namespace', space)}.{s['name']}"
            self.names[name] = found = self._named(kind, s, name.rpartition(".")[0], (*within, name))
            return found
        if logical == "decimal" and kind == "bytes":
            return _decimal(s), lambda r, n=s.get("scale", 0): _unscaled(r.blob(), n)
        if (kind, logical) in _LOGICAL:
            unit = "days" if logical == "date" else "milliseconds" if "millis" in logical else "microseconds"
            base = date(1970, 1, 1) if logical == "date" else _EPOCH
            return _LOGICAL[kind, logical], lambda r: base + timedelta(**{unit: r.long()})
        return _PLAIN[kind], _decoder(kind)

    def _named(self, kind: str, s: dict, space: str, within: tuple[str, ...]) -> tuple[T.DataType, Callable[[Reader], object]]:
        if kind == "enum":
            symbols = s["symbols"]
            return T.StringType(), lambda r: _nth(symbols, r.long())
        if kind == "fixed":
            if s.get("logicalType") == "decimal":
                return _decimal(s), lambda r: _unscaled(r.take(s["size"]), s.get("scale", 0))
            return T.BinaryType(), lambda r: r.take(s["size"])
        fields = [(f["name"], *self._of(f["type"], space, within)) for f in s["fields"]]
        return T.StructType([T.StructField(n, t) for n, t, _ in fields]), lambda r: {n: one(r) for n, _, one in fields}

    def _union(self, kinds: list, space: str, within: tuple[str, ...]) -> tuple[T.DataType, Callable[[Reader], object]]:
        """One kind and null: that kind. Several: a struct of `member0`, `member1` and so on, one of which is set."""
        made = [None if k == "null" else self._of(k, space, within) for k in kinds]
        some = [m for m in made if m is not None]
        if len(some) <= 1:
            return (some[0][0] if some else T.NullType()), lambda r: None if (m := _nth(made, r.long())) is None else m[1](r)
        places = {i: f"member{k}" for k, i in enumerate(i for i, m in enumerate(made) if m is not None)}

        def one(r: Reader):
            i = r.long()
            m = _nth(made, i)
            return None if m is None else {places[i]: m[1](r)}

        return T.StructType([T.StructField(places[i], m[0]) for i, m in enumerate(made) if m is not None]), one


def _nth(of: list, i: int):
    if not 0 <= i < len(of):
        raise ValueError("no such branch")
    return of[i]


def _decoder(kind: str) -> Callable[[Reader], object]:
    number = lambda form, n: lambda r: struct.unpack(form, r.take(n))[0]
    return {
        "null": lambda r: None, "boolean": lambda r: r.take(1) != b"\0", "int": Reader.long, "long": Reader.long, "float": number("<f", 4), "double": number("<d", 8), "bytes": Reader.blob,
        "string": lambda r: r.blob().decode(),
    }[kind]


def _decimal(s: dict) -> T.DecimalType:
    return T.DecimalType(s["precision"], s.get("scale", 0))


def _unscaled(raw: bytes, scale: int) -> Decimal:
    return Decimal(int.from_bytes(raw, "big", signed=True)).scaleb(-scale)


def _unpacked(block: bytes, codec: str) -> bytes:
    if codec == "null":
        return block
    if codec == "deflate":
        return zlib.decompress(block, -15)
    if codec == "bzip2":
        import bz2

        return bz2.decompress(block)
    if codec == "xz":
        import lzma

        return lzma.decompress(block)
    if codec == "zstandard":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(block)
    raise ValueError(f"codec {codec}")


def blocks_of(files: DataFrame) -> DataFrame:
    """A row for each block of files, given as rows of path and content: path, at (its place), n (records), codec, schema, block, and reason where it is damaged.

    A block whose count, size or marker is wrong, or that is cut off, has a reason and its bytes; what follows the next marker is read
    on. A file that is no container is one such row.
    """

    def found(path: str, data: bytes) -> Iterator[tuple]:
        try:
            meta, sync, at = header(data)
        except (ValueError, UnicodeDecodeError) as e:
            yield path, 0, 0, None, None, data, str(e)
            return
        codec, schema = meta.get("avro.codec", b"null").decode(), meta.get("avro.schema", b"").decode()
        while at < len(data):
            r = Reader(data, at)
            try:
                n, block = r.long(), None
                block = r.blob()
                if n < 0 or r.take(SYNC) != sync:
                    raise ValueError("no marker after the block")
                yield path, at, n, codec, schema, block, None
                at = r.at
            except ValueError as e:
                after = data.find(sync, at)
                end = len(data) if after < 0 else after + SYNC
                yield path, at, 0, codec, schema, data[at:end], str(e)
                at = end

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string()]
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                for row in found(name, data.as_py()):
                    yield pa.record_batch([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], [x.split()[0] for x in _BLOCKS.split(", ")])

    return files.select("path", "content").mapInArrow(blocks, _BLOCKS)


def avro_schema(spark: SparkSession, path: str | list[str]) -> str:
    """The schema of one of the files, the first by name that has one; only the beginnings of files are looked at."""
    heads = spark.read.format("binaryFile").load(path).select("path", F.substring("content", 1, 1 << 20).alias("head"))
    for row in heads.orderBy("path").limit(20).collect():
        try:
            return header(bytes(row["head"]))[0]["avro.schema"].decode()
        except (ValueError, KeyError):
            continue
    raise ValueError("no Avro file found")


def read_avro(spark: SparkSession, path: str | list[str], schema: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, damaged) of container files, as `decoded`, by a schema or that of the first file."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return decoded(blocks_of(files), schema or avro_schema(spark, path))


def decoded(blocks: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """(rows, damaged) of blocks. Rows have the fields of the schema, as Spark types; `damaged` has path, at, n and reason of every
    block that can't be read, or that was written with a schema of other types or fields.

    A file is read by one task, which only finds its blocks; these are dealt out and decoded side by side. Codecs: null, deflate, bzip2,
    xz, zstandard. Kinds: all; date, timestamps and decimals as such, other logical kinds as what they are made of.
    """
    kind = Schema(text).type
    if not isinstance(kind, T.StructType):
        kind = T.StructType([T.StructField("value", kind)])
    arrow = to_arrow_schema(kind)
    wrap = not isinstance(Schema(text).type, T.StructType)
    dealt = blocks.repartition(F.col("path"), F.col("at"))
    both = T.StructType([T.StructField("row", kind), T.StructField("path", T.StringType()), T.StructField("at", T.LongType()), T.StructField("n", T.LongType()), T.StructField("reason", T.StringType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[str, Schema] = {}
        inner = pa.struct(list(arrow))
        outer = pa.schema([("row", inner), ("path", pa.string()), ("at", pa.int64()), ("n", pa.int64()), ("reason", pa.string())])

        def out(rows: list, path: str | None = None, at: int | None = None, n: int | None = None, reason: str | None = None) -> pa.RecordBatch:
            k = len(rows)
            return pa.record_batch([pa.array(rows, inner), *(pa.array([x] * k, t) for x, t in ((path, pa.string()), (at, pa.int64()), (n, pa.int64()), (reason, pa.string())))], schema=outer)

        for batch in batches:
            for b in batch.to_pylist():
                try:
                    if b["reason"]:
                        raise ValueError(b["reason"])
                    own = made.get(b["schema"]) or made.setdefault(b["schema"], Schema(b["schema"]))
                    if own.type != made.setdefault(text, Schema(text)).type:
                        raise ValueError("another schema")
                    r = Reader(_unpacked(b["block"], b["codec"]))
                    rows = [own.decode(r) for _ in range(b["n"])]
                    if r.at != len(r.data):
                        raise ValueError("bytes after the last record")
                    parts = [out([{"value": x} for x in rows[k : k + ROWS]] if wrap else rows[k : k + ROWS]) for k in range(0, len(rows), ROWS)]
                except Exception as e:  # a damaged block costs its own rows only
                    parts = [out([None], b["path"], b["at"], b["n"], str(e) or type(e).__name__)]
                yield from parts

    found = dealt.mapInArrow(decode, both)
    return found.where("reason is null").select("row.*"), found.where("reason is not null").select("path", "at", "n", "reason")
