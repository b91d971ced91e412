"""Avro container files written here by hand: all kinds, codecs, and damaged blocks."""

import bz2
import datetime as dt
import json
import lzma
import struct
import zlib
from decimal import Decimal

import pytest
import zstandard

from tellurion.sources import avro

SYNC = bytes(range(16))


def number(n):
    n = (n << 1) ^ (n >> 63)
    out = b""
    while n >= 128:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def blob(x):
    x = x.encode() if isinstance(x, str) else x
    return number(len(x)) + x


PACK = {"null": lambda b: b, "deflate": lambda b: (c := zlib.compressobj(wbits=-15)).compress(b) + c.flush(), "bzip2": bz2.compress, "xz": lzma.compress, "zstandard": zstandard.ZstdCompressor().compress}


def container(schema, blocks, codec="null"):
    """blocks: lists of encoded records."""
    out = avro.MAGIC + number(2) + blob("avro.schema") + blob(json.dumps(schema)) + blob("avro.codec") + blob(codec) + number(0) + SYNC
    for rows in blocks:
        out += number(len(rows)) + blob(PACK[codec](b"".join(rows))) + SYNC
    return out


ALL = {
    "type": "record", "name": "a.Row", "fields": [
        {"name": "b", "type": "boolean"}, {"name": "i", "type": "int"}, {"name": "l", "type": "long"}, {"name": "f", "type": "float"}, {"name": "d", "type": "double"}, {"name": "y", "type": "bytes"}, {"name": "s", "type": "string"},
        {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["X", "Y"]}}, {"name": "x", "type": {"type": "fixed", "name": "Two", "size": 2}}, {"name": "a", "type": {"type": "array", "items": ["null", "long"]}},
        {"name": "m", "type": {"type": "map", "values": "E"}}, {"name": "o", "type": ["null", "string"]}, {"name": "u", "type": ["null", "string", "long"]}, {"name": "r", "type": {"type": "record", "name": "In", "fields": [{"name": "q", "type": "Two"}]}},
        {"name": "day", "type": {"type": "int", "logicalType": "date"}}, {"name": "ms", "type": {"type": "long", "logicalType": "timestamp-millis"}}, {"name": "us", "type": {"type": "long", "logicalType": "timestamp-micros"}},
        {"name": "dec", "type": {"type": "bytes", "logicalType": "decimal", "precision": 9, "scale": 2}}, {"name": "n", "type": "null"},
    ],
}


def record(i):
    return b"".join([
        bytes([i % 2]), number(-i), number(i << 40), struct.pack("<f", 1.5), struct.pack("<d", i / 4), blob(b"\0\xff"), blob(f"t{i}é"), number(1), b"zz", number(-2) + number(4) + number(1) + number(i) + number(0) + number(1) + number(1) + number(7) + number(0),
        number(1) + blob("k") + number(0) + number(0), number(0) if i % 2 else number(1) + blob("some"), number(2) + number(i) if i % 2 else number(1) + blob("u"), b"qq", number(i), number(1_700_000_000_123), number(1_700_000_000_123_456), blob((-12345).to_bytes(3, "big", signed=True)),
    ])


@pytest.mark.parametrize("codec", sorted(PACK))
def test_all_kinds(spark, tmp_path, codec):
    (tmp_path / "a.avro").write_bytes(container(ALL, [[record(0), record(1)], [], [record(2)]], codec))
    rows, damaged = avro.read_avro(spark, f"file://{tmp_path}")
    got = sorted(rows.collect(), key=lambda r: -r.i)
    assert damaged.count() == 0 and [r.i for r in got] == [0, -1, -2]
    r = got[1].asDict(recursive=True)
    assert r == {
        "b": True, "i": -1, "l": 1 << 40, "f": 1.5, "d": 0.25, "y": b"\0\xff", "s": "t1é", "e": "Y", "x": b"zz", "a": [1, None, 7], "m": {"k": "X"}, "o": None, "u": {"member0": None, "member1": 1}, "r": {"q": b"qq"},
        "day": dt.date(1970, 1, 2), "ms": dt.datetime(2023, 11, 14, 22, 13, 20, 123000), "us": dt.datetime(2023, 11, 14, 22, 13, 20, 123456), "dec": Decimal("-123.45"), "n": None,
    }
    assert got[0].o == "some" and got[0].u.member0 == "u"


def test_damaged_blocks_cost_their_own_rows(spark, tmp_path):
    one = {"type": "record", "name": "R", "fields": [{"name": "v", "type": "long"}]}
    whole = container(one, [[number(i)] for i in range(20, 24)])
    cut = bytearray(whole)
    at = whole.index(number(1) + blob(number(21)))
    cut[at + 1] = 120  # the size of the second block
    (tmp_path / "cut.avro").write_bytes(bytes(cut))
    (tmp_path / "end.avro").write_bytes(whole[:-10])
    (tmp_path / "none.avro").write_bytes(b"text")
    (tmp_path / "other.avro").write_bytes(container({"type": "record", "name": "R", "fields": [{"name": "v", "type": "string"}]}, [[blob("x")]]))
    (tmp_path / "extra.avro").write_bytes(container(one, [[number(30), number(31)]]).replace(number(2) + number(2) + number(30), number(1) + number(2) + number(30)))
    rows, damaged = avro.read_avro(spark, f"file://{tmp_path}", json.dumps(one))
    assert sorted(r.v for r in rows.collect()) == [20, 20, 21, 22, 22, 23]
    assert {r.path.split("/")[-1] for r in damaged.collect()} == {"cut.avro", "end.avro", "none.avro", "other.avro", "extra.avro"}


def test_plain_values_and_names(spark, tmp_path):
    (tmp_path / "l.avro").write_bytes(container("long", [[number(5), number(-6)]]))
    rows, _ = avro.read_avro(spark, f"file://{tmp_path}")
    assert sorted(r.value for r in rows.collect()) == [-6, 5]
    with pytest.raises(ValueError):
        avro.Schema(json.dumps({"type": "record", "name": "R", "fields": [{"name": "r", "type": ["null", "R"]}]}))
    with pytest.raises(ValueError):
        avro.Schema('"Unknown"')
