"""Log structure: fingerprints and templates (L1, L2), and parse steps."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellurion.functions.expressions import column, holds, java_pattern
from tellurion.operators.scans import fresh, running_count

DEPTH = 64


def _skeleton(x, depth: int = 0, root: bool = True) -> str:
    """Names stay, values become their kind; lists below the root are one kind."""
    if depth > DEPTH:
        raise ValueError("too deep")
    if isinstance(x, list) and not root:
        return "<arr>"
    if isinstance(x, dict):
        return "{" + ",".join(f"{k}:{_skeleton(v, depth + 1, False)}" for k, v in x.items()) + "}"
    if isinstance(x, list):
        return "[" + ",".join(_skeleton(v, depth + 1, False) for v in x) + "]"
    return "<txt>" if isinstance(x, str) else "<val>"


def _xml_skeleton(text: str) -> str:
    from xml.etree import ElementTree

    if "<!DOCTYPE" in text or "<!ENTITY" in text:
        raise ValueError("document types are not read")

    def walk(e) -> str:
        parts = [walk(c) for c in e]
        once = [p for i, p in enumerate(parts) if not i or p != parts[i - 1]]
        return f"<{e.tag}{''.join(' ' + a for a in e.attrib)}>{''.join(once)}</{e.tag}>"

    return walk(ElementTree.fromstring(text))


def _structure(text: str | None) -> str | None:
    s = (text or "").strip()
    try:
        if s[:1] in "{[" and s:
            return "json:" + _skeleton(json.loads(s))
        if s[:1] == "<" and not re.match(r"<\d{1,3}>", s):
            return "xml:" + _xml_skeleton(s)
    except Exception:  # malformed text has no fingerprint
        return None
    return None


#: Shapes whose structure a worker keeps.
_KEPT = 50_000
_BYTES = np.arange(256)
_BLANK, _DIGIT = np.isin(_BYTES, [9, 10, 13, 32]), (_BYTES >= 48) & (_BYTES <= 57)
_HEX, _ESCAPABLE = np.isin(_BYTES, list(b"0123456789abcdefABCDEF")), np.isin(_BYTES, list(b'"\\/bfnrtu'))
_NUMERIC = _DIGIT | np.isin(_BYTES, list(b"+-.eE"))


def _rows_with(places: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which rows hold at least one of these places, which are in order."""
    return np.searchsorted(places, offsets[1:]) > np.searchsorted(places, offsets[:-1])


def json_shapes(texts: pa.Array) -> pa.Array:
    """JSON texts with every string that is no name as "", every whole or decimal number as 0, and such neighbours in lists once.

    A structural index over the bytes of all texts: a quote counts unless an odd number of backslashes stands before it; quotes so far
    tell strings from the rest; a string before a colon is a name. A text with a string that is malformed stays as it is, and
    so does a number that is malformed or has an exponent: a text is malformed just if its shape is. Null stays null.
    """
    texts = texts.cast(pa.large_string())
    kept = texts.drop_null()
    if not len(kept):
        return texts
    _, off, raw = kept.buffers()
    offsets = np.frombuffer(off, np.int64)[kept.offset : kept.offset + len(kept) + 1]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    n = len(data)
    odd = np.zeros(len(kept), bool)  # rows that stay as they are
    quote = data == 34
    slash = np.flatnonzero(data == 92)
    if len(slash):
        fresh_run = np.concatenate([[True], np.diff(slash) > 1])
        first = slash[np.maximum.accumulate(np.where(fresh_run, np.arange(len(slash)), 0))]
        escapes = slash[(slash - first) % 2 == 0]  # every second of a run escapes what follows
        after = np.minimum(escapes + 1, n - 1)
        quote[after] = False
        bad = escapes[(escapes + 1 >= n) | ~_ESCAPABLE[data[after]]]
        u = after[data[after] == 117]
        padded = np.concatenate([data, np.zeros(5, np.uint8)])
        bad_u = u[~(_HEX[padded[u + 1]] & _HEX[padded[u + 2]] & _HEX[padded[u + 3]] & _HEX[padded[u + 4]])]
        odd |= _rows_with(np.sort(bad), offsets) | _rows_with(bad_u, offsets)
    at = np.flatnonzero(quote)
    upto = np.searchsorted(at, offsets)
    odd |= np.diff(upto) % 2 == 1
    # rows of an odd number of quotes are left alone, so the rest pair up
    row_of = np.repeat(np.arange(len(kept)), np.diff(upto))
    at = at[~odd[row_of]]
    opens, closes = at[::2], at[1::2]
    inside = np.zeros(n + 1, np.int8)
    inside[opens] += 1
    inside[closes + 1] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
    control = np.flatnonzero(inside & (data < 32))
    odd |= _rows_with(control, offsets)
    solid = np.flatnonzero(~_BLANK[data])
    following = np.searchsorted(solid, closes + 1)
    next_at = solid[np.minimum(following, len(solid) - 1)] if len(solid) else closes
    named = (following < len(solid)) & (data[next_at] == 58) & (next_at < offsets[1:][np.searchsorted(offsets, closes, "right") - 1])
    value = ~named
    drop = np.zeros(n + 1, np.int8)
    drop[opens[value] + 1] += 1
    drop[closes[value]] -= 1
    brackets = np.flatnonzero(data == 91)
    if len(opens) and len(brackets):  # a name that holds a bracket might look like a list below
        within = np.searchsorted(opens, brackets) - 1
        odd |= _rows_with(brackets[inside[brackets] & named[np.maximum(within, 0)]], offsets)
    out = data.copy()
    # numbers: runs of their characters outside of strings, of digits with at most a sign before them and a point within
    numeric = _NUMERIC[data] & ~inside
    edge = np.flatnonzero(np.diff(numeric.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    starts, ends = edge[::2], edge[1::2]
    one_row = np.searchsorted(offsets, starts, "right") == np.searchsorted(offsets, ends - 1, "right")
    starts, ends = starts[one_row], ends[one_row]
    dot = np.flatnonzero(data == 46)
    other = np.flatnonzero(numeric & ~_DIGIT[data])  # signs, points and exponents
    sign = (data[starts] == 45).astype(np.int64) if len(starts) else np.zeros(0, np.int64)
    begin = np.minimum(starts + sign, n - 1)
    size = ends - starts - sign
    dots = np.searchsorted(dot, ends) - np.searchsorted(dot, starts)
    count = ends - starts - (np.searchsorted(other, ends) - np.searchsorted(other, starts))
    lead = (data[begin] != 48) | (size == 1) | (data[np.minimum(begin + 1, n - 1)] == 46)
    plain = (size > 0) & (dots <= 1) & (count + dots == size) & lead & _DIGIT[data[begin]] & _DIGIT[data[ends - 1]]
    starts, ends = starts[plain], ends[plain]
    out[starts] = 48
    drop[starts + 1] += 1
    drop[ends] -= 1
    drop = np.cumsum(drop[:-1], dtype=np.int8).astype(bool)
    if odd.any():
        whole = np.repeat(odd, np.diff(offsets))
        drop &= ~whole
        out[whole] = data[whole]
    keep = ~drop
    sizes = np.concatenate([[0], np.cumsum(keep, dtype=np.int32)])[offsets]
    shapes = pa.LargeStringArray.from_buffers(len(kept), pa.py_buffer(sizes.astype(np.int64)), pa.py_buffer(out[keep]))
    lists = shapes
    for one in ('""', "0"):
        lists = pc.replace_substring_regex(lists, rf"\[[ \t\r\n]*{one}(?:[ \t\r\n]*,[ \t\r\n]*{one})+", f"[{one}")
    shapes = pc.if_else(pc.and_(pc.starts_with(shapes, "{"), pa.array(~odd)), lists, shapes)
    if len(kept) == len(texts):
        return shapes
    places = np.cumsum(np.asarray(texts.is_valid())) - 1
    return shapes.take(pa.array(places, mask=np.asarray(texts.is_null())))


#: What may stand in XML between tags, and in an attribute, where it is neither markup nor malformed.
_XML_TEXT, _XML_VALUE = r"[^<&\]\x00-\x08\x0b\x0c\x0e-\x1f\x{fffe}\x{ffff}]", r'[^"<&\x00-\x1f\x{fffe}\x{ffff}]'


def xml_shapes(texts: pa.Array) -> pa.Array:
    """XML texts without what stands between tags and in attributes; entities and the like stay, as malformed text does."""
    texts = pc.replace_substring_regex(texts, rf'="{_XML_VALUE}*"', '=""')
    return pc.replace_substring_regex(texts, rf">{_XML_TEXT}+<", "><")


_SHAPES: dict[str, str | None] = {}


def structures_of(texts: pa.Array) -> pa.Array:
    """The structure of each JSON or XML text; texts of one shape are parsed once."""
    texts = pc.utf8_trim_whitespace(texts).cast(pa.large_string())
    is_json = pc.fill_null(pc.match_substring_regex(texts, r"^[{\[]"), False)
    is_xml = pc.fill_null(pc.and_(pc.starts_with(texts, "<"), pc.invert(pc.match_substring_regex(texts, "<[!?]"))), False)
    none = pa.scalar(None, texts.type)
    shapes = pc.coalesce(json_shapes(pc.if_else(is_json, texts, none)), xml_shapes(pc.if_else(is_xml, texts, none)), texts).dictionary_encode()
    out = []
    for shape in shapes.dictionary.to_pylist():
        if shape not in _SHAPES:
            if len(_SHAPES) >= _KEPT:
                _SHAPES.clear()
            found = _structure(shape)
            _SHAPES[shape] = found and found.encode(errors="replace").decode()  # a name may escape half a pair
        out.append(_SHAPES[shape])
    return pa.array(out, pa.string()).take(shapes.indices) if out else pa.nulls(len(texts), pa.string())


@F.arrow_udf(T.StringType())
def _structures(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in parts:
        yield structures_of(texts)


CLF = r'^(\S+) (\S+) (\S+) \[[^\]]+\] "([A-Z]+) ([^ "?]+)[^"]*" (\d{3}) (\d+|-)(.*)$'
SYSLOG_3164 = r"^<\d{1,3}>[A-Z][a-z]{2} [ \d]\d \d\d:\d\d:\d\d \S+ ([^\s:\[]+)(?:\[\d+\])?: ?(.*)$"
SYSLOG_5424 = r"^<\d{1,3}>\d \S+ \S+ (\S+) \S+ \S+ (?:-|(?:\[.*?\])+) ?(.*)$"


def structure(col: str | Column) -> Column:
    """A log's structure as text (JSON, XML, syslog or common log format), null if it has none.

    JSON: names and kinds of values; XML: elements and attribute names, equal neighbours once; common log format: request without
    query, path parts with a digit as one kind; syslog: the program, and the structure of the message where it is one of the others.
    The text to look at is chosen first, so JSON and XML take one pass of Python, and only texts that begin like them go there.
    """
    c = F.col(col) if isinstance(col, str) else col
    forms = (SYSLOG_5424, SYSLOG_3164)
    heads = F.startswith(c, F.lit("<")) & F.substring(c, 2, 1).between("0", "9")
    program = F.when(heads, F.coalesce(*[F.when(c.rlike(rx), F.regexp_extract(c, rx, 1)) for rx in forms]))
    text = F.coalesce(F.when(heads, F.coalesce(*[F.when(c.rlike(rx), F.regexp_extract(c, rx, 2)) for rx in forms])), c)
    path = F.regexp_replace(F.regexp_extract(text, CLF, 5), r"[^/]*\d[^/]*", "<val>")
    clf = F.when(text.rlike(CLF), F.concat(F.lit("clf:"), F.regexp_extract(text, CLF, 4), F.lit(" "), path))
    plain = F.coalesce(_structures(F.when(text.rlike(r"^\s*[{\[<]"), text)), clf)
    return F.when(program.isNotNull(), F.concat(F.lit("syslog:"), program, F.lit(":"), F.coalesce(plain, F.lit("")))).otherwise(plain)


def fingerprint(col: str | Column) -> Column:
    """Hex fingerprint of a log's structure, null if it has none. Equal structures have equal fingerprints."""
    found = structure(col)
    return F.when(found.isNotNull(), F.lower(F.hex(F.xxhash64(found))))


def mine_templates(df: DataFrame, col: str) -> DataFrame:
    """Rows of each fingerprint, with the least of its texts as an example."""
    rows = df.select(fingerprint(col).alias("fingerprint"), F.col(col).alias("example")).where("fingerprint is not null")
    return rows.groupBy("fingerprint").agg(F.count("*").alias("n"), F.min("example").alias("example"))


#: Stands between the groups of a match while they are one text: a private character and a control character.
_BETWEEN = "\uf8ff\x01"


def group_names(pattern: str) -> list[str]:
    """The names of a pattern's groups, in order."""
    return re.findall(r"\(\?P?<([A-Za-z_]\w*)>", pattern)


def _anchored(pattern: str) -> bool:
    """Whether the pattern can match only at the beginning: it starts with ^ and has no alternatives outside of groups."""
    depth, i, inside = 0, 1, False
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 2
            continue
        if inside:
            inside = c != "]" or pattern[i - 1] == "["
        elif c == "[":
            inside = True
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "|" and not depth:
            return False
        i += 1
    return pattern.startswith("^")


def captured(text: Column, pattern: str) -> Column:
    """The pattern's named groups, in order, as an array; null where it doesn't match.

    One replacement of the whole text gives all groups and tells whether it matched. A text that holds U+F8FF before U+0001 gives null.
    """
    names = group_names(pattern)
    bare = re.compile(re.sub(r"\(\?<([A-Za-z_])", r"(?P<\1", pattern.replace("(?P<", "(?<")))
    java = re.sub(r"\(\?<[A-Za-z_]\w*>", "(", java_pattern(re.sub(r"\(\?P<", "(?<", pattern)))
    whole = rf"\A(?:{java})(?s:.)*\z" if _anchored(pattern) else rf"\A(?s:.)*?(?:{java})(?s:.)*\z"
    marked = _BETWEEN.join(["", *(f"${bare.groupindex[n]}" for n in names)])
    parts = F.split(F.regexp_replace(text, F.lit(whole), F.lit(marked)), _BETWEEN)
    return F.when(~F.contains(text, F.lit(_BETWEEN)), F.get(F.filter(F.array(parts), lambda p: F.size(p) == len(names) + 1), F.lit(0)))


def regex_parse(df: DataFrame, col: str, pattern: str, into: str = "parsed") -> DataFrame:
    """Add a struct of the pattern's named groups, null where it doesn't match; rows stay, and so do all other columns."""
    names = group_names(pattern)
    own = "_groups" + "_" * max(len(c) for c in df.columns)
    df = df.withColumn(own, captured(F.col(col), pattern))
    found = F.struct(*[F.col(own)[i + 1].alias(n) for i, n in enumerate(names)])
    return df.withColumn(into, F.when(F.col(own).isNotNull(), found)).drop(own)


def json_parse(df: DataFrame, col: str, schema: str | None = None, into: str = "parsed") -> DataFrame:
    """Add the parsed JSON: by a schema, or as a variant; null where it is malformed."""
    return df.withColumn(into, F.from_json(col, schema) if schema else F.try_parse_json(col))


def delimited_parse(df: DataFrame, col: str, header: str, delimiter: str = ",", quotes: bool = True, into: str = "parsed") -> DataFrame:
    """Add a map from the header's names to the fields of a delimited line; null if their numbers differ."""
    names = [h.strip() for h in header.split(delimiter)]
    if quotes:
        schema = ", ".join([*(f"c{i} string" for i in range(len(names))), "bad string"])  # `bad`: a line with more or fewer fields
        got = F.from_csv(col, schema, {"sep": delimiter, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"})
        fields = F.array(*[got[f"c{i}"] for i in range(len(names))])
        return df.withColumn(into, F.when(got["bad"].isNull(), F.map_from_arrays(F.array(*[F.lit(n) for n in names]), fields)))
    fields = F.split(col, re.escape(delimiter))
    return df.withColumn(into, F.when(F.size(fields) == len(names), F.map_from_arrays(F.array(*[F.lit(n) for n in names]), fields)))


def headed_parse(df: DataFrame, col: str, file: str, line_no: str, mark: str = "#Fields: ", delimiter: str = " ", into: str = "parsed") -> DataFrame:
    """Rows of delimited lines, with a map from the names of their file's last header line before them to their fields.

    Header lines begin with `mark`; they and other lines that begin with its first character give no rows. Lines before any header,
    and lines with another number of fields than their header, have a null map. Lines are numbered by the headers before them, in
    slices side by side, and meet their header by file and number.
    """
    number, names = fresh(df, "_header"), fresh(df, "_names")
    counted = running_count(df, F.col(col).startswith(mark), [line_no], [file], number)
    heads = counted.where(F.col(col).startswith(mark))
    heads = heads.select(F.col(file).alias("_file"), F.col(number).alias("_number"), F.split(F.trim(F.substring(F.col(col), len(mark) + 1, F.length(col))), re.escape(delimiter)).alias(names))
    lines = counted.where(~F.col(col).startswith(mark[0]))
    met = lines.join(heads, F.col(file).eqNullSafe(F.col("_file")) & (F.col(number) == F.col("_number")), "left")
    fields = F.split(F.col(col), re.escape(delimiter))
    return met.withColumn(into, F.when(F.size(fields) == F.size(names), F.map_from_arrays(names, fields))).drop("_file", "_number", number, names)


def uri_parse(df: DataFrame, col: str, into: str = "uri") -> DataFrame:
    """Add scheme, host, path and query of a URI, each null where it is missing or the URI malformed."""
    part = lambda p: F.try_parse_url(F.col(col), F.lit(p))
    return df.withColumn(into, F.struct(part("PROTOCOL").alias("scheme"), part("HOST").alias("host"), part("PATH").alias("path"), part("QUERY").alias("query")))


def time_parse(df: DataFrame, col: str, layout: str, tz: str = "UTC", into: str = "ts") -> DataFrame:
    """Add the time of a text in a layout, read in a time zone; null where it doesn't fit."""
    at = F.try_to_timestamp(F.col(col), F.lit(layout))
    return df.withColumn(into, at if tz == "UTC" else F.to_utc_timestamp(at, tz))


def severity(df: DataFrame, col: str, levels: Sequence[tuple[int, str | Column]], default: int = 0, into: str = "severity_number") -> DataFrame:
    """Add a severity number: of the first condition that holds, or of a text condition `4xx` or `400-499` on the column."""
    out = F.lit(default)
    for number, cond in reversed(levels):
        if isinstance(cond, str) and re.fullmatch(r"\dxx", cond):
            c = F.floor(F.col(col).try_cast("int") / 100) == int(cond[0])
        elif isinstance(cond, str) and (m := re.fullmatch(r"(\d+)-(\d+)", cond)):
            c = F.col(col).try_cast("int").between(int(m[1]), int(m[2]))
        else:
            c = column(cond)
        out = F.when(holds(c), F.lit(number)).otherwise(out)
    return df.withColumn(into, out)


def assemble_multiline(df: DataFrame, line: str, start: str, file: str, line_no: str) -> DataFrame:
    """file, record, text: the lines of one record, which begins where a line matches `start`; lines before the first such are a record.
    A file of any length is numbered in slices side by side. Null lines are left out of a text; other columns are dropped."""
    rows = df.select(F.col(file).alias("f"), F.col(line_no).alias("n"), F.col(line).alias("t"))
    numbered = running_count(rows, F.col("t").rlike(java_pattern(start)), ["n"], ["f"], "record")
    parts = numbered.groupBy("f", "record").agg(F.array_sort(F.collect_list(F.struct("n", "t"))).alias("l"))
    return parts.select(F.col("f").alias(file), "record", F.array_join(F.transform("l", lambda x: x["t"]), "\n").alias("text"))


def recombine(df: DataFrame, source: str, is_last: str | Column, field: str, order: str) -> DataFrame:
    """source, record, field: the parts of each source up to the one that is last; a source's open rest is a record too. A source of
    any length is numbered in slices side by side. Other columns are dropped."""
    rows = df.select(F.col(source).alias("s"), F.col(order).alias("n"), F.col(field).alias("t"), holds(is_last).alias("last"))
    numbered = running_count(rows, F.col("last"), ["n"], ["s"], "upto").withColumn("record", F.col("upto") - F.col("last").cast("int"))
    parts = numbered.groupBy("s", "record").agg(F.array_sort(F.collect_list(F.struct("n", "t"))).alias("l"))
    return parts.select(F.col("s").alias(source), "record", F.array_join(F.transform("l", lambda x: x["t"]), "").alias(field))
