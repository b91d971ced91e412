"""Structures over shapes equal those of each text alone, for JSON and XML that is whole, nearly whole, or malformed."""

import json

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tellurion.operators import parse as L

SCALARS = st.none() | st.booleans() | st.integers() | st.floats() | st.text(max_size=6) | st.sampled_from(['a": ', "\\", '":', "\x01", "\x02", "5", ": 5", "é "])
VALUES = st.recursive(SCALARS, lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(max_size=4) | st.sampled_from(["k1", "a: ", '"', "\\", "0"]), x, max_size=4), max_leaves=12)


def alone(texts):
    return [s and s.encode(errors="replace").decode() for s in map(L._structure, texts)]


@settings(deadline=None, max_examples=300)
@given(st.lists(st.tuples(VALUES, st.sampled_from([None, 1, ", "]), st.integers(0, 400), st.sampled_from(["", '"', "\\", "0", "-", ".", ",", ":", "{", "]", "\x01", "\x02", "e", " ", "\t", "\\u12"])), max_size=6))
def test_json(cases):
    texts = []
    for value, form, at, put in cases:
        t = json.dumps(value, ensure_ascii=at % 2 == 0, separators=(",", " : ") if form == 1 else None)
        texts += [t, t[: at % (len(t) + 1)] + put + t[at % (len(t) + 1) :], t[: at % (len(t) + 1)]]
    texts += [None, "", " {} ", "[1,2,3]", '{"a":[1, 2 ,3],"b":["x" , "y"],"a":1}', '{"a":01}', '{"a":1 2}', '{"a"1:2}', "{\"a\":'x'}", '{"a":NaN,"b":-Infinity}', '["a":1]', '{"a":"b":"c"}', '{"a":"b""c"}']
    assert L.structures_of(pa.array(texts, pa.string())).to_pylist() == alone(texts)


PARTS = st.sampled_from(["<a>", "</a>", "<b x=\"1\">", "</b>", "<c/>", "text", "<!-- > -- < -->", "<![CDATA[ a > b < c ]]>", "&amp;", "&bad", "]]>", 'y="z"', "\x02", "<?p?>", "<", ">", '<d k="v" l="w>u"/>', "<e k='\"'/>", "\n"])


@settings(deadline=None, max_examples=300)
@given(st.lists(st.lists(PARTS, max_size=8).map(lambda p: "<a>" + "".join(p) + "</a>"), max_size=6))
def test_xml(texts):
    texts = [*texts, "<a><b>1</b><b>2</b></a>", "<134>x", None]
    assert L.structures_of(pa.array(texts, pa.string())).to_pylist() == alone(texts)
