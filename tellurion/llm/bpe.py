"""BPE over whole texts: numpy finds the pieces, the tokenizers library encodes each different piece once."""

from __future__ import annotations

import json
import os
from array import array

import numpy as np
import pyarrow as pa

from .common import Words, flat, split

LETTER, NUMBER, SPACE = 1, 2, 3
#: Pieces in each of two generations that one worker keeps: those met since the last change, and those met before it.
#: A piece in neither is encoded again, so memory stays bounded and results the same. Pieces of more bytes are not kept.
GENERATION, LONGEST = 200_000, 64


def _classes() -> np.ndarray:
    """Class of each code point, as the regex engine has them."""
    import regex

    out, step = np.zeros(0x110000, np.uint8), 1 << 13
    for a in [*range(0, 0xD800, step), *range(0xE000, 0x110000, step)]:  # no text holds the surrogates between
        some = "".join(map(chr, range(a, min(a + step, 0xD800) if a < 0xD800 else a + step)))
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for m in regex.finditer(pattern, some):
                out[a + m.start() : a + m.end()] = kind
    return out


def _byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Encoder:
    """encode(texts) gives all ids and their number per text, equal to Tokenizer.encode(text, add_special_tokens=False)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, models, pre_tokenizers

        t = self.tokenizer = Tokenizer.from_file(path)
        pre = t.pre_tokenizer
        byte_level = isinstance(t.model, models.BPE) and t.normalizer is None and isinstance(pre, pre_tokenizers.ByteLevel)
        self.by_piece = byte_level and pre.use_regex and not pre.add_prefix_space
        self.added = [x.content.encode() for x in t.get_added_tokens_decoder().values()]
        self.classes = _classes()
        self.latin = str.maketrans({chr(b): c for b, c in _byte_chars().items()})
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def pieces(self, raw: np.ndarray, offsets: np.ndarray) -> Words:
        """The matches of 's|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?[^sLN]+|s+(?!S)|s+ in each text, by runs of one class."""
        points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
        n = len(points)
        lead = np.flatnonzero((raw & 0xC0) != 0x80)
        first = np.zeros(n + 1, bool)
        first[np.searchsorted(lead, offsets)] = True
        first[n] = True
        c = self.classes[points]
        run = first[:n].copy()
        run[1:] |= c[1:] != c[:-1]
        after = np.zeros(n, bool)  # a plain space stands before, in the same text
        after[1:] = (points[:-1] == 32) & ~first[1:n]
        space = c == SPACE
        begins = run & (space | ~after)
        last = np.zeros(n, bool)  # of white space that other characters follow
        last[:-1] = space[:-1] & ~space[1:] & ~first[1:n]
        begins |= last
        mark = np.flatnonzero((points == 39) & run & ~after)
        mark = mark[mark + 1 < n]
        mark = mark[(c[mark + 1] == LETTER) & ~first[mark + 1]]
        one = mark[np.isin(points[mark + 1], [ord(x) for x in "stmd"])]
        two = mark[mark + 2 < n]
        two = two[~first[two + 2]]
        two = two[np.any([(points[two + 1] == ord(x)) & (points[two + 2] == ord(y)) for x, y in ("re", "ve", "ll")], axis=0)]
        for at, k in ((one, 2), (two, 3)):
            begins[at + 1] = False
            rest = at[at + k < n] + k
            begins[rest[(c[rest] == LETTER) & ~first[rest]]] = True
        start = lead[begins]
        end = np.append(start[1:], len(raw)) if len(start) else start
        return Words(raw, start, end, np.diff(np.searchsorted(start, offsets)))

    def ids_of(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as little-endian unsigned 32-bit integers."""
        if len(self.young) > GENERATION:
            self.old, self.young = self.young, {}
        tokenize, latin, young, old, out = self.tokenizer.model.tokenize, self.latin, self.young, self.old, []
        for piece in pieces:
            ids = young.get(piece)
            if ids is None:
                ids = old.get(piece)
                if ids is None:
                    ids = array("I", [t.id for t in tokenize(piece.decode("latin-1").translate(latin))]).tobytes()
                if len(piece) <= LONGEST:
                    young[piece] = ids
            out.append(ids)
        return out

    def whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        got = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(["" if t is None else t for t in texts.to_pylist()], add_special_tokens=False)]
        return np.concatenate([np.zeros(0, np.uint32), *got]), np.array([len(g) for g in got], np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        raw, offsets = flat(texts)
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        text = raw.tobytes()
        if not self.by_piece or any(x in text for x in self.added):
            return self.whole(texts)
        w = self.pieces(raw, offsets)
        _, at, back = np.unique(w.hashes(), return_index=True, return_inverse=True)
        if not w.equal(at[back], np.arange(len(back))).all():  # two pieces share a hash
            return self.whole(texts)
        found = self.ids_of([text[a:b] for a, b in zip(w.start[at].tolist(), w.end[at].tolist(), strict=True)])
        known, size = np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4
        length, begin = size[back], (np.cumsum(size) - size)[back]
        upto = np.cumsum(length)
        ids = known[np.arange(upto[-1]) + np.repeat(begin - upto + length, length)]
        return ids, np.diff(np.concatenate([[0], upto])[w.first])


#: Words between white space; byte 0 is part of words and stands as 255, which no UTF-8 text holds.
_BLANK = np.array([0 if b in (9, 10, 11, 12, 13, 32) else b or 255 for b in range(256)], np.uint8)
_ALPHA = np.array([65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])
#: Words that are encoded as one text.
JOINED = 512


class WordEncoder(Encoder):
    """encode(texts) for vocabularies that never look past white space: each different word between blanks is encoded once.

    That holds if texts are only composed (NFC), lower-cased and their white space made alike, and then cut by a pattern whose
    matches hold no white space. With any other tokenizer texts are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark fills the cores
        t = self.tokenizer = Tokenizer.from_file(path)
        form = json.loads(t.to_str())
        parts = lambda x, key: (x or {}).get(key, [x] if x else [])
        normal, pre = parts(form["normalizer"], "normalizers"), parts(form["pre_tokenizer"], "pretokenizers")
        alike = all(x["type"] in ("NFC", "Lowercase") or (x["type"] == "Replace" and x["pattern"] == {"Regex": r"\s+"} and x["content"] == " ") for x in normal)
        first = pre[0] if pre else {"type": None}
        cut = first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"] and r"[^\s" in first["pattern"].get("Regex", "") and " " not in first["pattern"]["Regex"]
        rest = all(x["type"] == "ByteLevel" and not x["add_prefix_space"] and not x["use_regex"] for x in pre[1:])
        self.by_piece = bool(alike and cut and rest)
        self.added = [x.content.encode() for x in t.get_added_tokens_decoder().values()]
        self.young, self.old = {}, {}
        suffix = form["model"].get("end_of_word_suffix")
        vocabulary = t.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # the last token of each word
        self.ends[[i for x, i in vocabulary.items() if suffix and x.endswith(suffix)]] = True
        self.by_piece = self.by_piece and bool(suffix)

    def pieces(self, raw: np.ndarray, offsets: np.ndarray) -> Words:
        """Words between white space, cut where an ASCII letter and another ASCII character meet, but not after an apostrophe, with
        which a contraction may begin."""
        alpha, plain = _ALPHA[raw], raw < 128
        before = np.zeros(len(raw), bool)
        before[1:] = (alpha[1:] != alpha[:-1]) & plain[1:] & plain[:-1] & (raw[:-1] != 39)
        return split(raw, offsets, _BLANK, before)

    def ids_of(self, pieces: list[bytes]) -> list[bytes]:
        if len(self.young) > GENERATION:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        out = [young.get(p) or old.get(p) for p in pieces]
        new = [k for k, ids in enumerate(out) if ids is None]
        texts = [pieces[k].decode() for k in new]
        words = [k for k, x in enumerate(texts) if x.isalpha()]
        rest = [k for k, x in enumerate(texts) if not x.isalpha()]
        runs = [words[a : a + JOINED] for a in range(0, len(words), JOINED)]
        encode = lambda some: self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
        for run, e in zip(runs, encode([" ".join([texts[k] for k in run]) for run in runs]), strict=True):
            ids = np.array(e.ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(run):  # a word of several parts, such as one with a mark that lower-casing splits off
                rest += run
                continue
            raw, at = ids.tobytes(), 0
            for k, end in zip(run, (4 * ends).tolist(), strict=True):
                out[new[k]] = raw[at:end]
                at = end
        for k, e in zip(rest, encode([texts[k] for k in rest]), strict=True):
            out[new[k]] = array("I", e.ids).tobytes()
        for piece, ids in zip(pieces, out, strict=True):
            if len(piece) <= LONGEST and ids:
                young[piece] = ids
        return out
