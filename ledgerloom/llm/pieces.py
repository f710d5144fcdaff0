"""Texts as sequences of units that tokenizers encode apart, and what is known of recurring units.

A chunk of texts is cut as one array of bytes. Its distinct units come from Arrow's dictionary encoding, so that Python looks
at each of them once a chunk, however often it occurs; what units stand for is put together by array arithmetic.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa

#: Weight of what each of the two generations of a memory holds: bytes of units, and ``ENTRY`` for each of them.
KEPT = 45_000_000
ENTRY = 130
#: Bytes of text that are cut at once; a longer text is cut in segments.
CHUNK_BYTES = 4 << 20
#: Units that are joined into one text for the library, which is slower on longer texts.
JOINED = 150


def _flags() -> bytes:
    """For each byte the sum of what it is: see the constants below."""
    table = [0] * 256
    for flag, ranges in (
        (GRAPH, [(0x21, 0x7E)]), (SAFE, [(0x21, 0x7E), (0xC3, 0xDF), (0xE4, 0xEC), (0xF0, 0xF3)]), (TWO, [(0xC3, 0xDF)]),
        (ALPHA, [(0x41, 0x5A), (0x61, 0x7A)]), (MORE, [(0x80, 0xBF)]), (SPACE, [(32, 32)]), (LINE, [(10, 10)]),
    ):
        for first, last in ranges:
            for b in range(first, last + 1):
                table[b] |= flag
    for b in b".,;:!?":
        table[b] |= MARK
    return bytes(table)


#: Visible ASCII; what begins a character that is surely no white space; what begins one of two bytes, none of which is
#: white space; ASCII letter; a byte that is not a character's first; space; line break; sentence mark.
GRAPH, SAFE, TWO, ALPHA, MORE, SPACE, LINE, MARK = (1 << i for i in range(8))
_FLAGS = _flags()
_SEGMENT = re.compile(rb"(?<=[!-~]) (?=[!-~])")


def segments(raw: bytes, size: int = CHUNK_BYTES) -> Iterator[bytes]:
    """``raw`` in parts of about ``size`` bytes, each but the first beginning with a space between visible characters."""
    at = 0
    while len(raw) - at > size:
        near = _SEGMENT.search(raw, at + size)
        if near is None:
            break
        yield raw[at : near.start()]
        at = near.start()
    yield raw[at:]


class Units:
    """The units of some texts: ``names`` (distinct), ``index`` (their numbers in order) and ``ends`` (units up to each text's end).

    A unit begins at a space before a character that is no white space. If ``spaces_only``, the character before the space
    must be none either. Otherwise units also begin at a sentence mark behind an ASCII letter, and on either side of a
    line break between characters that are no white space. Where a byte does not tell, no unit begins.
    """

    def __init__(self, raws: list[bytes], spaces_only: bool) -> None:
        joined = b"".join(raws)
        data = np.frombuffer(joined, dtype=np.uint8)
        flags = np.frombuffer(joined.translate(_FLAGS), dtype=np.uint8)
        sizes = np.fromiter(map(len, raws), dtype=np.int64, count=len(raws))
        ends = np.cumsum(sizes)
        starts = ends - sizes
        n = len(data)
        spaces = np.flatnonzero(data[:-1] == 32)
        spaces = spaces[flags[spaces + 1] & SAFE != 0]
        cut = np.zeros(n + 1, dtype=bool)
        if spaces_only:
            cut[self._visible_before(flags, spaces)] = True
        else:
            cut[spaces] = True
            marks = np.flatnonzero(flags[1:] & MARK != 0) + 1
            cut[marks[flags[marks - 1] & ALPHA != 0]] = True
            lines = np.flatnonzero(data[:-1] == 10)
            lines = self._visible_before(flags, lines[flags[lines + 1] & SAFE != 0])
            # What lies on both sides of a text's border is no context.
            border = np.zeros(n + 1, dtype=bool)
            border[starts] = True
            lines = lines[~border[lines] & ~border[lines + 1]]
            cut[lines] = cut[lines + 1] = True
        last = ends[ends > starts] - 1
        cut[last[flags[last] & SPACE != 0]] = False  # a space that ends a text
        cut[starts] = True
        cut = cut[:n]
        bounds = np.flatnonzero(cut)
        found = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(bounds), [None, pa.py_buffer(np.append(bounds, n).astype(np.int64)), pa.py_buffer(data)]
        ).dictionary_encode()
        self.index = found.indices.to_numpy()
        self.names: list[bytes] = found.dictionary.to_pylist()
        self.ends = np.searchsorted(bounds, ends)

    @staticmethod
    def _visible_before(flags: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The places behind a character that is surely no white space."""
        places = places[places > 1]
        one, two = flags[places - 1], flags[places - 2]
        return places[(one & GRAPH != 0) | ((one & MORE != 0) & (two & TWO != 0))]


class Memory:
    """What is known of units, in two generations.

    New entries are young. When the young are too many, they become the old ones, and the old ones go, but for those
    that were asked for since, which are young again. So what recurs stays, and what came once does not push it out.
    """

    def __init__(self, kept: int = KEPT) -> None:
        self.kept, self.held = kept, 0
        self.young: dict[bytes, object] = {}
        self.old: dict[bytes, object] = {}

    def look_up(self, names: list[bytes], make: Callable[[list[bytes]], Iterable]) -> list:
        """The values of ``names`` (distinct); ``make`` gives those of new ones, none of them None."""
        found = list(map(self.young.get, names))
        missing = [i for i, value in enumerate(found) if value is None]
        if missing:
            asked = [names[i] for i in missing]
            values = list(map(self.old.get, asked))
            fresh = [k for k, value in enumerate(values) if value is None]
            for k, value in zip(fresh, make([asked[k] for k in fresh]), strict=True):
                values[k] = value
            for i, value in zip(missing, values, strict=True):
                found[i] = value
            self.young.update(zip(asked, values, strict=True))
            self.held += sum(map(len, asked)) + ENTRY * len(asked)
            if self.held > self.kept:
                self.old, self.young, self.held = self.young, {}, 0
        return found


def gathered(values: list[bytes], index: np.ndarray, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The arrays ``values[i]`` for ``i`` in ``index``, one behind the other, and where each of them ends."""
    lengths = np.fromiter(map(len, values), dtype=np.int64, count=len(values)) // dtype.itemsize
    flat = np.frombuffer(b"".join(values), dtype=dtype)
    first = np.cumsum(lengths) - lengths
    sizes = lengths[index]
    ends = np.cumsum(sizes)
    places = np.repeat(first[index] - (ends - sizes), sizes)
    places += np.arange(len(places))
    return flat[places], ends


def token_bytes(tokenizer) -> list[bytes]:
    """The bytes of each token of a byte-level vocabulary; of special tokens, their text."""
    # Byte-level alphabets write printable bytes as themselves, the others as the code points from 256 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}
    out = [b""] * tokenizer.get_vocab_size()
    for token, i in tokenizer.get_vocab().items():
        out[i] = special[i] if i in special else bytes(byte[c] for c in token)
    return out


class ByteLevel:
    """Ids by a byte-level tokenizer of the tokenizers library, each recurring unit encoded once.

    Its pre-tokenizer always begins a new pre-token at a space before a character that is no white space, where a letter
    is followed by a sentence mark, and on either side of a line break between characters that are no white space. So a text's
    ids are those of its ``Units``. New units are encoded many at once, joined to one text: behind their own spaces, or
    behind line breaks, which are one token each. The ids are parted by the number of bytes that they stand for.

    Special tokens in a text count as such, unless ``special_as_text``; texts with any are encoded as they are.
    """

    def __init__(self, path: str, special_as_text: bool = False, kept: int = KEPT) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.size = self.tokenizer.get_vocab_size()
        self.code = "H" if self.size <= 1 << 16 else "I"
        self.dtype = np.dtype("<u2" if self.code == "H" else "<u4")
        self.bytes_of = token_bytes(self.tokenizer)
        self.lengths = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.special = () if special_as_text else tuple(
            t.content for t in self.tokenizer.get_added_tokens_decoder().values()
        )
        self.known = Memory(kept)

    def alone(self, texts: list[str]) -> list[bytes]:
        """The ids of each text by the library itself."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in found]

    def _joined(self, units: list[bytes], lead: bytes) -> list[bytes]:
        """The ids of each unit, encoded together with ``lead`` before each, which is one token of one byte or nothing."""
        width, drop = self.dtype.itemsize, len(lead) * self.dtype.itemsize
        parts = [units[i : i + JOINED] for i in range(0, len(units), JOINED)]
        out: list[bytes] = []
        for part, ids in zip(parts, self.alone([(lead + lead.join(p)).decode() for p in parts]), strict=True):
            ends = np.cumsum(self.lengths[np.frombuffer(ids, self.dtype)])
            wanted = np.cumsum(np.fromiter(map(len, part), dtype=np.int64, count=len(part)) + len(lead))
            places = np.searchsorted(ends, wanted)
            if len(ends) and ends[-1] == wanted[-1] and np.array_equal(ends[places], wanted):
                cuts = [0, *((places + 1) * width).tolist()]
                out += [ids[a + drop : b] for a, b in pairwise(cuts)]
            else:
                out += self.alone([u.decode() for u in part])
        return out

    def encode_units(self, units: list[bytes]) -> list[bytes]:
        """The ids of units as ``Units`` cuts them."""
        kind = [
            (0 if u[0] == 32 else 1) if len(u) > 1 - (u[0] != 32) and _FLAGS[u[u[0] == 32]] & SAFE and _FLAGS[u[-1]] & GRAPH else 2
            for u in units
        ]
        out: list[bytes] = [b""] * len(units)
        for which, encode in enumerate((
            lambda some: self._joined(some, b""), lambda some: self._joined(some, b"\n"),
            lambda some: self.alone([u.decode() for u in some]),
        )):
            places = [i for i, k in enumerate(kind) if k == which]
            for i, ids in zip(places, encode([units[i] for i in places]), strict=True):
                out[i] = ids
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian numbers of ``dtype``."""
        if any(s in "\0".join(texts) for s in self.special):
            marked = [any(s in t for s in self.special) for t in texts]
            plain = iter(self.encode([t for t, m in zip(texts, marked, strict=True) if not m]))
            whole = iter(self.alone([t for t, m in zip(texts, marked, strict=True) if m]))
            return [next(whole if m else plain) for m in marked]
        raws = [t.encode() for t in texts]
        parts = [list(segments(r)) for r in raws]
        if sum(map(len, raws)) <= 2 * CHUNK_BYTES:
            found = self._encode_together([p for some in parts for p in some])
        else:
            found = (ids for some in parts for p in some for ids in self._encode_together([p]))
        found = iter(found)
        return [next(found) if len(some) == 1 else b"".join([next(found) for _ in some]) for some in parts]

    def _encode_together(self, raws: list[bytes]) -> list[bytes]:
        units = Units(raws, spaces_only=False)
        ids, ends = gathered(self.known.look_up(units.names, self.encode_units), units.index, self.dtype)
        raw = ids.tobytes()
        cuts = np.concatenate(([0], ends))[units.ends] * self.dtype.itemsize
        return [raw[a:b] for a, b in pairwise([0, *cuts.tolist()])]
