"""Byte-level BPE text in words of the pre-tokenizer, so that each distinct word is encoded once.

The words of a block of texts are told by the classes of its bytes: letters, numbers,
white space and the rest. What a word is encoded to does not depend on its surroundings.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache
from itertools import islice
from unicodedata import category

import numpy as np
import pyarrow as pa
import regex
from tokenizers.pre_tokenizers import ByteLevel

#: The published pattern of this byte-level pre-tokenizer, which ``word_bounds`` follows, is
#: '(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)
_SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of each code point."""
    kinds = np.full(0x110000, _OTHER, np.uint8)
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern, known in ((_LETTER, r"\p{L}+", "a"), (_NUMBER, r"\p{N}+", "1")):
        found = "".join(regex.findall(pattern, points))
        kinds[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
        # Of characters newer than Python's tables, the library's version decides: it leaves them with a known one or not.
        newer = [c for c in found if category(c) == "Cn"]
        cuts = ByteLevel(add_prefix_space=False).pre_tokenize_str("".join(known + c for c in newer))
        cuts = {first for _, (first, _) in cuts}
        kinds[[ord(c) for i, c in enumerate(newer) if 2 * i + 1 in cuts]] = _OTHER
    kinds[_SPACES] = _SPACE
    return kinds


def _byte_classes(data: np.ndarray) -> np.ndarray:
    """The class of each byte's character."""
    kinds = _classes()
    out = kinds[:256][data]
    for first in range(0, len(data), 1 << 22):  # a large text needs no more room besides
        lead = first + np.flatnonzero(data[first : first + (1 << 22)] >= 0xC0)
        if not len(lead):
            continue
        size = 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)
        point = data[lead].astype(np.int64) & (0x7F >> size)
        for k in range(1, 4):
            has = size > k
            point[has] = point[has] << 6 | (data[lead[has] + k] & 0x3F)
        found = kinds[point]
        for k in range(4):
            has = size > k
            out[lead[has] + k] = found[has]
    return out


def word_bounds(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the words of texts begin, and the end. ``bounds``: of the texts in ``data``, their UTF-8 bytes."""
    n = len(data)
    opens = np.zeros(n + 1, bool)
    opens[bounds] = True
    if not n:
        return np.flatnonzero(opens)
    kind = _byte_classes(data)
    cut = opens.copy()
    cut[1:n] |= kind[1:] != kind[:-1]
    # Of white space in front of something the last character stands apart; a blank goes with what follows.
    space = kind == _SPACE
    behind = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    behind = behind[~opens[behind]]
    last = behind - 1
    for _ in range(2):
        last = last - ((data[last] & 0xC0) == 0x80)
    cut[last] = True
    cut[behind[data[last] == ord(" ")]] = False
    # A quote that begins a word takes certain letters, and the word ends there.
    quote = np.flatnonzero(data == ord("'"))
    quote = quote[cut[quote]]
    ahead = np.append(data, np.zeros(2, np.uint8))
    a, b = ahead[quote + 1], ahead[quote + 2]
    size = np.isin(a, list(b"stmd")) + 2 * (((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l")))
    inside = (size > 0) & ~opens[np.minimum(quote + 1, n)] & ((size < 2) | ~opens[np.minimum(quote + 2, n)])
    quote, size = quote[inside], size[inside]
    cut[quote + 1] = False
    cut[quote + 1 + size] = True
    return np.flatnonzero(cut)


def _found(data: np.ndarray, bounds: np.ndarray, mark: bytes) -> list[int]:
    """Where ``mark`` begins inside a text, from the left and without overlaps."""
    raw, out, at = data.tobytes(), [], 0
    while (at := raw.find(mark, at)) >= 0:
        if int(bounds[np.searchsorted(bounds, at, "right")]) < at + len(mark):
            at += 1  # over the border of two texts
        else:
            out.append(at)
            at += len(mark)
    return out


class ChunkCache:
    """Words to little-endian 32-bit ids, filled by ``encode``.

    ``encode`` maps a list of words to a list of id bytes. Beyond ``limit`` entries the
    newer half goes: what was met early is more often what is frequent.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], special: str | None, special_id: int | None, limit: int = 800_000):
        self.encode, self.special, self.limit = encode, special, limit
        self.ids: dict[str, bytes] = {} if special_id is None else {special: special_id.to_bytes(4, "little")}

    def _trim(self) -> None:
        if len(self.ids) > self.limit:
            self.ids = dict(islice(self.ids.items(), self.limit // 2))

    def _words(self, texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The words of all texts, and where each text's begin among them."""
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
        bounds = bounds - bounds[0]
        mark = (self.special or "").encode()
        marks = np.array(_found(data, bounds, mark) if mark else [], np.int64)
        if len(marks):
            # What stands beside the special token is encoded as a text of its own.
            starts = word_bounds(data, np.concatenate((bounds, marks, marks + len(mark))))
            at = np.searchsorted(marks, starts, "right") - 1
            starts = starts[(at < 0) | (starts == marks[at]) | (starts >= marks[at] + len(mark))]
        else:
            starts = word_bounds(data, bounds)
        words = pa.Array.from_buffers(pa.large_string(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(data)])
        return words.dictionary_encode(), np.searchsorted(starts, bounds)

    def ids_of(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text. Every distinct word of the texts is looked up once, new ones are encoded together."""
        self._trim()
        if not len(texts):
            return []
        coded, at = self._words(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string()))
        words: list[str] = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.ids.get, words))
        gaps = [i for i, v in enumerate(ids) if v is None]
        if gaps:
            new = [words[i] for i in gaps]
            learned = self.encode(new)
            self.ids.update(zip(new, learned))
            for i, v in zip(gaps, learned):
                ids[i] = v
        joined = pa.array(ids, pa.large_binary()).take(coded.indices)
        _, offsets, data = joined.buffers()
        cuts = np.frombuffer(offsets, np.int64)[: len(joined) + 1][at].tolist()
        data = memoryview(data) if data is not None else b""
        return [bytes(data[a:b]) for a, b in zip(cuts, cuts[1:])]


def specials(tokenizer_json: str) -> tuple[str | None, int | None]:
    """The one special token of the file; more than one is refused."""
    added = json.loads(tokenizer_json)["added_tokens"]
    if len(added) > 1:
        raise ValueError("only files with at most one added token are supported")
    return (added[0]["content"], added[0]["id"]) if added else (None, None)
