"""Words of whole texts as numpy arrays, for code that runs inside Spark tasks.

A batch of texts is handled at once: no Python object is made per word. Words are cut at
ASCII white space, hashed to 64 bits, and addressed by their number in the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Texts are handled together up to so many bytes; a longer text is handled alone.
GROUP_BYTES = 1 << 20

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# White space weighs nothing, so that the white bytes after a word leave its sum alone.
_BYTE = np.where(_WHITE, np.uint64(0), mix(np.arange(1, 257, dtype=np.uint64) * _ODD) | np.uint64(1))


def _powers(base: np.uint64, count: int) -> np.ndarray:
    powers = np.full(max(count, 1), base, dtype=np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


@dataclass(frozen=True)
class Words:
    """The words of a group of texts, text after text."""

    data: np.ndarray  # UTF-8 bytes of all texts, each closed by a line end
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # byte after each word
    first: np.ndarray  # number of the first word of each text, and the number of all words
    offsets: np.ndarray  # first byte of each text, and the number of all bytes

    @property
    def doc(self) -> np.ndarray:
        """Number of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        lengths = self.ends - self.starts
        in_word = ~_WHITE[self.data]
        place = np.arange(len(lengths)).repeat(lengths)
        within = np.flatnonzero(in_word) - self.starts[place]
        parts = _BYTE[self.data[in_word]] * _powers(_STEP, int(lengths.max()))[within]
        sums = np.add.reduceat(parts, np.cumsum(lengths) - lengths)
        return mix(sums + lengths.astype(np.uint64) * _ODD)


def cut(texts: list[bytes]) -> Words:
    data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    sizes = np.fromiter((len(text) + 1 for text in texts), dtype=np.int64, count=len(texts))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    white = _WHITE[data]
    before = np.concatenate([[True], white[:-1]])
    starts, ends = np.flatnonzero(before & ~white), np.flatnonzero(~before & white)
    return Words(data, starts, ends, np.searchsorted(starts, offsets), offsets)


def encode(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def groups(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in groups of about GROUP_BYTES: (number of the first text, the texts as bytes)."""
    first, held, size = 0, [], 0
    for number, text in enumerate(texts):
        raw = encode(text)
        if held and size + len(raw) > GROUP_BYTES:
            yield first, held
            first, held, size = number, [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield first, held


def chain(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` neighbouring values; runs are not kept inside a text."""
    if len(hashes) < length:
        return np.zeros(0, dtype=np.uint64)
    result, have = None, 0
    block, size, power = hashes, 1, _STEP
    bits = length
    with np.errstate(over="ignore"):
        while bits:
            if bits & 1:
                if result is None:
                    result, have = block, size
                else:
                    count = len(hashes) - have - size + 1
                    result, have = result[:count] * power + block[have : have + count], have + size
            bits >>= 1
            if bits:
                count = len(block) - size
                block = block[:count] * power + block[size : size + count]
                size, power = size * 2, power * power
    return mix(result[: len(hashes) - length + 1])
