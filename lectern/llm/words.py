"""Words, hashes and blocks of UTF-8 texts in numpy, shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_BYTES = 4 << 20
#: Bytes that are hashed at once, as hashing takes some sixty times their memory.
HASH_BYTES = 1 << 18

_byte = np.arange(256)
#: Bytes of a word, as WORD has it; UTF-8 bytes beyond ASCII always belong to one.
IN_WORD = ~((_byte == 0x20) | ((_byte >= 9) & (_byte <= 13)))
LOWER = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint8)
#: First byte of a code point.
LEADS = (_byte & 0xC0) != 0x80


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit (splitmix64's last step)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit constants that depend on the seed alone."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(steps + np.uint64(seed)) | np.uint64(1)


def as_bytes(texts) -> list[bytes]:
    """UTF-8 of each text; a null (None, NaN) is the empty text."""
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]


def blocks(sizes: Sequence[int], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of items of about `limit` bytes; a longer item stands alone."""
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield begin, i
            begin, held = i, 0
        held += size
    if begin < len(sizes):
        yield begin, len(sizes)


class Block:
    """The words of some texts laid end to end, a space after each.

    bounds[d] is where text d begins in `data`; starts/ends are the words' byte
    offsets, doc their text, first[d] the index of text d's first word.
    """

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        inside = IN_WORD[self.data]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
        self.starts, self.ends = edges[::2], edges[1::2]
        self.first = np.searchsorted(self.starts, self.bounds)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a byte-wise array over each text."""
        return np.add.reduceat(flags, self.bounds[:-1], dtype=np.int64)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """64 bits for each word: its bytes times fixed odd constants by position."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        lengths = self.ends - self.starts
        upto, factors = np.cumsum(lengths), stream(int(lengths.max()), 11)
        out, begin = np.empty(len(lengths), np.uint64), 0
        while begin < len(lengths):
            done = upto[begin] - lengths[begin]
            end = max(begin + 1, int(np.searchsorted(upto, done + HASH_BYTES, "right")))
            size = lengths[begin:end]
            first = upto[begin:end] - size - done
            flat = np.arange(size.sum()) - np.repeat(first, size)
            data = self.data[np.repeat(self.starts[begin:end], size) + flat]
            terms = ((LOWER[data] if lower else data).astype(np.uint64) + np.uint64(1)) * factors[flat]
            out[begin:end] = np.add.reduceat(terms, first)
            begin = end
        return mix(out)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """64 bits for each run of `width` consecutive words (also across texts)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j, factor in enumerate(stream(width, 23)):
        total += mix(hashes[j : j + n] + factor) * factor
    return mix(total)


def whole_windows(block: Block, width: int) -> np.ndarray:
    """True where a run of `width` words begins that stays within one text."""
    n = len(block.doc) - width + 1
    return block.doc[:n] == block.doc[width - 1 :] if n > 0 else np.zeros(0, bool)
