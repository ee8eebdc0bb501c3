"""64-bit hashes of words and of runs of words."""

from __future__ import annotations

#: Words whose hashes a worker remembers.
MEMO = 300_000


class _Hashes(dict):
    """Word to 64 bits; remembers the first MEMO words."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < MEMO:
            self[word] = h
        return h


_HASHES = _Hashes()


def word_hashes(words: list[bytes]):
    import numpy as np

    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def run_hashes(h, n: int):
    """For each place, a hash of the n words from it: a polynomial modulo 2**64, from sums of
    prefixes, since the odd base has an inverse; then mixed."""
    import numpy as np

    if len(h) < n:
        return np.empty(0, np.uint64)
    base = 0x9E3779B97F4A7C15 | 1
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        down = np.cumprod(np.full(len(h), inverse, np.uint64))
        up = np.cumprod(np.full(len(h), base, np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * down, dtype=np.uint64)])
        x = (sums[n:] - sums[:-n]) * up[: len(h) - n + 1]
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return x
