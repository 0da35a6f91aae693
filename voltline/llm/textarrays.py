"""Words, lines and their 64-bit hashes of many texts at once, as numpy arrays over the joined UTF-8 bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bytes whose hash terms are held at once.
_HASH_BYTES = 1 << 18
_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers_to(n: int) -> np.ndarray:
    global _powers
    while len(_powers) < n:
        _powers = np.concatenate([_powers, _powers * _power(len(_powers))])
    return _powers


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def segment_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each non-empty segment [start, end); equal bytes have equal hashes."""
    out = np.empty(len(starts), np.uint64)
    lens = ends - starts
    total = np.concatenate([[0], np.cumsum(lens)])
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(total, total[i] + _HASH_BYTES, "right")) - 1)
        part, first = lens[i:j], total[i:j] - total[i]
        within = np.arange(total[j] - total[i]) - np.repeat(first, part)
        p = _powers_to(int(part.max()))
        terms = (buf[np.repeat(starts[i:j], part) + within].astype(np.uint64) + np.uint64(1)) * p[within]
        out[i:j] = np.add.reduceat(terms, first)
        i = j
    return mix(out ^ lens.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Words:
    """Words of a block of texts. ``doc``: the text's index; ``start``/``end``: byte offsets in ``buf``."""

    buf: np.ndarray
    bounds: np.ndarray  # byte offset of each text, then the end
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    n_docs: int

    def count(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs)

    def per_doc(self, mask: np.ndarray) -> np.ndarray:
        """Number of set bytes of ``mask`` in each text."""
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]

    def offsets(self) -> np.ndarray:
        """Index of each text's first word, then the number of words."""
        return np.concatenate([[0], np.cumsum(self.count())])


def words_of(texts: list[str], lower: bool = False) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text; ``lower`` maps A-Z to a-z first."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    buf = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    if lower:
        buf = _LOWER[buf]
    bounds = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])]).astype(np.int64)
    space = _SPACE[buf]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    doc = np.searchsorted(bounds, start, "right") - 1
    return Words(buf, bounds, doc, start, end, segment_hashes(buf, start, end), len(texts))


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of each k-word window; a text of fewer words, but any, has its whole sequence as one."""
    n = len(w.hash)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    off, cnt = w.offsets()[:-1], w.count()
    length = np.minimum(cnt, k)[w.doc]
    place = np.arange(n) - off[w.doc]
    first = np.flatnonzero(place + length <= cnt[w.doc])
    acc = np.zeros(len(first), np.uint64)
    for j in range(k):
        use = j < length[first]
        acc[use] = mix(acc[use] * _BASE + w.hash[first[use] + j])
    return w.doc[first], acc
