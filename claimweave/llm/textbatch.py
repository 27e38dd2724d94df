"""Words of many texts at once, as numpy arrays.

The operators that read whole texts in ``mapInArrow`` work on runs of texts
joined into one byte buffer. A run of ``runs`` holds about ``CHUNK`` bytes or one
text, whatever its size; ``pieces`` cuts a longer text into runs of that size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import SparkSession

CHUNK = 1 << 20
BATCH_BYTES = 32 << 20
#: Longer words are hashed one by one.
LONG_WORD = 64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BREAK = np.zeros(256, bool)
_BREAK[0x0A] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_SOLID = np.zeros(256, bool)
_SOLID[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_MUL = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        h ^= h >> np.uint64(30)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
    return h


def chain(hashes: list[np.ndarray]) -> np.ndarray:
    """One hash for each row of several aligned hash arrays, order kept."""
    out = hashes[0]
    with np.errstate(over="ignore"):
        for h in hashes[1:]:
            out = mix(out * _MUL + h)
    return out


def hash_spans(buf: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes."""
    h = np.full(len(start), 0xCBF29CE484222325, np.uint64) ^ length.astype(np.uint64)
    order = np.argsort(-length, kind="stable")
    long = int(np.count_nonzero(length > LONG_WORD))
    for i in order[:long]:
        h[i] = xxhash.xxh64_intdigest(buf[start[i]:start[i] + length[i]].tobytes(), 7)
    order = order[long:]
    s, n = start[order], length[order]
    own = h[order]
    counts = np.searchsorted(-n, -np.arange(1, LONG_WORD + 1), side="right")
    with np.errstate(over="ignore"):
        for k, c in enumerate(counts):
            if not c:
                break
            own[:c] = (own[:c] ^ buf[s[:c] + k]) * np.uint64(0x100000001B3)
            own[:c] ^= own[:c] >> np.uint64(29)
    h[order] = own
    return mix(h)


@dataclass
class Texts:
    """A run of texts: lower-cased (A-Z) bytes and the words in them.

    ``rows`` are the rows of the batch, ``doc`` gives each word's position
    among them, ``raw`` keeps the bytes as they were.
    """

    rows: np.ndarray
    raw: np.ndarray
    buf: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    start: np.ndarray
    length: np.ndarray
    doc: np.ndarray

    @property
    def n(self) -> int:
        return len(self.rows)

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word hashes, first words of the n-grams within one text, n-gram hashes)."""
        h = self.hashes()
        if len(h) < n:
            return h, np.zeros(0, np.int64), np.zeros(0, np.uint64)
        last = len(h) - n + 1
        at = np.flatnonzero(self.doc[:last] == self.doc[n - 1:])
        return h, at, chain([h[at + k] for k in range(n)])

    def firsts(self) -> np.ndarray:
        """The first word of each text, and one past the last text's."""
        return np.concatenate([[0], np.cumsum(self.counts())])

    def trimmed(self) -> Texts:
        """The same texts with words stripped of ASCII punctuation at both ends;
        words of nothing else are left out."""
        solid = _SOLID[self.buf]
        at, before = np.flatnonzero(solid), np.concatenate([[0], np.cumsum(solid)])
        lo, hi = before[self.start], before[self.start + self.length]
        keep = hi > lo
        start, stop = at[lo[keep]], at[hi[keep] - 1] + 1
        return replace(self, start=start, length=stop - start, doc=self.doc[keep])

    def hashes(self) -> np.ndarray:
        return hash_spans(self.buf, self.start, self.length)


def bound_batches(spark: SparkSession) -> None:
    """Limit Arrow batches by bytes, so that very long texts don't fill a task's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def to_texts(rows: list[int], texts: list[bytes]) -> Texts:
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    end = np.cumsum(sizes + 1) - 1
    begin = end - sizes
    word = ~_SPACE[raw]
    edge = np.flatnonzero(np.diff(word.view(np.int8), prepend=0))
    start, stop = edge[0::2], edge[1::2]
    return Texts(np.array(rows, np.int64), raw, _LOWER[raw], begin, end, start, stop - start,
                 np.searchsorted(end, start, side="right"))


def runs(column: pa.Array, most: int = CHUNK) -> Iterator[Texts]:
    """Runs of the texts of one column; a null text is empty."""
    rows: list[int] = []
    texts: list[bytes] = []
    size = 0
    for i, value in enumerate(column):
        data = value.as_py()
        data = b"" if data is None else data.encode() if isinstance(data, str) else data
        if rows and size + len(data) > most:
            yield to_texts(rows, texts)
            rows, texts, size = [], [], 0
        rows.append(i)
        texts.append(data)
        size += len(data)
    if rows:
        yield to_texts(rows, texts)


def _cut(buf: np.ndarray, at: int, where: np.ndarray, step: int = 1 << 16) -> int:
    """The first byte of the kind ``where`` at or after ``at``, or the end."""
    while at < len(buf):
        found = np.flatnonzero(where[buf[at:at + step]])
        if len(found):
            return at + int(found[0])
        at += step
    return len(buf)


def pieces(column: pa.Array, most: int | None = None, lines: bool = False) -> Iterator[tuple[Texts, bool, bool]]:
    """Runs of the texts of a binary column like ``runs``, but a text longer than
    ``most`` comes alone, in pieces cut at white space (with ``lines``, at line
    breaks), so that only its bytes and the arrays of one piece are held. Each run
    says whether it begins and whether it ends its texts; no word or line is cut."""
    where = _BREAK if lines else _SPACE
    most = CHUNK if most is None else most
    rows: list[int] = []
    texts: list[bytes] = []
    size = 0
    for i, value in enumerate(column):
        data = value.as_buffer() if value.is_valid else None
        n = data.size if data is not None else 0
        if rows and size + n > most:
            yield to_texts(rows, texts), True, True
            rows, texts, size = [], [], 0
        if n > most:
            buf, at = np.frombuffer(data, np.uint8), 0
            while at < n:
                to = _cut(buf, min(at + most, n), where)
                yield to_texts([i], [buf[at:to].tobytes()]), at == 0, to == n
                at = to
            continue
        rows.append(i)
        texts.append(data.to_pybytes() if data is not None else b"")
        size += n
    if rows:
        yield to_texts(rows, texts), True, True


def slices(data: bytes, most: int = CHUNK) -> Iterator[list[bytes]]:
    """The words of a long text, some at a time."""
    at = 0
    while at < len(data):
        to = min(at + most, len(data))
        while to < len(data) and not _SPACE[data[to]]:
            to += 1
        yield data[at:to].split()
        at = to
