"""Words of many texts and their hashes, as numpy arrays, in chunks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Odd, so that it can be divided out again in arithmetic modulo 2 to the 64.
BASE = 0x9E3779B97F4A7C15
CHUNK = 1 << 19

_powers: list[np.ndarray] = []


def _tables(n: int) -> list[np.ndarray]:
    """Powers of BASE and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        inverse = pow(BASE, -1, 1 << 64)
        _powers.clear()
        for base in (BASE, inverse):
            table = np.full(max(n, CHUNK + 1), base, np.uint64)
            table[0] = 1
            _powers.append(table.cumprod(dtype=np.uint64))
    return _powers


def _is_word() -> np.ndarray:
    """Letters, digits and all bytes of characters outside ASCII."""
    table = np.zeros(256, bool)
    table[128:] = True
    for a, b in (b"09", b"AZ", b"az"):
        table[a : b + 1] = True
    return table


IS_WORD = _is_word()


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of each hash."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def chunks(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]]:
    """For each chunk ``(doc, start, end, total, data)``: the words' texts by number and their places in ``data``.

    ``data`` is the lower-case UTF-8 of whole texts, or of a stretch of a long one that ends between words. ``total``
    has the running sums from which ``hashes`` takes the hash of any stretch. A word is never split.
    """
    held: list[bytes] = []
    first, size = 0, 0
    for i, text in enumerate(texts):
        data = (text or "").lower().encode("utf-8", "surrogatepass") + b"\n"
        if held and size + len(data) > CHUNK:
            yield _cut(held, first)
            held, size = [], 0
        if len(data) > CHUNK:
            for part in _stretches(data):
                yield _cut([part], i)
            continue
        if not held:
            first = i
        held.append(data)
        size += len(data)
    if held:
        yield _cut(held, first)


def _stretches(data: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(data):
        end = min(at + CHUNK, len(data))
        while end < len(data) and IS_WORD[data[end - 1]]:
            end += 1
        yield data[at:end]
        at = end


def _cut(held: list[bytes], first: int):
    data = b"".join(held)
    buf = np.frombuffer(data, np.uint8)
    word = IS_WORD[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    ends = np.cumsum([len(h) for h in held])
    doc = np.searchsorted(ends, start, "right") + first
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * _tables(len(buf))[0][: len(buf)], out=total[1:])
    return doc, start, end, total, data


def hashes(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the stretches from ``start`` to ``end``."""
    return mixed((total[end] - total[start]) * _tables(len(total))[1][start])


def documents(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]]:
    """``(doc, start, end, hash, data)`` as ``chunks`` has them, but a text is never in two of them."""
    held: list[tuple] = []

    def whole():
        if len(held) == 1:
            return held[0]
        shift = np.cumsum([0, *(len(h[4]) for h in held)])
        doc, hash_ = (np.concatenate([h[k] for h in held]) for k in (0, 3))
        start, end = (np.concatenate([h[k] + s for h, s in zip(held, shift, strict=False)]) for k in (1, 2))
        return doc, start, end, hash_, b"".join(h[4] for h in held)

    for doc, start, end, total, data in chunks(texts):
        if held and not (len(doc) and len(held[-1][0]) and held[-1][0][-1] == doc[0]):
            yield whole()
            held = []
        held.append((doc, start, end, hashes(total, start, end), data))
    if held:
        yield whole()
