"""Words and shingles as 64-bit hashes, computed with numpy over whole Arrow columns.

A word's hash is a polynomial over random values of its bytes, read off one running sum per block, then mixed. Equal
words have equal hashes everywhere; different words share one with odds of about 2^-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18
_M64 = (1 << 64) - 1
_RATIO = 0x9E3779B97F4A7C15 | 1
SPACES = bytes([9, 10, 11, 12, 13, 32])
#: For features that ignore punctuation: every ASCII byte that is neither letter nor digit.
NOT_ALNUM = bytes(b for b in range(128) if not chr(b).isalnum())

ALONE, GLUE = 254, 255

_tables: dict = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit values (xor-shifts and odd multipliers)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def random_words(n: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, n, dtype=np.uint64)


def _values(lower: bool) -> np.ndarray:
    if ("values", lower) not in _tables:
        values = random_words(256, 17)
        if lower:
            values[65:91] = values[97:123]
        _tables["values", lower] = values
    return _tables["values", lower]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables.get("powers", ((), ()))[0]) < n:
        size = max(n, BLOCK + (BLOCK >> 2))
        both = []
        for ratio in (_RATIO, pow(_RATIO, -1, 1 << 64)):
            steps = np.full(size, ratio, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        if size > 8 * BLOCK:
            return both[0], both[1]
        _tables["powers"] = both[0], both[1]
    return _tables["powers"]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and where each text starts (one more entry than texts); NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    starts = starts.astype(np.int64) if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), starts


def slices(batches, name: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about `limit` bytes of the named column, so that memory stays bounded."""
    for batch in batches:
        _, starts = buffers(batch.column(name))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(starts, starts[at] + limit, "right")) - 1)
            yield batch.slice(at, min(end, batch.num_rows) - at)
            at = end


def words(
    column: pa.Array,
    separators: bytes = SPACES,
    lower: bool = True,
    spans: bool = False,
    classes: np.ndarray | None = None,
) -> tuple[np.ndarray, ...]:
    """Hashes of all words of all texts, one text after the other, and the number of words of each text.

    A word is a longest run of bytes without a separator. With `lower`, A-Z count as a-z. With `spans`, the first and
    the end byte of each word in the column's buffer follow. With `classes`, the class of every byte, words are cut further,
    between bytes of different classes and between any two of class ALONE, but never at a byte of class GLUE.
    """
    data, starts = buffers(column)
    hashes, places, stops = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    is_sep = np.zeros(256, bool)
    is_sep[list(separators)] = True
    first, last = int(starts[0]), int(starts[-1])
    at = first
    while at < last:
        end = min(at + BLOCK, last)
        while end < last:  # a block ends before a separator or a text
            stop = min(end + 4096, last)
            found = np.flatnonzero(is_sep[data[end:stop]])
            cut = end + int(found[0]) if len(found) else last
            text = starts[np.searchsorted(starts, end)]
            end, done = min(cut, int(text)), len(found) or text <= stop
            if done:
                break
            end = stop
        block = data[at:end]
        n = len(block)
        edge = np.ones(n + 1, bool)
        is_word = ~is_sep[block]
        edge[1:n] = is_word[1:] != is_word[:-1]
        if classes is not None:
            kind = classes[block]
            cut = (kind[1:] != kind[:-1]) | (kind[1:] == ALONE)
            edge[1:n] |= cut & (kind[1:] != GLUE) & (kind[:-1] != GLUE)
        inner = starts[np.searchsorted(starts, at, "right") : np.searchsorted(starts, end)] - at
        edge[inner] = True
        cuts = np.flatnonzero(edge)
        begin = cuts[:-1]
        keep = is_word[begin]
        begin, stop_at = begin[keep], cuts[1:][keep]
        if len(begin):
            power, inverse = _powers(n + 1)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_values(lower)[block] * power[:n], out=sums[1:])
            raw = (sums[stop_at] - sums[begin]) * inverse[begin]
            hashes.append(mix(raw + (stop_at - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
            places.append(begin + at)
            stops.append(stop_at + at)
        at = end
    begins = np.concatenate(places)
    found = np.concatenate(hashes), np.diff(np.searchsorted(begins, starts))
    return (*found, begins, np.concatenate(stops)) if spans else found


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words, and their number by text.

    A text with fewer words has its whole sequence as its one shingle; one without words has none.
    """
    turn = random_words(width, 23) | np.uint64(1)
    ends = np.cumsum(counts)
    n = len(hashes)
    whole = np.zeros(n, np.uint64)
    for k in range(width):
        whole[: max(n - k, 0)] += hashes[k:] * turn[k]
    whole = mix(whole)
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    for text in np.flatnonzero((counts > 0) & (counts < width)):
        end, size = int(ends[text]), int(counts[text])
        some = (hashes[end - size : end] * turn[:size]).sum(dtype=np.uint64, keepdims=True)
        whole[end - size] = mix(some + np.array([size], np.uint64) * np.uint64(0xA0761D6478BD642F))[0]
    spot = np.repeat(ends - counts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    return whole[spot], sizes


def minima(hashes: np.ndarray, sizes: np.ndarray, n_hash: int, seed: int) -> np.ndarray:
    """For each set of hashes, the minimum of each of `n_hash` universal hash functions (multiply, add, shift): uint32.

    An empty set has the largest value throughout.
    """
    factors, terms = random_words(n_hash, seed) | np.uint64(1), random_words(n_hash, seed + 1)
    out = np.full((len(sizes), n_hash), np.uint32(0xFFFFFFFF), np.uint32)
    ends = np.cumsum(sizes)
    step, text = 1 << 15, 0
    one, two = np.empty(step, np.uint64), np.empty(step, np.uint32)
    while text < len(sizes):
        begin = int(ends[text] - sizes[text])
        stop = max(text + 1, int(np.searchsorted(ends, begin + step, "right")))
        block = np.arange(text, stop)[sizes[text:stop] > 0]
        if len(block):
            spots = ends[block] - sizes[block]
            for low in range(begin, int(ends[stop - 1]), step):  # one pass, but for a long text by itself
                part = hashes[low : min(low + step, int(ends[stop - 1]))]
                a, b = one[: len(part)], two[: len(part)]
                at = np.maximum(spots - low, 0) if len(block) == 1 else spots - low
                for k in range(n_hash):
                    np.multiply(part, factors[k], out=a)
                    a += terms[k]
                    a >>= np.uint64(32)
                    np.copyto(b, a, casting="unsafe")
                    out[block, k] = np.minimum(out[block, k], np.minimum.reduceat(b, at))
        text = stop
    return out


def per_text(values: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """The slice of each text."""
    end = 0
    for size in sizes.tolist():
        yield values[end : end + size]
        end += size


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and how often each occurs."""
    values = np.sort(values)
    cuts = np.flatnonzero(np.concatenate([np.ones(min(len(values), 1), bool), values[1:] != values[:-1]]))
    return values[cuts], np.diff(np.append(cuts, len(values)))


def shapes(column: pa.Array) -> pa.Array:
    """Each text with letters as a or A, digits as 0, and no class of characters twice in a row: `STOP!! now` is `A! a`.

    Words stay where they are, so the n-th word of a result is the shape of the n-th word.
    """
    kinds = np.arange(256, dtype=np.uint8)
    kinds[97:123], kinds[128:], kinds[65:91], kinds[48:58] = ord("a"), ord("a"), ord("A"), ord("0")
    kinds[list(SPACES)] = 32
    data, starts = buffers(column)
    body = kinds[data[starts[0] : starts[-1]]]
    keep = np.ones(len(body), bool)
    keep[1:] = body[1:] != body[:-1]
    firsts = (starts - starts[0])[:-1]
    keep[firsts[firsts < len(body)]] = True
    ends = np.concatenate([[0], np.cumsum(keep)])[starts - starts[0]]
    return pa.Array.from_buffers(
        pa.large_string(), len(starts) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(body[keep])]
    )
