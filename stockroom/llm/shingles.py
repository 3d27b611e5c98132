"""Words and word shingles of many texts at once, as 64-bit hashes. Runs inside Python workers, on Arrow's buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
WORDS_AT_A_TIME = 50_000
_draw = np.random.default_rng(20)
_BYTE = _draw.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; different values stay different."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each begins in them (one more: the end). NULL texts have none."""
    texts = texts.cast(pa.large_string())
    starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if texts.null_count:
        texts = texts.fill_null("")
        starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word (what stands between ASCII white space, with A-Z in lower case), text after text, and where
    each text's words begin."""
    data, starts = text_bytes(texts)
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    data = _LOWER[data]
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = starts[:-1][starts[:-1] < len(data)]
    begins[edges] = inside[edges]
    first = np.flatnonzero(begins)
    if not len(first):
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    ends = np.append(first[1:], len(data))
    sums = np.empty(len(first), np.uint64)
    # Some words at a time, as each byte needs several numbers.
    for low in range(0, len(first), WORDS_AT_A_TIME):
        high = min(low + WORDS_AT_A_TIME, len(first))
        part = slice(first[low], ends[high - 1])
        bytes_, starting = data[part][inside[part]], begins[part][inside[part]]
        heads = np.flatnonzero(starting)
        far = np.arange(len(bytes_)) - np.repeat(heads, np.diff(np.append(heads, len(bytes_))))
        powers = np.ones(int(far.max()) + 1, np.uint64)
        powers[1:] = _BASE
        powers = np.multiply.accumulate(powers)
        sums[low:high] = np.add.reduceat(_BYTE[bytes_] * powers[far], heads)
    return mixed(sums), np.searchsorted(first, starts).astype(np.int64)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Each text's set of hashes of ``size`` consecutive words, sorted; of fewer words, the one of all of them."""
    words, starts = word_hashes(texts)
    found = []
    if len(words) >= size:
        rolled = np.zeros(len(words) - size + 1, np.uint64)
        for i in range(size):
            rolled += mixed(words[i : len(words) - size + 1 + i] + np.uint64(i + 1)) * np.uint64(2 * i + 3)
        rolled = mixed(rolled)
    for begin, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        count = end - begin
        if count >= size:
            found.append(np.unique(rolled[begin : end - size + 1]))
        elif count:
            short = np.array([count], np.uint64)
            for i in range(begin, end):
                short = mixed(short + words[i : i + 1])
            found.append(short)
        else:
            found.append(np.empty(0, np.uint64))
    return found
