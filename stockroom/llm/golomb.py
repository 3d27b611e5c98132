"""Golomb codes of sorted numbers, with a power of two as parameter. Runs inside Python workers."""

from __future__ import annotations

import math

import numpy as np


def low_bits(span: int, count: int) -> int:
    """How many low bits of a gap are sent as they are, if ``count`` numbers are spread evenly over ``span``."""
    return max(0, int(math.log2(max(1.0, math.log(2) * span / max(1, count)))))


def encode_sorted(values: np.ndarray, span: int) -> bytes:
    """Ascending numbers from 0 to below ``span``. Their gaps, each as a unary quotient and a remainder of fixed length:
    first all quotients, then all remainders."""
    low = np.uint64(low_bits(span, len(values)))
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    quotients = (gaps >> low).astype(np.int64)
    ends = np.cumsum(quotients + 1)
    unary = np.ones(int(ends[-1]) if len(ends) else 0, np.uint8)
    unary[ends - 1] = 0
    shifts = np.arange(int(low), dtype=np.uint64)[::-1]
    remainders = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    return np.packbits(np.concatenate([unary, remainders.reshape(-1)])).tobytes()


def decode_sorted(data: bytes, count: int, span: int) -> np.ndarray:
    """The numbers that :func:`encode_sorted` was given."""
    if not count:
        return np.empty(0, np.uint64)
    low = low_bits(span, count)
    bits = np.unpackbits(np.frombuffer(data, np.uint8))
    # A quotient's last bit is the only zero it has; the remainders after the last quotient have zeros, too.
    ends = np.flatnonzero(bits == 0)[:count]
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(low)
    if low:
        start = int(ends[-1]) + 1
        weights = np.uint64(1) << np.arange(low, dtype=np.uint64)[::-1]
        gaps += bits[start : start + count * low].reshape(count, low).astype(np.uint64) @ weights
    return np.cumsum(gaps, dtype=np.uint64)
