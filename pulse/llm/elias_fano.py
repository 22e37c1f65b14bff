"""Elias-Fano coding of sorted integers, vectorised."""

from __future__ import annotations

import struct

import numpy as np


def _pack(values: np.ndarray, bits: int) -> bytes:
    """Low ``bits`` bits of each value: whole bytes as they are, then the bits left over back to back."""
    n, whole, rest = len(values), bits // 8, bits % 8
    raw = values.astype("<u8").view(np.uint8).reshape(n, 8)
    out = raw[:, :whole].tobytes()
    if rest:
        table = np.unpackbits(raw[:, whole : whole + 1], axis=1, count=rest, bitorder="little")
        out += np.packbits(table.ravel(), bitorder="little").tobytes()
    return out


def _unpack(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    whole, rest = bits // 8, bits % 8
    raw = np.zeros((n, 8), dtype=np.uint8)
    raw[:, :whole] = data[: n * whole].reshape(n, whole)
    if rest:
        table = np.unpackbits(data[n * whole :], count=n * rest, bitorder="little").reshape(n, rest)
        raw[:, whole : whole + 1] = np.packbits(table, axis=1, bitorder="little")
    return raw.view("<u8").ravel()


def _packed_size(n: int, bits: int) -> int:
    return n * (bits // 8) + (n * (bits % 8) + 7) // 8


def encode(values: np.ndarray) -> bytes:
    """A non-decreasing sequence of unsigned 64-bit integers.

    The low bits of each value are stored as they are; the high parts, which
    grow slowly, are a bit vector with a one at (high part + index) of each.
    """
    v = values.astype(np.uint64)
    n = len(v)
    if n == 0:
        return struct.pack("<QQBQ", 0, 0, 0, 0)
    base = int(v[0])  # stored apart, so that a block far from zero is as small as one near it
    v = v - np.uint64(base)
    low_bits = max(0, (int(v[-1]) // n).bit_length() - 1)
    high = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    ones = np.zeros(int(high[-1]) + 1, dtype=np.uint8)
    ones[high] = 1
    upper = np.packbits(ones, bitorder="little").tobytes()
    return struct.pack("<QQBQ", n, base, low_bits, len(upper)) + upper + _pack(v, low_bits)


HEAD = struct.calcsize("<QQBQ")


def decode(data) -> np.ndarray:
    """The sequence back, as uint64; ``data``: bytes or a memory-mapped array of them."""
    raw = np.frombuffer(data, dtype=np.uint8) if isinstance(data, (bytes, bytearray, memoryview)) else data
    n, base, low_bits, n_upper = struct.unpack("<QQBQ", raw[:HEAD].tobytes())
    if n == 0:
        return np.zeros(0, dtype=np.uint64)
    ones = np.flatnonzero(np.unpackbits(raw[HEAD : HEAD + n_upper], bitorder="little"))
    high = (ones - np.arange(n)).astype(np.uint64)
    low = _unpack(raw[HEAD + n_upper : HEAD + n_upper + _packed_size(n, low_bits)], n, low_bits)
    return ((high << np.uint64(low_bits)) | low) + np.uint64(base)
