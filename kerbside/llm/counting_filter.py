"""Counting quotient filters over packed word-id n-grams.

The ids of an n-gram are permuted by a Feistel network, a bijection, so nothing
is lost and frequent ids spread evenly. The permuted ids are packed two to a
64-bit limb. The first bits of the first limb are the quotient: they name a
slot and are not stored, only how many entries each slot has. The rest is the
remainder, kept in full, so equal entries are equal n-grams. Entries are in
order, so filters are merged by merging their entries; the leading bits of the
quotient name the shard that an entry belongs to.

An entry takes a byte for its slot, the bytes of its remainder and one byte of
count; larger counts stand aside.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np

_MUL = np.uint64(0x9E3779B97F4A7C15)
_END = np.uint64(0xD6E8FEB86659FD93)
_HEAD = struct.Struct("<qqBBBB")

Limbs = list[np.ndarray]


def _mixed(others: Limbs, turn: int, width: int) -> np.ndarray:
    h = np.full(len(others[0]), turn + 1, np.uint64)
    for other in others:
        h = (h ^ other) * _MUL
        h ^= h >> np.uint64(31)
    return (h * _END) >> np.uint64(64 - width)


def permute(ids: Limbs, width: int) -> Limbs:
    """Ids of ``width`` bits, each changed by the others in turn; two or more per n-gram."""
    out = list(ids)
    for turn in range(2 * len(out)):
        at = turn % len(out)
        out[at] = out[at] ^ _mixed(out[:at] + out[at + 1 :], turn, width)
    return out


def unpermute(ids: Limbs, width: int) -> Limbs:
    out = list(ids)
    for turn in reversed(range(2 * len(out))):
        at = turn % len(out)
        out[at] = out[at] ^ _mixed(out[:at] + out[at + 1 :], turn, width)
    return out


def pack(ids: Limbs, width: int) -> Limbs:
    """Permuted ids, two to a limb."""
    mixed, w = permute(ids, width), np.uint64(width)
    pairs = [(a << w) | b for a, b in zip(mixed[::2], mixed[1::2], strict=False)]
    return pairs + mixed[-1:] if len(mixed) % 2 else pairs


def unpack(limbs: Limbs, n: int, width: int) -> Limbs:
    """The n ids of each entry, as they were before :func:`pack`."""
    mixed: Limbs = []
    for limb in limbs[: n // 2]:
        mixed += [limb >> np.uint64(width), limb & np.uint64((1 << width) - 1)]
    return unpermute(mixed + limbs[n // 2 :], width)


def counted(limbs: Limbs, counts: np.ndarray | None = None) -> tuple[Limbs, np.ndarray]:
    """Distinct entries in order with their summed counts (one each, if none are given)."""
    if len(limbs) == 1:
        order = np.argsort(limbs[0], kind="stable") if counts is not None else None
        rows = [np.sort(limbs[0])] if order is None else [limbs[0][order]]
    else:
        order = np.lexsort(limbs[::-1])
        rows = [limb[order] for limb in limbs]
    new = np.ones(len(rows[0]), bool)
    if len(new):
        new[1:] = False
        for limb in rows:
            new[1:] |= limb[1:] != limb[:-1]
    first = np.nonzero(new)[0]
    if counts is None:
        sums = np.diff(np.append(first, len(new)))
    else:
        sums = np.add.reduceat(counts[order], first) if len(first) else counts[:0]
    return [limb[first] for limb in rows], sums.astype(np.int64)


def _bytes_of(values: np.ndarray, size: int) -> bytes:
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def _values_of(raw: bytes, n: int, size: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(raw, np.uint8, n * size).reshape(n, size)
    return out.view(np.uint64).ravel()


def to_filters(limbs: Limbs, counts: np.ndarray, width: int, shard_bits: int) -> Iterator[tuple[int, bytes]]:
    """The filter of each shard that has entries; ``limbs`` as :func:`counted` leaves them."""
    rest = 2 * width - shard_bits
    shard = (limbs[0] >> np.uint64(rest)).astype(np.int64)
    cuts = np.nonzero(np.diff(shard))[0] + 1
    for a, b in zip(np.append(0, cuts), np.append(cuts, len(shard)), strict=True):
        if a == b:
            continue
        n = int(b - a)
        slots = min(rest, max(0, n.bit_length() - 1))
        low = rest - slots
        inside = limbs[0][a:b] & np.uint64((1 << rest) - 1)
        runs = np.bincount((inside >> np.uint64(low)).astype(np.int64), minlength=1 << slots)
        run_type = np.uint8 if runs.max() < 256 else np.uint32
        size = (low + 7) // 8
        high = np.nonzero(counts[a:b] > 254)[0]
        body = [
            _HEAD.pack(n, len(high), slots, np.dtype(run_type).itemsize, low, len(limbs)),
            runs.astype(run_type).tobytes(),
            _bytes_of(inside & np.uint64((1 << low) - 1), size),
            np.minimum(counts[a:b], 255).astype(np.uint8).tobytes(),
            high.astype(np.int64).tobytes(),
            counts[a:b][high].astype(np.int64).tobytes(),
            *[limb[a:b].tobytes() for limb in limbs[1:]],
        ]
        yield int(shard[a]), b"".join(body)


def from_filter(raw: bytes, shard: int, width: int, shard_bits: int) -> tuple[Limbs, np.ndarray]:
    """Entries and counts of a filter."""
    n, n_high, slots, run_size, low, n_limbs = _HEAD.unpack_from(raw)
    at = _HEAD.size

    def taken(size: int) -> bytes:
        nonlocal at
        at += size
        return raw[at - size : at]

    runs = np.frombuffer(taken(run_size << slots), f"u{run_size}")
    size = (low + 7) // 8
    inside = np.repeat(np.arange(1 << slots, dtype=np.uint64), runs) << np.uint64(low)
    inside |= _values_of(taken(size * n), n, size)
    counts = np.frombuffer(taken(n), np.uint8).astype(np.int64)
    high = np.frombuffer(taken(8 * n_high), np.int64)
    counts[high] = np.frombuffer(taken(8 * n_high), np.int64)
    first = inside | np.uint64(shard << (2 * width - shard_bits))
    others = [np.frombuffer(taken(8 * n), np.uint64) for _ in range(n_limbs - 1)]
    return [first, *others], counts


def merged(filters: list[tuple[Limbs, np.ndarray]]) -> tuple[Limbs, np.ndarray]:
    """Entries of all filters in order, with summed counts."""
    limbs = [np.concatenate(parts) for parts in zip(*[f[0] for f in filters], strict=True)]
    return counted(limbs, np.concatenate([f[1] for f in filters]))
