"""Lists of fingerprints that shards of a table exchange, packed into blocks by bucket.

A shard sorts its fingerprints and sends one row for each bucket. What a bucket finds out about them goes
back as one bit for each, in the same order, so that neither way carries a row per fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import zstandard

#: Fingerprints that a bucket holds about, and the fewest buckets.
BUCKET_ENTRIES = 4_000_000
MIN_BUCKETS = 512


def bucket_bits(entries: int) -> int:
    """The width of a bucket's number, for so many fingerprints in all."""
    return min(32, (max(MIN_BUCKETS, entries // BUCKET_ENTRIES) - 1).bit_length())


def keys_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Of 64-bit hashes the bucket, ``bits`` wide, and a fingerprint of 32 bits."""
    return hashes >> np.uint64(32 - bits)


def parts_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and fingerprint."""
    return (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)


def runs(buckets: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each bucket of an ascending array, with its part."""
    edges = np.flatnonzero(np.diff(buckets, prepend=-1, append=-2)).tolist()
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield int(buckets[a]), slice(a, b)


def packed(low: np.ndarray, *more: np.ndarray) -> bytes:
    """Ascending 32-bit numbers as differences, and others as they are, byte by byte, so that Spark can compress them."""
    rows = np.stack([np.diff(low, prepend=0), *more]).astype("<u4")
    return rows.view(np.uint8).reshape(len(rows), -1, 4).transpose(0, 2, 1).tobytes()


def unpacked(data: bytes, rows: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(rows, 4, -1).transpose(0, 2, 1)
    values = np.ascontiguousarray(planes).view("<u4").reshape(rows, -1).astype(np.int64)
    values[0] = np.cumsum(values[0])
    return values


def packed_bits(bits: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(np.packbits(bits).tobytes())


def unpacked_bits(buckets: np.ndarray, told: dict[int, bytes]) -> np.ndarray:
    """One bit for each entry of the ascending ``buckets``; a bucket that nothing was told about has none set."""
    unpack = zstandard.ZstdDecompressor().decompress
    found = np.zeros(len(buckets), bool)
    for bucket, part in runs(buckets):
        if bucket in told:
            found[part] = np.unpackbits(np.frombuffer(unpack(told[bucket]), np.uint8), count=part.stop - part.start)
    return found
