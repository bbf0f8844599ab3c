"""Words of many texts at once: where they are in a buffer of bytes, their hashes, their kinds.

Words are read eight bytes at a time, as numbers; the few very long ones by themselves. Hashes only
bring equal words together: whoever needs identity compares the bytes (distinct).
"""

from __future__ import annotations

import hashlib

import numpy as np

#: Words of more bytes are hashed and compared one by one.
LONG = 256
STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of MurmurHash3: every bit of the result depends on all bits."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    padded = np.zeros(len(inside) + 2, bool)
    padded[1:-1] = inside
    turns = np.flatnonzero(padded[1:] != padded[:-1])
    return turns[::2], turns[1::2]


class Eights:
    """A buffer of bytes read eight at a time from any place."""

    def __init__(self, texts: np.ndarray):
        padded = np.zeros((len(texts) + 23) // 8 * 8, np.uint8)
        padded[: len(texts)] = texts
        self.numbers = padded.view("<u8")

    def read(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The bytes from each start on, eight at most or as many as sizes (above zero) says."""
        at, shift = starts >> 3, (starts.astype(np.uint64) & np.uint64(7)) << np.uint64(3)
        low = self.numbers[at] >> shift
        high = (self.numbers[at + 1] << np.uint64(1)) << (np.uint64(63) - shift)
        unused = (np.uint64(8) - np.minimum(sizes, 8).astype(np.uint64)) << np.uint64(3)
        return ((low | high) << unused) >> unused


def hashes(
    texts: np.ndarray, starts: np.ndarray, ends: np.ndarray, eights: Eights | None = None
) -> np.ndarray:
    """A 64-bit hash of each of the spans of texts (bytes); empty spans are not allowed."""
    eights = eights or Eights(texts)
    sizes = ends - starts
    found = mixed(eights.read(starts, sizes) + STEP)
    for k in range(8, LONG, 8):
        more = np.flatnonzero(sizes > k)
        if not len(more):
            break
        found[more] = mixed(found[more] * STEP + eights.read(starts[more] + k, sizes[more] - k))
    for k in np.flatnonzero(sizes > LONG).tolist():
        digest = hashlib.blake2b(texts[starts[k] : ends[k]].tobytes(), digest_size=8).digest()
        found[k] = int.from_bytes(digest, "little")
    return found


def distinct(
    texts: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The spans with different bytes, one number for each, and of every span the place in that list.

    keys are hashes that bring equal spans together, hashes() unless given. Bytes are compared with
    those of the first span with that hash; the few that differ are told apart one by one.
    """
    eights = Eights(texts)
    keys = hashes(texts, starts, ends, eights) if keys is None else keys
    # The places take the low bits of the keys, so that one plain sort groups and orders.
    low = np.uint64(len(keys).bit_length())
    order = np.sort((keys >> low << low) | np.arange(len(keys), dtype=np.uint64))
    begins = np.ones(len(order), bool)
    begins[1:] = order[1:] >> low != order[:-1] >> low
    order = (order & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    first, group = order[begins], np.empty(len(order), np.int64)
    group[order] = np.cumsum(begins) - 1
    sizes = ends - starts
    leader = first[group]
    alike = sizes == sizes[leader]
    rest = np.flatnonzero(alike & (leader != np.arange(len(leader))))
    for k in range(0, LONG, 8):
        rest = rest[sizes[rest] > k]
        if not len(rest):
            break
        left = sizes[rest] - k
        same = eights.read(starts[rest] + k, left) == eights.read(starts[leader[rest]] + k, left)
        alike[rest] &= same
    for k in rest[sizes[rest] > LONG].tolist():
        a, b, n = starts[k], starts[leader[k]], sizes[k]
        alike[k] &= bool((texts[a : a + n] == texts[b : b + n]).all())
    others: dict[bytes, int] = {}
    found = []
    for k in np.flatnonzero(~alike).tolist():
        text = texts[starts[k] : ends[k]].tobytes()
        if text not in others:
            others[text] = len(first) + len(others)
            found.append(k)
        group[k] = others[text]
    return (np.append(first, found).astype(np.int64) if found else first), group
