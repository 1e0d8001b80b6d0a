"""Sets of word shingles as sorted 64-bit hashes, and what is derived from them inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
BANDS, ROWS = 4, 3
#: An overlap that no set has.
NEVER = 1 << 62
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words; forgets them when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[bytes], hashes: WordHashes, k: int = WORDS) -> list[np.ndarray]:
    """The distinct k-word shingles of each text, as sorted hashes.

    A-Z are lower-cased, words are what ASCII white space parts. A text of fewer words is one shingle, one
    without words has none.
    """
    words = [t.lower().split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter((hashes[w] for doc in words for w in doc), np.uint64, int(sizes.sum()))
    begins = np.concatenate([[0], np.cumsum(sizes)])
    rolled = np.zeros(max(0, len(flat) - k + 1), np.uint64)
    for i in range(k):
        rolled = rolled * MULTIPLIER + flat[i : i + len(rolled)]
    rolled = mixed(rolled + np.uint64(k))
    out = []
    for begin, size in zip(begins.tolist(), sizes.tolist(), strict=False):
        if size >= k:
            out.append(np.unique(rolled[begin : begin + size - k + 1]))
        elif size:
            h = np.zeros(1, np.uint64)
            for i in range(begin, begin + size):
                h = h * MULTIPLIER + flat[i : i + 1]
            out.append(mixed(h + np.uint64(size)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """`BANDS` keys per set, each of the minima of `ROWS` hash functions; an empty set has zeros."""
    out = np.zeros((len(sets), BANDS), np.uint64)
    sizes = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out.view(np.int64)
    flat = np.concatenate([sets[i] for i in full])
    begins = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
    for band in range(BANDS):
        key = np.zeros(len(full), np.uint64)
        for row in range(ROWS):
            seed = np.uint64((2 * (band * ROWS + row) + 1) * int(MULTIPLIER) % 2**64)
            key = key * MULTIPLIER + np.minimum.reduceat(mixed(flat ^ seed), begins)
        out[full, band] = key
    return out.view(np.int64)


def slot_of(s: np.ndarray, slots: int) -> np.ndarray:
    """The counter of each hash, from its low bits; `slots` is a power of two."""
    return (s & np.uint64(slots - 1)).astype(np.int64)


def in_order(s: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The set in the global order: rare classes first, then by hash; the class takes the top eight bits."""
    slot = slot_of(s, len(classes))
    return np.sort((classes[slot].astype(np.uint64) << np.uint64(56)) | (s & np.uint64((1 << 56) - 1)))


def signature_bits(n: int) -> int:
    """Bits of the signatures of sets of up to n elements: enough that those some ninth apart differ in most of them."""
    return 1 << min(16, max(7, n.bit_length()))


def parities(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """A signature for each set: 1 or -1 for each of `bits` hash classes, by whether an even number of elements falls there.

    Each element that one set has and another has not changes one of the bits, so sets differ at least in as
    many elements as signatures in bits.
    """
    return (1 - 2 * odd_classes(sets, bits)).astype(np.float32)


def odd_classes(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """For each set and each of `bits` hash classes 1 if an odd number of elements falls there, else 0."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    bit = (np.concatenate(sets) & np.uint64(bits - 1)).astype(np.int64)
    counts = np.bincount(owner * bits + bit, minlength=len(sets) * bits).reshape(len(sets), bits)
    return (counts & 1).astype(np.int8)


def packed_signatures(sets: list[np.ndarray]) -> list[bytes]:
    """The odd classes of each set as bits, so many as `signature_bits` gives for its size."""
    widths = np.array([signature_bits(len(s)) for s in sets], np.int64)
    out = [b""] * len(sets)
    for bits in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == bits)
        step = max(1, (1 << 20) // bits)
        for block in (rows[i : i + step] for i in range(0, len(rows), step)):
            for i, packed in zip(block.tolist(), np.packbits(odd_classes([sets[i] for i in block], bits), axis=1), strict=True):
                out[i] = packed.tobytes()
    return out


class Signed:
    """Signatures of sets that have been packed, by their width. A wide one is folded to compare it with a narrow one."""

    def __init__(self, sizes: list[int], packed: list[bytes]):
        self.sizes = np.array(sizes, np.int64)
        widths = np.array([8 * len(p) for p in packed], np.int64)
        self.rows = {bits: np.flatnonzero(widths == bits) for bits in np.unique(widths).tolist()}
        self.signs: dict[tuple[int, int], np.ndarray] = {}
        for bits, rows in self.rows.items():
            flat = np.frombuffer(b"".join(packed[i] for i in rows), np.uint8).reshape(len(rows), bits // 8)
            self.signs[bits, bits] = 1 - 2 * np.unpackbits(flat, axis=1).astype(np.float32)

    def folded(self, bits: int, to: int) -> np.ndarray:
        if (bits, to) not in self.signs:
            own = self.signs[bits, bits]
            self.signs[bits, to] = own.reshape(len(own), bits // to, to).prod(1)
        return self.signs[bits, to]

    def able(self, other: Signed) -> np.ndarray:
        """Which sets of this and of the other can link by their sizes and signatures."""
        m, n = self.sizes[:, None], other.sizes
        out = 5 * np.minimum(m, n) >= 4 * np.maximum(m, n)
        for v, i in self.rows.items():
            for w, j in other.rows.items():
                at = np.ix_(i, j)
                if not out[at].any():
                    continue
                bits = min(v, w)
                differ = (bits - self.folded(v, bits) @ other.folded(w, bits).T) / 2
                out[at] &= 9 * differ <= self.sizes[i][:, None] + other.sizes[j]
        return out


def least_overlap(m: int, n: int) -> int:
    """The smallest intersection of sets of m and n elements with 100 * intersection >= 80 * union."""
    return -(-4 * (m + n) // 9)


def prefix_length(n: int) -> int:
    """So many first elements of a set meet the first elements of every set it links with."""
    return n - -(-4 * n // 5) + 1


class Trie:
    """Ordered sets as paths from one root, kept as sorted rows with the length each shares with the row before."""

    CHUNK = 64

    def __init__(self, sets: list[np.ndarray]):
        rows = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.rows = rows
        self.sets = [sets[i] for i in rows]
        self.shared = [0]
        for a, b in zip(self.sets, self.sets[1:]):
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            self.shared.append(int(differ[0]) if len(differ) else n)

    def overlaps(self, probe: np.ndarray, needed: list[int]) -> list[int]:
        """The overlap of the probe with each set, or -1 if it is below what is needed.

        The walk keeps the overlap up to each depth of the current path, so a shared start is counted once,
        and leaves a path as soon as what remains of either set cannot make up for what is missing.
        """
        out = [-1] * len(self.sets)
        held = np.zeros(0, np.int32)  # overlap after each element of the current path
        for row, own, shared in zip(self.rows, self.sets, self.shared, strict=True):
            need = needed[row]
            depth = min(shared, len(held))
            held = held[:depth]
            if need > len(own):
                continue
            overlap = int(held[-1]) if depth else 0
            while True:
                left = len(probe) - int(np.searchsorted(probe, own[depth - 1], "right")) if depth else len(probe)
                if overlap + min(len(own) - depth, left) < need or depth == len(own):
                    break
                part = own[depth : depth + self.CHUNK]
                at = np.searchsorted(probe, part)
                same = probe[np.minimum(at, len(probe) - 1)] == part
                held = np.concatenate([held, overlap + np.cumsum(same, dtype=np.int32)])
                overlap = int(held[-1])
                depth += len(part)
            if depth == len(own) and overlap >= need:
                out[row] = overlap
        return out
