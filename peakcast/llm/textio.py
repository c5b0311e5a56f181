"""Vectorised text work on Arrow batches inside tasks: words and their 64-bit hashes without a Python loop per word.

A batch's texts lie one after another in one byte buffer. A 256-entry table maps each byte to its folded
form, or to 0 where it separates words. Word hashes are differences of one running polynomial sum, so
hashing costs a few vector operations per byte whatever the number of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes of text that a worker handles at a time: the tables of powers are then 8 MB each.
CHUNK = (1 << 20) - 64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n (cached, doubled as needed)."""
    if not _POW or len(_POW["p"]) < n:
        m = max(1 << 16, 1 << (max(n, 1) - 1).bit_length())
        with np.errstate(over="ignore"):
            for key, base in (("p", _BASE), ("i", _INV)):
                a = np.full(m, base, U)
                a[0] = 1
                _POW[key] = np.multiply.accumulate(a, dtype=U)
    return _POW["p"][:n], _POW["i"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply rounds)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def byte_table(separator: set[int], fold_case: bool = True) -> np.ndarray:
    """Byte -> folded byte, 0 for separators."""
    t = np.arange(256, dtype=np.uint8)
    t[0] = 0xFF  # a NUL character is text like any other; no UTF-8 text has this byte
    if fold_case:
        t[65:91] += 32
    t[sorted(separator)] = 0
    return t


#: ASCII white space separates words.
SPACE_TABLE = byte_table({0x20, *range(0x09, 0x0E)})
#: Every ASCII character that is no digit and no letter separates words.
WORD_TABLE = byte_table({*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)})


@dataclass
class Texts:
    """Texts of some consecutive rows: bytes, and where each text begins (len + 1 entries)."""
    data: np.ndarray
    starts: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1


def chunks(column: pa.Array, chunk_bytes: int = CHUNK) -> Iterator[tuple[int, int, Texts]]:
    """(first row, end row, texts) for runs of whole texts of about ``chunk_bytes`` (a longer text is alone).
    Null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if n == 0:
        return
    _, off, dat = column.buffers()
    starts = np.frombuffer(off, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(dat, np.uint8) if dat is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(starts, starts[lo] + chunk_bytes, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        s = starts[lo:hi + 1]
        yield lo, hi, Texts(data[s[0]:s[-1]], s - s[0])
        lo = hi


@dataclass
class Words:
    """Words of some texts: byte spans, hashes, and the index of the first word of each text (len + 1)."""
    begin: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    first: np.ndarray


def words(t: Texts, byte_map: np.ndarray) -> Words:
    b = byte_map[t.data]
    n = len(b)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = b != 0
    cut = np.zeros(n + 1, bool)  # a text's first byte begins a word even right after another text's last
    cut[t.starts] = True
    before, here = inside[:-1], inside[1:]
    begin = np.flatnonzero(here & (~before | cut))
    end = np.flatnonzero(before & (~here | cut))
    p, i = _powers(n + 1)
    with np.errstate(over="ignore"):
        run = np.zeros(n + 1, U)
        np.cumsum(b.astype(U) * p[:n], out=run[1:])
        h = (run[end] - run[begin]) * i[begin] + (end - begin).astype(U) * U(0xD6E8FEB86659FD93)
    return Words(begin, end, mix(h), np.searchsorted(begin, t.starts))


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash per k-word shingle, index of each text's first shingle). A text of 1 to k - 1 words gives one
    shingle, its whole word sequence; one without words gives none."""
    count = np.diff(w.first)
    n = len(w.hashes)
    with np.errstate(over="ignore"):
        full = np.zeros(max(n - k + 1, 0), U)
        for j in range(k):
            full = mix(full + w.hashes[j:j + len(full)] * U(2 * j + 0x9E3779B1))
        per = np.where(count >= k, count - k + 1, np.minimum(count, 1))
        first = np.zeros(len(per) + 1, np.int64)
        np.cumsum(per, out=first[1:])
        text = np.repeat(np.arange(len(per)), per)
        at = w.first[:-1][text] + (np.arange(first[-1]) - first[:-1][text])
        out = np.zeros(len(at), U)
        whole = count[text] >= k
        out[whole] = full[at[whole]]
        for d in np.flatnonzero((count > 0) & (count < k)):
            h = np.zeros(1, U)
            for x in w.hashes[w.first[d]:w.first[d + 1]]:
                h = mix(h + x * U(0xA24BAED4963EE407))
            out[first[d]] = mix(h + U(int(count[d])))[0]
    return out, first
