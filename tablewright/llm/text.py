"""Words and hashes of whole batches of texts, in numpy, and row handles in Spark.

A word is a maximal run of bytes other than space and 0x09-0x0D, as `bytes.split()`
cuts it. It is known by two hashes, independent of each other (128 bits), that mix every 8
bytes (`identities`); where identity decides, operators take both or compare the texts.
`spans` gives one polynomial hash for features only: certain pairs of unlike words share it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

U = np.uint64
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text handled at once inside a task.
BLOCK = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Letters and digits: 0-9, A-Z, a-z and every byte beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
#: Longer words are hashed one by one.
LONG_WORD = 256
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)

_seeds = np.random.Generator(np.random.PCG64(20240229))
BYTE = _seeds.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as many as asked for."""

    def __init__(self, base: int):
        self.base = base | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(0, dtype=U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(1 << 16, 1 << (n - 1).bit_length())
            for name, x in (("up", self.base), ("down", self.inverse)):
                a = np.full(size, x, dtype=U)
                a[0] = 1
                setattr(self, name, np.cumprod(a, dtype=U))
        return self.up[:n], self.down[:n]


BYTES = Powers(0x9E3779B97F4A7C15)
WORDS_1 = Powers(0xD1342543DE82EF95)
WORDS_2 = Powers(0xAF251AF3B0F025B5)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit over all others."""
    x = x ^ (x >> U(33))
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


def mix2(x: np.ndarray) -> np.ndarray:
    """Another such bijection."""
    x = x ^ (x >> U(32))
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x *= U(0xA0761D6478BD642F)
    x ^= x >> U(32)
    return x


#: What the hashes of a span start from, by its size.
_START = mix(np.arange(LONG_WORD + 1, dtype=U) + U(0x51)), mix2(np.arange(LONG_WORD + 1, dtype=U) + U(0xC3))


def solid(data: np.ndarray) -> np.ndarray:
    """Whether each byte belongs to a word: all that is not in SPACE."""
    return (data - np.uint8(9) > 4) & (data != 0x20)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def ranges(values: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
    """Hash of values[start:end] for each pair; depends on the values and their number only."""
    if not len(start):
        return np.zeros(0, dtype=U)
    up, down = powers.get(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=U)
    np.cumsum(values * up[:-1], dtype=U, out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U) * U(0x632BE59BD9B4E019))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows in them; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def blocks(offsets: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `size` bytes each, or of one row."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, min(end, n)
        row = end


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and two hashes of each word of the rows, and first word of each row (one more than rows)."""
    start, end, first = runs(solid(data), offsets)
    return start, end, *identities(LOWER[data] if lower else data, start, end), first


def ordered(values: np.ndarray, owner: np.ndarray, number: int) -> np.ndarray:
    """The order of values by owner (0 to number - 1), then by value.

    One sort of the owner with the upper bits of the value; lexsort if the lower bits decide anywhere.
    """
    bits = U(max(1, int(number).bit_length()))
    order = np.argsort(owner.astype(U) << (U(64) - bits) | values >> bits)
    v, own = values[order], owner[order]
    return np.lexsort((values, owner)) if ((v[1:] < v[:-1]) & (own[1:] == own[:-1])).any() else order


def distinct(hashes: np.ndarray, other: np.ndarray, owner: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The set of hashes of each owner (0 to number - 1): sorted distinct hashes of all, their number
    per owner, and two 64-bit identities per owner, from the hashes and from their others."""
    order = ordered(hashes, owner, number)
    h, own = hashes[order], owner[order]
    new = np.append(True, (h[1:] != h[:-1]) | (own[1:] != own[:-1])) if len(h) else np.zeros(0, dtype=bool)
    h, own, order = h[new], own[new], order[new]
    sizes = np.bincount(own, minlength=number)
    live, begin, node = np.flatnonzero(sizes), np.cumsum(sizes) - sizes, np.zeros((number, 2), dtype=U)
    if len(live):
        node[live, 0] = np.add.reduceat(mix(h), begin[live])
        node[live, 1] = np.add.reduceat(mix2(other[order]), begin[live])
    return h, sizes, node


def binary(node: np.ndarray, null: np.ndarray | None = None) -> pa.Array:
    """Pairs of 64-bit identities as a column of 16 bytes."""
    out = pa.Array.from_buffers(pa.binary(16), len(node), [None, pa.py_buffer(np.ascontiguousarray(node).tobytes())]).cast(pa.binary())
    return out if null is None else pc.if_else(pa.array(~null), out, pa.scalar(None, pa.binary()))


def halves(column: pa.Array) -> np.ndarray:
    """The pairs of identities of a column without nulls."""
    fixed = column.cast(pa.binary(16))
    return np.frombuffer(fixed.buffers()[1], dtype=U)[2 * fixed.offset : 2 * (fixed.offset + len(fixed))].reshape(-1, 2) if len(fixed) else np.zeros((0, 2), dtype=U)


def runs(solid: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run of marked bytes inside a row, and first run of each row."""
    edge = np.zeros(len(solid) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty_like(solid)
    after = np.empty_like(solid)
    if len(solid):
        before[0] = after[-1] = False
        before[1:] = solid[:-1]
        after[:-1] = solid[1:]
    start = np.flatnonzero(solid & (~before | edge[:-1]))
    end = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(start, offsets)


def identities(data: np.ndarray, start: np.ndarray, end: np.ndarray, both: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of data[start:end] for each span: a mixing step for every 8 bytes.

    The second is left at that of the size where `both` is false.
    """
    size = end - start
    a, b = (x.take(np.minimum(size, LONG_WORD)) for x in _START)
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    eight = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    use = (size > 0) & (size <= LONG_WORD)
    live = slice(None) if use.all() else np.flatnonzero(use)
    at, left = start[live], size[live]
    while len(at):
        piece = eight[at] & _KEEP.take(np.minimum(left, 8))
        a[live] = mix(a[live] ^ piece)
        if both:
            b[live] = mix2(b[live] ^ (piece * U(0x9E3779B97F4A7C15)))
        more = np.flatnonzero(left > 8)
        live, at, left = more if isinstance(live, slice) else live[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        a[i], b[i] = np.frombuffer(hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=16).digest(), dtype="<u8")
    return a, b


def spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for sorted byte spans, in slices so that long texts need no more memory."""
    out, i = np.empty(len(start), dtype=U), 0
    while i < len(start):
        at = start[i]
        j = max(i + 1, int(np.searchsorted(end, at + BLOCK, "right")))
        out[i:j] = ranges(BYTE[data[at : end[j - 1]]], start[i:j] - at, end[i:j] - at, BYTES)
        i = j
    return out


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each k words of a row in sequence, and first shingle of each row.

    A row of 1 to k-1 words has one shingle, the whole sequence; a row of none has none.
    """
    counts = np.diff(first)
    number = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    begin = np.concatenate(([0], np.cumsum(number)))
    row = np.repeat(np.arange(len(counts)), number)
    start = first[row] + np.arange(len(row)) - begin[row]
    length = np.minimum(counts, k)[row]
    out = np.zeros(len(row), dtype=U)
    for j in range(k):
        inside = j < length
        out = np.where(inside, mix(out * U(0x9FB21C651E98DF25) + hashes[np.minimum(start + j, max(len(hashes) - 1, 0))]) if len(hashes) else out, out)
    return out, begin


def chars(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code points of each row."""
    heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return heads[offsets[1:]] - heads[offsets[:-1]]


def handled(docs: DataFrame, *columns: Column | str) -> DataFrame:
    """docs with `_id`, `_key`: a handle without nulls that rows share only if id and text are equal."""
    return docs.select(*columns, F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-1)).alias("_id"), F.xxhash64(F.col("text")).alias("_key"))


def boxed(docs: DataFrame, but: str | None = None) -> Column:
    """All columns of docs (but one) as the struct `row`, so that no name of theirs clashes with an operator's."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != but)).alias("row")


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
