"""SentencePiece encoding and decoding by a streaming Viterbi search.

The pieces and their scores come from a given model file, read once on the driver and
broadcast (a vocabulary is bounded). Text is escaped as the model expects it: a leading
space is added and spaces become U+2581. The search keeps the segmentation of greatest total
score; among equal ones that of the shorter last piece, which lets paths meet early (runs of
one character). A character that is no piece, and a literal U+2581, is spelled in byte pieces, at a score below all pieces.

The search runs over a window: it relaxes every piece that starts at a reached position and
commits ids as soon as all surviving back pointers pass through one boundary, either because
the position is the only one still open or because the paths from all open ones (at most
one longest piece ahead) meet. Memory follows the distance between such boundaries, not the
text. Since no piece has U+2581 after another character, words are cut there beforehand and
short ones remembered, in two generations of at most MEMO words per task.

Decoding is exact: decode(encode(text)) == text for every text. Null text encodes as the
empty one, which has no ids.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
MEMO = 1 << 17
SHORT = 48
#: Stands for a literal U+2581 while a text is escaped; no valid text holds it.
LITERAL = "\ud800"


def trie(scores: dict[str, tuple[float, int]]) -> dict:
    """Pieces by character; "" at a node has the score and id of the piece that ends there."""
    root: dict = {}
    for piece, found in scores.items():
        node = root
        for char in piece:
            node = node.setdefault(char, {})
        node[""] = found
    return root


class Pieces:
    """Pieces of a model by text, and the bytes of each id."""

    def __init__(self, model: str):
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=model)
        size = p.get_piece_size()
        self.spelled = [p.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(p.is_byte(i) for i in self.spelled):
            raise ValueError("the model needs byte pieces")
        plain = [i for i in range(size) if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i))]
        self.scores = {p.id_to_piece(i): (p.get_score(i), i) for i in plain}
        self.longest = max(map(len, self.scores))
        self.unknown = min(s for s, _ in self.scores.values()) - 10
        self.trie = trie(self.scores)
        self.words = not any(re.search(f"[^{SPACE}]{SPACE}", x) for x in self.scores)
        self.bytes = [b""] * size
        for i in plain:
            self.bytes[i] = p.id_to_piece(i).replace(SPACE, " ").encode()
        for b, i in enumerate(self.spelled):
            self.bytes[i] = bytes([b])


def committed(text: str, pieces: Pieces) -> Iterator[list[int]]:
    """Ids of an escaped text, a list for each boundary that all surviving paths share."""
    trie, unknown, n = pieces.trie, pieces.unknown, len(text)
    base, i, far = 0, 0, 0  # of the window: its start in the text, the position in it, the last open one
    best, back, ids = [0.0], [0], [-1]  # for each position: its score, where its last piece starts, and that piece

    while base + i < n:
        boundary = i if i == far else 0
        if not boundary and i >= 4 * pieces.longest and i % pieces.longest == 0:
            boundary = _meeting(back, [p for p in range(i, far + 1) if best[p] > -np.inf])
        if boundary:
            yield _path(text, base, boundary, back, ids, pieces)
            best, ids, back = best[boundary:], ids[boundary:], [p - boundary for p in back[boundary:]]
            base, i, far = base + boundary, i - boundary, far - boundary
        here = best[i]
        if here > -np.inf:
            node, j = trie, i
            while True:
                node = node.get(text[base + j]) if base + j < n else None
                if node is None and j > i:
                    break
                j += 1
                found = node and node.get("")
                if j == i + 1 and not found:
                    score, piece = here + unknown, -1
                elif found:
                    score, piece = here + found[0], found[1]
                else:
                    continue
                while j >= len(best):
                    best.append(-np.inf)
                    back.append(0)
                    ids.append(-1)
                if score >= best[j]:
                    best[j], back[j], ids[j] = score, i, piece
                far = max(far, j)
                if node is None:
                    break
        i += 1
    if n > base:
        yield _path(text, base, n - base, back, ids, pieces)


def _path(text: str, base: int, end: int, back: list[int], ids: list[int], pieces: Pieces) -> list[int]:
    """The ids that lead to a position of the window; -1 stands for a character in byte pieces."""
    out = []
    while end:
        if ids[end] >= 0:
            out.append(ids[end])
        else:
            char = text[base + back[end]]
            out += reversed([pieces.spelled[b] for b in (SPACE if char == LITERAL else char).encode("utf-8", "surrogatepass")])
        end = back[end]
    return out[::-1]


def of_word(word: str, pieces: Pieces) -> list[int]:
    """The same search for a short text, of which the window holds all."""
    trie, unknown, n = pieces.trie, pieces.unknown, len(word)
    best, back, ids = [0.0] + [-np.inf] * n, [0] * (n + 1), [-1] * (n + 1)
    for i in range(n):
        here, node, j = best[i], trie, i
        if here == -np.inf:
            continue
        alone = trie.get(word[i])
        if alone is None or "" not in alone:
            if here + unknown >= best[i + 1]:
                best[i + 1], back[i + 1], ids[i + 1] = here + unknown, i, -1
        while j < n:
            node = node.get(word[j])
            if node is None:
                break
            j += 1
            found = node.get("")
            if found is not None and here + found[0] >= best[j]:
                best[j], back[j], ids[j] = here + found[0], i, found[1]
    return _path(word, 0, n, back, ids, pieces)


def _meeting(back: list[int], open_: list[int]) -> int:
    """The last boundary on the paths of all open positions."""
    paths = set(open_)
    while len(paths) > 1:
        last = max(paths)
        paths.remove(last)
        paths.add(back[last])
    return paths.pop()


class Codec(dict):
    """A memo of words' ids, as 32-bit bytes, in two generations of MEMO words each."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.older = pieces, {}
        self.cut = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall if pieces.words else lambda text: [text]

    def __missing__(self, word: str) -> bytes:
        if len(word) > SHORT:
            return b"".join(array("i", ids).tobytes() for ids in committed(word, self.pieces))
        out = self.older.get(word)
        if out is None:
            out = array("i", of_word(word, self.pieces)).tobytes()
        if len(self) >= MEMO:
            self.older = dict(self)
            self.clear()
        self[word] = out
        return out

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=np.int32)
        escaped = SPACE + text.replace(SPACE, LITERAL).replace(" ", SPACE)
        return np.frombuffer(b"".join(map(self.__getitem__, self.cut(escaped))), dtype=np.int32)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.pieces.bytes.__getitem__, ids.tolist()))[1:].decode("utf-8", "surrogatepass")


def encode(docs: DataFrame, *columns: str, model: str = MODEL) -> DataFrame:
    """`columns` of docs, n_ids, ids and round_trip (whether the ids decode to the text)."""
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(model))
    rows = docs.select(*columns, F.col("text").alias("_text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for whole in batches:
            for p in range(0, whole.num_rows, 256):
                batch = whole.slice(p, 256)
                texts = [x or "" for x in batch.column("_text").to_pylist()]
                ids = [codec.encode(x) for x in texts]
                same = [codec.decode(i) == x for i, x in zip(ids, texts, strict=True)]
                sizes = np.array([len(i) for i in ids], dtype=np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(np.concatenate(ids) if ids else [], pa.int32()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(sizes), lists, pa.array(same)], names=[*columns, "n_ids", "ids", "round_trip"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return rows.mapInArrow(task, f"{fields}n_ids long, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, *columns: str, model: str = MODEL) -> DataFrame:
    """`columns` of a frame with `ids`, and text."""
    shared = encoded.sparkSession.sparkContext.broadcast(Pieces(model))
    rows = encoded.select(*columns, F.col("ids").alias("_ids"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for batch in batches:
            texts = [codec.decode(np.array(x or [], dtype=np.int64)) for x in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(texts, pa.string())], names=[*columns, "text"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return rows.mapInArrow(task, f"{fields}text string")


def op9_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return encode(T.documents(spark, sf_dir), "doc_id")
