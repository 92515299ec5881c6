"""Small frames of documents with every awkward case, and random ones with planted copies."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(draw: random.Random, n: int, size: int = 4000) -> list[str]:
    return [f"w{draw.randrange(size)}" for _ in range(n)]


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    """Random texts, exact copies, near copies, shared passages and lines, short texts, empties and nulls."""
    draw = random.Random(seed)
    passage, line = prose(draw, 60), " ".join(prose(draw, 12))
    texts: list[str | None] = []
    for i in range(n):
        words = prose(draw, draw.choice([3, 20, 40, 90, 200]))
        kind = i % 6
        if kind == 1 and texts:
            words = (draw.choice([t for t in texts if t]) or "").split()
        if kind == 2:
            at = draw.randrange(len(words))
            words[at:at] = passage[: draw.choice([34, 35, 36, 60])]
        if kind == 3 and texts:
            words = (draw.choice([t for t in texts if t]) or "x").split()
            for _ in range(max(1, len(words) // 60)):
                words[draw.randrange(len(words))] = "edited"
        text = ""
        for w in words:
            text += w + draw.choice([" ", " ", " ", "\n", "\t"])
        if kind == 4:
            text += "\n" + line + "\n"
        texts.append(text)
    texts += [None, "", " \n\t ", "One", "one", "One", "É é ▁  x", "same " * 300, "same " * 300, "Ünï " * 50]
    return [(i * 3 + 1, t, draw.choice(["en", "de", None]), draw.choice(["src0", "src0", "src1", "src12", None]), len(t or "")) for i, t in enumerate(texts)]


def frame(spark, rows, extra: bool = False):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if extra:
        for name in ("_id", "_key", "row", "node", "score", "label", "key", "bucket", "copies", "_text", "n"):
            from pyspark.sql import functions as F

            docs = docs.withColumn(name, F.lit("x"))
    return docs
