"""Spelling variants, ranked search and decontamination against brute force, and their awkward cases."""

from __future__ import annotations

import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablewright.llm import decontamination, ranked_search, screen, spelling
from tablewright.llm import text as T

from .cases import SCHEMA, corpus, frame

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
RUN = re.compile(r"[A-Za-zÀ-ÿ]+")


def thue_morse(a: str, b: str) -> str:
    return "".join((a, b)[bin(i).count("1") & 1] for i in range(1024))


TWINS = thue_morse("a", "b"), thue_morse("b", "a")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("query", F.lit("x")).withColumn("n", F.lit("x"))


# identities and screens


def test_identities_tell_apart_what_the_polynomial_confuses():
    texts = [*TWINS, "a", "b", "aa", "abcdefgh", "abcdefghi", "abcdefgh\0", "x" * 300, "x" * 299 + "y"]
    data, offsets = T.buffers(pa.array(texts))
    a, b = T.identities(data, offsets[:-1], offsets[1:])
    assert len(set(a.tolist())) == len(set(b.tolist())) == len(texts)
    poly = T.spans(data, offsets[:-1], offsets[1:])
    assert poly[0] == poly[1]
    alone = [T.identities(*(T.buffers(pa.array([t]))[0], np.array([0]), np.array([len(t)]))) for t in texts]
    assert [x[0][0] for x in alone] == a.tolist() and [x[1][0] for x in alone] == b.tolist()


def test_screen_finds_every_hash(spark):
    draw = np.random.default_rng(1)
    put, other = (draw.integers(-(2**63), 2**63, 5000, dtype=np.int64) for _ in range(2))
    marks = screen.build(spark.createDataFrame([(int(x),) for x in put], "h long"))
    assert marks.test(put.view(T.U)).all() and marks.test(other.view(T.U)).mean() < 0.1
    assert not screen.build(spark.createDataFrame([], "h long")).test(put.view(T.U)).any()


# op11


def brute_variants(rows):
    count = collections.Counter()
    for doc, text, *_ in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{doc}:{run}".encode()) if doc is not None else 1
            if h % spelling.MISPRINT == 0:
                cut = h % len(run)
                run = run[:cut] + run[cut + 1 :]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 6 and c >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    close = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(close[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(close[w]), n[form[w]] if form[w] is not None else None))
    return sorted(out, key=repr)


def variant_rows(seed, n=40):
    draw = random.Random(seed)
    base = ["".join(draw.choice("abcdeé") for _ in range(draw.choice([6, 7, 7, 8, 12, 15]))) for _ in range(30)]

    def edited(w):
        i, kind = draw.randrange(len(w)), draw.randrange(3)
        return w[:i] + (draw.choice("abcdeÉé") if kind else "") + w[i + (kind < 2) :]

    family = base + [edited(w) for w in base for _ in range(3)]
    family += [edited(w) for w in family]
    rows = []
    for i in range(n):
        text = " ".join(x.upper() if draw.random() < 0.1 else x for x in (draw.choice(family if draw.random() < 0.4 else base[:6]) for _ in range(200)))
        rows.append((i, text, "en", "s", len(text)))
    # Forms in a chain: each word is near the next one, which occurs over five times as often.
    chain = " ".join(["abcdefgh"] * 400 + ["abcdefgx"] * 60 + ["abcdefyx"] * 9)
    return [*rows, (n, chain, "en", "s", len(chain))]


@pytest.mark.parametrize("seed", [1, 2])
def test_variants(spark, seed):
    rows = variant_rows(seed)
    rows += [rows[3], (None, rows[4][1], "en", "s", 0), (901, None, None, None, None), (902, "", "en", "s", 0), (903, f"{'z' * 5000} " * 6 + f"{'z' * 5001} " * 40, "en", "s", 0)]
    got = spelling.variants(frame(spark, rows, extra=True)).collect()
    want = brute_variants(rows)
    assert sorted(map(tuple, got), key=repr) == want
    assert sum(r[1] is not None for r in want) > 20 and any(r[1] not in (None, r[2]) for r in want)


def test_variants_in_parts(spark, monkeypatch):
    rows = variant_rows(3, 30)
    monkeypatch.setattr(spelling, "PART", 4)
    assert sorted(map(tuple, spelling.variants(frame(spark, rows)).collect()), key=repr) == brute_variants(rows)
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).count() == 0


def test_scan_leaves_out_what_cannot_match():
    listed = sorted(("aa" + "".join(x)).encode() for x in itertools.product("abcd", repeat=5))
    found = {(listed[k], listed[j]) for k, js in spelling.scan(listed, listed, 2) for j in js.tolist()}
    want = {(a, b) for a in listed for b in listed if sum(x != y for x, y in zip(a, b)) == 1}
    assert found == want
    # b"aab..." leaves at its third letter: nothing is near, so nothing of the list is reported.
    assert not list(spelling.scan(listed, [b"aaxyzzy"], 2))


def test_vectorised_crc():
    texts = ["", "a", "Ünï", "x" * 999]
    data, offsets = T.buffers(pa.array(texts))
    begun = np.array([zlib.crc32(b"12:")] * 4, dtype=np.uint32)
    assert spelling.crc32(begun, data, offsets[:-1], offsets[1:]).tolist() == [zlib.crc32(f"12:{t}".encode()) for t in texts]


# op12


def brute_search(rows, asked, top=20):
    docs = [(doc, collections.Counter(words(text)), len(words(text))) for doc, text, *_ in rows]
    docs = [d for d in docs if d[2]]
    total, length = len(docs), sum(d[2] for d in docs)
    df = collections.Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in asked:
        scored = []
        for doc, c, n in docs:
            m = 75 + 25 * n * total // length
            score = sum(math.floor(1000 * math.log((2.0 * total + 2) / (2.0 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in words(text) if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc if doc is not None else 0))
        out += [(item, i, None if none else doc, -s) for i, (s, none, doc) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


def asked_rows(rows, seed):
    draw = random.Random(seed)
    asked = [(i, " ".join(draw.choice(words(r[1]) or ["none"]) for _ in range(draw.choice([1, 5, 30])))) for i, r in enumerate(rows[:25])]
    asked += [(100, "w1 W1 w2, w3."), (101, None), (102, " "), (103, "unknown"), (104, f"{TWINS[0]} {TWINS[0]}"), (None, "w1 w5"), (7, "w2 w9"), (7, "w2 w9")]
    return asked


@pytest.mark.parametrize("seed", [1, 2])
def test_search(spark, seed):
    rows = corpus(seed)
    rows += [(rows[5][0], rows[5][1], "en", "s", 0), (None, rows[3][1], "en", "s", 0), (800, TWINS[0], "en", "s", 0), (801, TWINS[1], "en", "s", 0), (802, "w1 " * 30000, "en", "s", 0)]
    asked = asked_rows(rows, seed)
    got = ranked_search.search(frame(spark, rows, extra=True), items(spark, asked))
    assert sorted(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect()), key=repr) == brute_search(rows, asked)


def test_search_in_small_shards_and_blocks(spark, monkeypatch):
    rows = corpus(4, 90)
    asked = asked_rows(rows, 4)
    monkeypatch.setattr(ranked_search, "SHARD", 50)
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", 60)
    got = ranked_search.search(frame(spark, rows), items(spark, asked), top=3)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_search(rows, asked, 3)
    nothing = spark.createDataFrame([], SCHEMA)
    assert ranked_search.search(nothing, items(spark, asked)).count() == 0
    assert ranked_search.search(frame(spark, rows), items(spark, [])).count() == 0


def test_search_of_a_shard_reads_part_of_the_lists():
    draw = np.random.default_rng(5)
    lists = []
    # The documents of the first list lead the others, too; one missing there could only be told at the end.
    order = draw.permutation(4000)
    for n in (20, 3000, 3000):
        doc = order[:n]
        lists.append((doc, np.sort(draw.integers(1, 1000, n))[::-1].copy()))
    weights = [9000, 40, 30]
    found, scores, read = ranked_search.search_shard(lists, weights, 4000, 10, 0)
    whole = np.zeros(4000, dtype=np.int64)
    for (doc, impact), w in zip(lists, weights):
        whole[doc] += impact * w
    assert (scores == whole[found]).all()
    assert sorted(scores.tolist())[-10:] == sorted(whole.tolist())[-10:]
    assert read < 6020


# op13


def brute_windows(rows, asked, length=10):
    wins = collections.defaultdict(set)
    for item, text in asked:
        own = words(text)
        size = min(length, len(own))
        for p in range(len(own) - size + 1 if own else 0):
            wins[tuple(own[p : p + size])].add(item)
    sizes = {len(w) for w in wins}
    out = []
    for doc, text, *_ in rows:
        own, hit, found = words(text), set(), set()
        for size in sizes:
            for p in range(len(own) - size + 1):
                w = tuple(own[p : p + size])
                if w in wins:
                    hit |= set(range(p, p + size))
                    found |= wins[w]
        out.append((doc, len(own), len(hit), sorted(str(i) for i in found if i is not None)))
    return sorted(out, key=repr)


def planted(seed):
    draw = random.Random(seed)
    rows = corpus(seed)
    asked = [(i, " ".join(f"w{draw.randrange(60)}" for _ in range(draw.choice([4, 9, 10, 11, 25, 40])))) for i in range(20)]
    asked += [(50, None), (51, "  "), (52, "edited"), (None, rows[8][1]), (53, asked[3][1]), (3, asked[3][1]), (54, " ".join([*["w1"] * 9, TWINS[0]]))]
    texts = []
    for i in range(30):
        own = [f"w{draw.randrange(60)}" for _ in range(80)]
        for _ in range(draw.randrange(4)):
            passage = (draw.choice(asked)[1] or "").split()
            at, cut = draw.randrange(len(own)), draw.randrange(len(passage) + 1)
            own[at:at] = draw.choice([passage, passage[cut:], passage[: cut + 8]])
        texts.append(draw.choice([" ", ", ", "-\n"]).join(own).title())
    rows += [(1000 + i, t, "en", "s", 0) for i, t in enumerate(texts)]
    rows += [rows[-1], (None, texts[0], "en", "s", 0), (1100, " ".join([*["w1"] * 9, TWINS[1]]), "en", "s", 0), (1101, (asked[0][1] + " x ") * 3000, "en", "s", 0)]
    return rows, asked


@pytest.mark.parametrize("seed", [1, 2])
def test_decontaminate(spark, seed):
    rows, asked = planted(seed)
    got = decontamination.decontaminate(frame(spark, rows, extra=True), items(spark, asked)).collect()
    want = brute_windows(rows, asked)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in got), key=repr) == want
    assert sum(w[2] > 0 for w in want) > 20 and any(w[2] == 0 < w[1] for w in want)


def test_decontaminate_in_blocks(spark, monkeypatch):
    rows, asked = planted(3)
    monkeypatch.setattr(decontamination, "WORD_BLOCK", 16)
    marks = screen.build(decontamination.windows(items(spark, asked), 10, 3).select(F.explode("grams").alias("h")))
    whole, blocks = [], []
    for size, out in ((1 << 20, whole), (16, blocks)):
        monkeypatch.setattr(decontamination, "WORD_BLOCK", size)
        for _, text, *_ in rows:
            data, offsets = T.buffers(pa.array([text]))
            low = T.LOWER[data]
            out.append(decontamination.segment_places(low, *T.runs(T.ALNUM[low], offsets), marks, [(1, 1), (3, 2)], []))
    assert whole == blocks and any(x[0] for x in whole)


def test_decontaminate_nothing(spark):
    rows, asked = planted(4)
    assert decontamination.decontaminate(spark.createDataFrame([], SCHEMA), items(spark, asked)).count() == 0
    got = decontamination.decontaminate(frame(spark, rows), items(spark, [])).collect()
    assert sorted((r.n_words, r.n_hit, r.n_items) for r in got) == sorted((len(words(r[1])), 0, 0) for r in rows)
    with pytest.raises(ValueError):
        decontamination.decontaminate(frame(spark, rows), items(spark, asked), 2, 3)
