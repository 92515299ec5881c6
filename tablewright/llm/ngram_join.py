"""N-gram Jaccard join by prefixes under several global orders of the tokens.

A document's tokens are its distinct word shingles. Under any one order of all tokens, two
sets of Jaccard t or more share a token among the first |x| - ceil(t |x|) + 1 of each. The
first order makes the candidates. Of those that the parity maps of the sets do not rule out the
sets' prefixes under ORDERS - 1 further orders are taken where their texts meet, and pairs that
share no token under one of them are done; only the rest are intersected in full.

All orders put rare tokens first: those not known to be frequent by a hash (another one for
each order), then the frequent ones by count; further orders take CLASS of them with like
counts as a class, ordered by their hash. Frequent tokens are found over all documents
by counting in parts: a part of PART tokens reports those it has LOCAL times or more. The
FREQUENT most frequent reported ones are broadcast (8 bytes each). Any order gives the same
links; this one keeps common passages out of the prefixes.

Words are lower-cased A-Z only. Under `k` words the whole sequence is the only token; null,
empty or blank texts have none and are linked with nothing. Rows with one doc_id share a
component only if their texts are linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .linking import linked, shingle_sets

K = 4
PERCENT = 85
ORDERS = 3
FREQUENT = 1 << 17
LOCAL = 4
PART = 1 << 22
CLASS = 1 << 10
FREQUENT_BIT = T.U(1 << 63)


def frequent_tokens(docs: DataFrame, k: int) -> np.ndarray:
    """Frequent tokens, least frequent first."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            token, n = np.unique(np.concatenate(held) if held else np.zeros(0, dtype=T.U), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(T.signed(token[n >= LOCAL])), pa.array(n[n >= LOCAL])], names=["token", "n"])

        size = 0
        for whole in batches:
            for p in range(0, whole.num_rows, 1024):
                held += shingle_sets(whole.column("text").slice(p, 1024), k, True)[0]
                size = sum(map(len, held))
                if size > PART:
                    yield out()
                    held.clear()
        yield out()

    found = docs.select("text").mapInArrow(task, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    rows = found.orderBy(F.desc("n"), "token").limit(FREQUENT).collect()
    return np.array([r.token for r in reversed(rows)], dtype=np.int64).view(T.U)


class Orders:
    """Ranks of tokens under each order; smaller ranks come first."""

    def __init__(self, frequent: np.ndarray, percent: int):
        self.by_hash = np.argsort(frequent, kind="stable")
        self.frequent, self.percent = frequent[self.by_hash], percent

    def ranks(self, tokens: np.ndarray, order: int) -> np.ndarray:
        rank = T.mix(tokens + T.U(order * 0x1234567)) >> T.U(1)
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, tokens), len(self.frequent) - 1)
            known = self.frequent[at] == tokens
            place = self.by_hash[at[known]].astype(T.U)
            rank[known] = FREQUENT_BIT | (place if order == 0 else (place // T.U(CLASS)) << T.U(32) | rank[known] >> T.U(31))
        return rank

    def prefix(self, tokens: np.ndarray, order: int, ranks: np.ndarray | None = None) -> np.ndarray:
        size = len(tokens) - (len(tokens) * self.percent + 99) // 100 + 1
        if size >= len(tokens):
            return tokens
        return tokens[np.argpartition(self.ranks(tokens, order) if ranks is None else ranks, size - 1)[:size]]

    def keys(self, _: pa.Array, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        flat = np.concatenate(sets) if sets else np.zeros(0, dtype=T.U)
        ranks, begin = self.ranks(flat, 0), np.concatenate(([0], np.cumsum([len(s) for s in sets])))
        out = [self.prefix(s, 0, ranks[p : p + len(s)]) for s, p in zip(sets, begin[:-1].astype(int).tolist(), strict=True)]
        return np.concatenate(out) if out else flat, np.concatenate(([0], np.cumsum([len(x) for x in out])))

    def marks(self, flat: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """Whether each token of the sets is in its set's prefix, under each further order."""
        length = sizes - (sizes * self.percent + 99) // 100 + 1
        begin = (np.cumsum(sizes) - sizes).tolist()
        out = []
        for order in range(1, ORDERS):
            ranks = self.ranks(flat, order)
            last = np.array([np.partition(ranks[p : p + n], m - 1)[m - 1] for p, n, m in zip(begin, sizes.tolist(), length.tolist(), strict=True)], dtype=T.U)
            out.append(ranks <= np.repeat(last, sizes))
        return out


def jaccard_components(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """doc_id, handle, n_shingles, component_id of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(Orders(frequent_tokens(docs, k), percent))
    found = linked(docs, lambda texts, sets: shared.value.keys(texts, sets), k, percent, True, (lambda flat, sizes: shared.value.marks(flat, sizes)) if ORDERS > 1 else None, mapped=ORDERS > 1)
    shared.destroy()  # linked has written all that needs the orders
    return found


def one_of_each(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The rows of docs whose doc_id is the least of its component; all columns stay."""
    found = jaccard_components(docs, k, percent).where("doc_id is null or component_id = doc_id").select("_id", "_key").distinct()
    return T.handled(docs, T.boxed(docs)).join(found, ["_id", "_key"], "left_semi").select("row.*")


def op4_ngram_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(T.documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


ORACLE = f"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as ws from documents),
w as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as i, len(ws) as n from d),
g as (select doc_id, i, n, string_agg(word, ' ') over (partition by doc_id order by i rows between current row and {K - 1} following) as g from w),
s as (select distinct doc_id, g from g where i + {K - 1} <= n or i = 1),
z as (select doc_id, count(*) as n from s group by 1),
p as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b using (g) where a.doc_id < b.doc_id group by all),
l as (select x, y from p join z a on a.doc_id = x join z b on b.doc_id = y where 100 * c >= {PERCENT} * (a.n + b.n - c)),
e as (select x, y from l union all select y, x from l),
r as (select x as doc_id, y as other from e union select r.doc_id, e.y from r join e on r.other = e.x)
select doc_id, coalesce(n, 0) as n_shingles, least(doc_id, (select min(other) from r where r.doc_id = d.doc_id)) as component_id from d left join z using (doc_id)
"""
