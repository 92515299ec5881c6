"""Ranked lexical search without random access (NRA) over impact-sorted lists.

Each row of `items` is a query; its best documents come from these steps.

1. Items are cut into blocks of about BLOCK_TERMS terms, whose dictionary (24 bytes a term) is
   broadcast; a block is a search of its own. Terms are told apart by two hashes (128 bits).
2. One pass over the documents writes the postings of the block's terms by document, and counts
   all documents, terms and documents of a term.
3. Documents are searched in shards of at most SHARD postings (or one document). In a shard a
   term's postings are sorted by impact, and each item reads its lists in that order, always
   down to the same contribution in all lists, which is halved each time. Every document has a
   lower score (what was read) and an upper one (plus what the lists not seen for it can still
   give). A document whose upper score is below the K-th lower one goes. Reading ends when lower
   and upper scores agree for all that are left: then members, ties and scores are final. The
   K-th score carries over to the next shards of the task.
4. The best of all tasks are merged in two rounds.

A term is a run of letters, digits and all characters beyond ASCII, A-Z lower-cased. Scores are
64-bit integers. Null or empty texts have no terms; documents without terms are not counted.
Equal scores stand by ascending doc_id, null last; repeated rows of documents are documents of
their own, repeated rows of items give their result once each. An item without terms, or with
terms that no document has, has no result. A long text is one shard if need be.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import text as T

TOP = 20
BLOCK_TERMS = 1 << 20
SHARD = 1 << 21
#: Words of documents that are looked up at once.
WORD_BLOCK = 1 << 20
#: First-round groups in which the best of all tasks are merged.
FAN = 64
_POSTED = "doc_id long, n long, terms array<int>, tfs array<int>, term int, df long"


def item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of query, a, b: each term of an item by its two hashes."""
    for batch in batches:
        data, offsets = T.buffers(batch.column("text"))
        low = T.LOWER[data]
        start, end, first = T.runs(T.ALNUM[data], offsets)
        a, b = T.identities(low, start, end)
        query = np.repeat(batch.column("query").to_numpy(), np.diff(first))
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(T.signed(a)), pa.array(T.signed(b))], names=["query", "a", "b"])


@dataclass
class Dictionary:
    """Terms of a block by rising hash; a term's number is its place."""

    a: np.ndarray
    b: np.ndarray

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for words that are no terms."""
        out = np.full(len(a), -1, dtype=np.int32)
        at = np.searchsorted(self.a, a)
        same = np.flatnonzero(at < len(self.a))
        while len(same):  # more than once only for terms with one first hash
            same = same[self.a[at[same]] == a[same]]
            hit = self.b[at[same]] == b[same]
            out[same[hit]] = at[same[hit]]
            same = same[~hit]
            at[same] += 1
            same = same[at[same] < len(self.a)]
        return out


def _postings(shared):
    """Rows of _POSTED: doc_id, n, terms, tfs of each document with terms; and term, df."""
    names = ["doc_id", "n", "terms", "tfs", "term", "df"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Dictionary = shared.value
        df = np.zeros(len(words.a), dtype=np.int64)
        for batch in batches:
            data, offsets = T.buffers(batch.column("text"))
            for x, y in T.blocks(offsets):
                low = T.LOWER[data[offsets[x] : offsets[y]]]
                start, end, first = T.runs(T.ALNUM[low], offsets[x : y + 1] - offsets[x])
                lookup = np.empty(len(start), dtype=np.int64)
                for p in range(0, len(start), WORD_BLOCK):
                    q = slice(p, p + WORD_BLOCK)
                    lookup[q] = words.numbers(*T.identities(low, start[q], end[q]))
                n = np.diff(first)
                row = np.repeat(np.arange(y - x), n)
                own = np.flatnonzero(lookup >= 0)
                pair, tf = np.unique((row[own] << 32) + lookup[own], return_counts=True)
                term = pair & 0xFFFFFFFF
                df += np.bincount(term, minlength=len(df))
                cut = np.searchsorted(pair, np.arange(y - x + 1) << 32).astype(np.int32)
                none = pa.nulls(y - x, pa.int32())
                rows = [batch.column("doc_id").slice(x, y - x), pa.array(n.astype(np.int64)), pa.ListArray.from_arrays(pa.array(cut), pa.array(term.astype(np.int32))), pa.ListArray.from_arrays(pa.array(cut), pa.array(tf.astype(np.int32))), none, none.cast(pa.int64())]
                yield pa.RecordBatch.from_arrays(rows, names=names).filter(pa.array(n > 0))
        term = np.flatnonzero(df)
        none = pa.nulls(len(term), pa.int64())
        lists = pa.nulls(len(term), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([none, none, lists, lists, pa.array(term.astype(np.int32)), pa.array(df[term])], names=names)

    return task


@dataclass
class Queries:
    """Terms (numbers) and weights of each query; query i owns begin[i]:begin[i + 1]."""

    query: np.ndarray
    begin: np.ndarray
    term: np.ndarray
    weight: np.ndarray
    documents: int
    length: int


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    m = 75 + (25 * n * documents) // max(length, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def search_shard(lists: list[tuple[np.ndarray, np.ndarray]], weights: list[int], docs: int, top: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents (numbers below `docs`) that can be among the best, their scores, postings read.

    lists: documents and impacts of each term, impacts falling. Documents below `floor` are of
    no use; those returned have exact scores.
    """
    read = [0] * len(lists)
    lower = np.zeros(docs, dtype=np.int64)
    seen = np.zeros((len(lists), docs), dtype=bool)
    next_ = np.array([w * int(i[0]) for (_, i), w in zip(lists, weights, strict=True)], dtype=np.int64)
    alive = None
    while True:
        rest = int(next_.sum())
        if alive is None:
            # The K-th best so far; documents without any posting read stand for all the others.
            kth = max(floor, int(np.partition(lower, docs - top)[docs - top]) if docs > top else 0, 1)
            if rest < kth:
                alive = np.flatnonzero(lower + rest >= kth)
        if alive is not None:
            open_ = rest - next_ @ seen[:, alive]
            sums = lower[alive]
            kth = max(floor, int(np.partition(sums, len(sums) - top)[len(sums) - top]) if len(sums) > top else 0, 1)
            left = sums + open_ >= kth
            alive, open_ = alive[left], open_[left]
            if not open_.any():
                return alive, lower[alive], sum(read)
        if not rest:
            alive = np.flatnonzero(lower >= kth)
            return alive, lower[alive], sum(read)
        bound = int(next_.max()) // 2
        for j, ((doc, impact), w) in enumerate(zip(lists, weights, strict=True)):
            if next_[j] > bound:
                # Impacts fall, so those whose contribution is above the bound come first.
                end = len(impact) - int(np.searchsorted(impact[::-1], bound // w, "right"))
                new = doc[read[j] : end]
                lower[new] += impact[read[j] : end] * w
                seen[j, new] = True
                read[j] = end
                next_[j] = int(impact[end]) * w if end < len(impact) else 0


def _search(shared, top: int):
    """Rows of query, doc_id, score: the best documents of each task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = shared.value
        floor = np.zeros(len(queries.query), dtype=np.int64)
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))] * len(floor)

        def shard(batch: pa.RecordBatch) -> None:
            ids = batch.column("doc_id")
            # Null ids come last among equal scores; the largest number stands for them.
            ids = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
            sizes = np.diff(batch.column("terms").offsets.to_numpy())
            term, tf = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("terms", "tfs"))
            doc = np.repeat(np.arange(len(ids)), sizes)
            impact = impacts(tf, batch.column("n").to_numpy()[doc], queries.documents, queries.length)
            order = np.lexsort((-impact, term))
            term, doc, impact = term[order], doc[order], impact[order]
            begin, end = np.searchsorted(term, queries.term), np.searchsorted(term, queries.term, "right")
            for i, (p, q) in enumerate(zip(queries.begin[:-1].tolist(), queries.begin[1:].tolist(), strict=True)):
                own = [j for j in range(p, q) if begin[j] < end[j] and queries.weight[j]]
                if not own:
                    continue
                found, scores, _ = search_shard([(doc[begin[j] : end[j]], impact[begin[j] : end[j]]) for j in own], [int(queries.weight[j]) for j in own], len(ids), top, int(floor[i]))
                if len(found):
                    who, what = np.concatenate((best[i][0], ids[found])), np.concatenate((best[i][1], scores))
                    first = np.lexsort((who, -what))[:top]
                    best[i] = (who[first], what[first])
                    floor[i] = what[first[-1]] if len(first) == top else 0

        for whole in batches:
            size = np.concatenate(([0], np.cumsum(np.diff(whole.column("terms").offsets.to_numpy()))))
            p = 0
            while p < whole.num_rows:
                q = max(p + 1, int(np.searchsorted(size, size[p] + SHARD, "right")) - 1)
                shard(whole.slice(p, q - p))
                p = q
        query = np.repeat(queries.query, [len(x[0]) for x in best])
        who, what = (np.concatenate([x[i] for x in best] or [np.zeros(0, dtype=np.int64)]) for i in (0, 1))
        none = who == np.iinfo(np.int64).max
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(who, mask=none), pa.array(what)], names=["query", "doc_id", "score"])

    return task


def _best(rows: DataFrame, keys: list[str], top: int) -> DataFrame:
    by_score = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top)


def _block(docs: DataFrame, terms: DataFrame, top: int) -> DataFrame:
    """query, rank, doc_id, score of the items with `terms` (query, a, b, qtf)."""
    spark = docs.sparkSession
    known = terms.toArrow()
    a, b = (known.column(c).to_numpy().view(T.U) for c in ("a", "b"))
    order = np.lexsort((b, a))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    words = Dictionary(a[order][new], b[order][new])
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(new) - 1

    shared = spark.sparkContext.broadcast(words)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_postings(shared), _POSTED)
    rows = materialize(rows, "postings")
    shared.destroy()
    posted, counts = rows.where("n is not null").select("doc_id", "n", "terms", "tfs"), rows.where("term is not null")
    n, length = posted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = counts.groupBy("term").agg(F.sum("df").alias("df"))
    ratio = F.lit(2.0 * n + 2) / (F.lit(2.0) * F.col("df") + 1)
    found = found.select("term", F.floor(F.lit(1000.0) * F.log(ratio)).alias("w")).toArrow()
    weight = np.zeros(len(words.a), dtype=np.int64)
    weight[found.column("term").to_numpy()] = found.column("w").to_numpy()

    query = known.column("query").to_numpy()
    order = np.lexsort((number, query))
    names, begin = np.unique(query[order], return_index=True)
    owned = Queries(names, np.append(begin, len(order)), number[order], (weight[number] * known.column("qtf").to_numpy())[order], n, int(length))
    shared = spark.sparkContext.broadcast(owned)
    best = posted.mapInArrow(_search(shared, top), "query long, doc_id long, score long")
    best = materialize(best, "best")
    shared.destroy()
    first = _best(best.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(FAN))), ["query", "part"], top)
    return _best(first.select("query", "doc_id", "score"), ["query"], top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` best documents of each item."""
    asked = materialize(items.select(F.col("item_id").cast("long").alias("item_id"), "text").withColumn("query", F.monotonically_increasing_id()), "items")
    terms = asked.mapInArrow(item_terms, "query long, a long, b long")
    terms = materialize(terms.groupBy("query", "a", "b").agg(F.count("*").alias("qtf")), "terms")
    blocks = max(1, -(-terms.count() // BLOCK_TERMS))
    out = None
    for i in range(blocks):
        mine = terms.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == i)
        found = _block(docs, mine, top)
        out = found if out is None else out.unionByName(found)
    return out.join(asked.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")


def op12_ranked_search(spark, sf_dir: str) -> DataFrame:
    return search(T.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
ORACLE = f"""
with d as (select row_number() over () as rid, doc_id, {_TERMS} as ws from documents),
z as (select rid, doc_id, ws, len(ws) as n from d where len(ws) > 0),
g as (select count(*) as docs, sum(n)::bigint as length from z),
q as (select row_number() over () as qid, item_id, {_TERMS} as ws from benchmark),
t as (select qid, term, count(*) as qtf from (select qid, unnest(ws) as term from q) group by all),
p as (select rid, term, count(*) as tf from (select rid, unnest(ws) as term from z) where term in (select term from t) group by all),
w as (select term, floor(1000 * ln((2 * docs::double + 2) / (2 * df::double + 1)))::bigint as w from (select term, count(*) as df from p group by 1), g),
i as (select rid, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length)) as impact from p join z using (rid), g),
s as (select qid, rid, sum(qtf * w * impact)::bigint as score from t join w using (term) join i using (term) group by all),
r as (select qid, rid, doc_id, score, row_number() over (partition by qid order by score desc, doc_id nulls last) as rank from s join z using (rid) where score > 0)
select item_id, rank::int as rank, doc_id, score from r join q using (qid) where rank <= {TOP}
"""
