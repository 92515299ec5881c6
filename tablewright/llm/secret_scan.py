"""Secret scan with corpus-wide ownership frequency, in built-in expressions only.

Base kinds, leftmost and non-overlapping within a kind: assign (a keyword, a separator and a
value of 12 or more characters), access (AKIA and 18 or more characters in all), hex (16 or
more). The method adds the kinds of ADDED. A span is the whole match, in code points.

The value of each span (for assign the part after the separator) is hashed; the hashes are
counted by the distinct repositories and owners they occur in. A value of `example_owners`
or more owners is a widely copied example, any other a live-looking credential of its owner.
Repetitions of one value meet in partial counts first; the join back is an equi-join whose
hot keys Spark splits.

Positions come from splitting the text at the matches: a match starts after the lengths of
all parts and matches before it; the lengths are summed in chunks, so that long texts with
very many matches cost in proportion. Null text is empty; null repository or owner counts as one
of its own; rows repeated as a whole have the same counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import text as T

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Maximal runs: the least length in the pattern drops what the plain pattern would match too short.
BASE = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}
#: Public credential formats beyond the base.
ADDED = {
    "forge": r"gh[pousr]_[A-Za-z0-9]{36,}",
    "jwt": r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}",
    # Single blanks only, told by looking ahead: a repeated group would cost stack for each word.
    "pem": r"-----BEGIN (?! )(?![A-Z ]*  )(?:[A-Z ]* )?PRIVATE KEY-----",
    "chat": r"xox[abprs]-[A-Za-z0-9-]{10,}",
}
KINDS = [*BASE, *ADDED]
ASSIGN_LEAST = 12
#: Matches of a text whose positions are summed at once.
CHUNK = 256
EXAMPLE_OWNERS = 3
_SPAN = "array<struct<start:int,rank:int,end:int,value:string>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, also where `use` has it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _sums(sizes: Column, begin: Column) -> Column:
    """begin and the running sums after it."""
    return F.aggregate(sizes, F.array(begin), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n)))


def _ends(sizes: Column) -> Column:
    """Running sums of an array, taken in chunks so that a fold never copies more than a chunk or their sums."""

    def chunked(sizes: Column) -> Column:
        numbers = F.when(F.size(sizes) > 0, F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / CHUNK).cast("int"))).otherwise(F.expr("cast(array() as array<int>)"))
        chunks = F.transform(numbers, lambda c: F.slice(sizes, c * CHUNK + 1, F.lit(CHUNK)))
        return _let(chunks, whole)

    def whole(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda done, n: done + n))
        begins = F.slice(_sums(totals, F.lit(0)), 1, F.size(chunks))
        both = F.arrays_zip(chunks.alias("sizes"), begins.alias("begin"))
        return F.flatten(F.transform(both, lambda b: F.slice(_sums(b["sizes"], b["begin"]), 2, F.size(b["sizes"]))))

    return _let(sizes, chunked)


def _found(text: Column, kind: str) -> Column:
    """Array of (start, rank, end, value) of the matches of a kind, in order of start."""
    pattern = F.lit({**BASE, **ADDED}[kind])
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(2)) if kind == "assign" else hits
    parts = F.split(text, {**BASE, **ADDED}[kind], -1)
    rows = F.slice(F.arrays_zip(hits.alias("hit"), values.alias("value"), parts.alias("part")), 1, F.size(hits))
    rank = F.lit(KINDS.index(kind))

    def placed(rows: Column) -> Column:
        ends = _ends(F.transform(rows, lambda r: F.length(r["part"]) + F.length(r["hit"])))
        pairs = F.arrays_zip(rows.alias("row"), ends.alias("end"))
        return F.transform(pairs, lambda p: F.struct((p["end"] - F.length(p["row"]["hit"])).alias("start"), rank.alias("rank"), p["end"].alias("end"), p["row"]["value"].alias("value")))

    spans = _let(rows, placed).cast(_SPAN)
    if kind == "assign":
        spans = F.filter(spans, lambda s: F.length(s["value"]) >= ASSIGN_LEAST)
    return F.when(text.rlike({**BASE, **ADDED}[kind]), spans).otherwise(F.expr(f"cast(array() as {_SPAN})"))


def scan(docs: DataFrame, *columns: Column | str) -> DataFrame:
    """`columns`, one array column of spans per kind, and the handle of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # rlike first: most texts have no match of a kind, and need no array
    return T.handled(docs, *columns, *(_found(text, kind).alias(f"_{kind}") for kind in KINDS))


def _joined(*kinds: str) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    spans = F.array_sort(F.concat(*(F.transform(f"_{k}", lambda s: F.struct(s["start"], s["rank"], s["end"])) for k in kinds)))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_owners(docs: DataFrame, repository: Column, owner: Column, example_owners: int = EXAMPLE_OWNERS) -> tuple[DataFrame, DataFrame]:
    """Candidates (handle, kind, start, end, value_sha256) and, by value, n_found, n_repositories, n_owners, live."""
    spans = scan(docs, repository.alias("repository"), owner.alias("owner"))
    spans = spans.withColumn("span", F.explode(F.concat(*(F.col(f"_{k}") for k in KINDS))))
    found = spans.select("_id", "_key", "repository", "owner", F.get(F.array(*(F.lit(k) for k in KINDS)), F.col("span.rank")).alias("kind"), "span.start", "span.end", F.sha2(F.col("span.value"), 256).alias("value_sha256"))
    places = found.groupBy("value_sha256", "repository", "owner").agg(F.count("*").alias("n"))
    by_owner = places.groupBy("value_sha256", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("repositories"))
    values = by_owner.groupBy("value_sha256").agg(F.sum("n").alias("n_found"), F.sum("repositories").alias("n_repositories"), F.count("*").alias("n_owners"))
    return found.drop("repository", "owner"), values.withColumn("live", F.col("n_owners") < example_owners)


def scan_documents(docs: DataFrame, repository: Column, owner: Column) -> DataFrame:
    """One row per document: counts of base kinds, digest of base spans, all spans, live and example values."""
    found, values = secret_owners(docs, repository, owner)
    # Written before the join, whose hot values Spark then splits.
    judged = found.join(materialize(values.select("value_sha256", "live"), "values"), "value_sha256")
    judged = judged.groupBy("_id", "_key").agg(*(F.count_distinct(F.when(c, F.col("value_sha256"))).alias(n) for n, c in (("n_live", F.col("live")), ("n_example", ~F.col("live")))))
    rows = scan(docs, F.col("doc_id").cast("long").alias("doc_id")).select(
        "doc_id", "_id", "_key", *(F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in BASE), F.sha2(_joined(*BASE), 256).alias("base_sha256"), _joined(*KINDS).alias("spans")
    )
    return rows.join(judged, ["_id", "_key"], "left").na.fill(0, ["n_live", "n_example"]).drop("_id", "_key")


def op10_secret_scan(spark, sf_dir: str) -> DataFrame:
    """The owner is the source; a repository is what a source has in one language."""
    return scan_documents(T.documents(spark, sf_dir), F.concat_ws("/", "source", "lang"), F.col("source"))


def _matches_sql() -> str:
    """Rows (rid, rank, start, end, value) of all kinds, from the parts and hits of each text."""
    one = """select rid, {rank} as rank, unnest(range(1, len(hits) + 1)) as i, unnest(hits) as hit, unnest(vals) as value, unnest(parts[1:len(hits)]) as part
      from (select rid, regexp_extract_all(t, '{p}') as hits, regexp_extract_all(t, '{p}', {group}) as vals, string_split_regex(t, '{p}') as parts from d)"""
    kinds = {**BASE, **ADDED, "pem": r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"}
    return " union all ".join(one.format(rank=r, p=kinds[k].replace("'", "''"), group=2 if k == "assign" else 0) for r, k in enumerate(KINDS))


ORACLE = f"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t, source, concat_ws('/', source, lang) as repository from documents),
m as ({_matches_sql()}),
p as (select rid, rank, value, hit, cast(sum(length(part) + length(hit)) over (partition by rid, rank order by i) as bigint) as stop from m),
s as (select rid, rank, stop - length(hit) as start, stop, sha256(value) as v, {KINDS}[rank + 1] as kind from p where rank > 0 or length(value) >= {ASSIGN_LEAST}),
o as (select v, count(distinct coalesce(source, '?')) as owners from s join d using (rid) group by v),
g as (select rid, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
  string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank) filter (rank < {len(BASE)}) as base,
  string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank) as spans,
  count(distinct v) filter (owners < {EXAMPLE_OWNERS}) as n_live, count(distinct v) filter (owners >= {EXAMPLE_OWNERS}) as n_example from s join o using (v) group by rid)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256,
  coalesce(spans, '') as spans, coalesce(n_live, 0) as n_live, coalesce(n_example, 0) as n_example from d left join g using (rid)
"""
