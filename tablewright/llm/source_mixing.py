"""Mixing sources to target weights by hierarchical budgeting, in built-in expressions only.

The corpus is a tree: domain, language, source; a leaf holds the documents of one source in
one language. A token budget is handed down level by level. Among siblings each gets its
weight's share, but no more than its subtree can give (`epochs` times its tokens); what a
full sibling cannot take goes to the others in proportion to their weights. So a shortage is
made up by siblings first, and reaches the ancestors' siblings only when the whole subtree
is full. All budgets are whole tokens (rounded down).

A leaf with budget b and t tokens gives b div t whole epochs and, of the next epoch, the
longest prefix of its seeded order that does not exceed the rest. The order of an epoch is
by md5 of (seed, epoch, doc_id). Prefix sums are taken in two steps, per md5 bucket of a
leaf and then inside the one bucket where the prefix ends, so no task holds a leaf.

Null text has no tokens; a null source, language or domain is a branch of its own, named ''.
Documents of leaves without tokens are never chosen. Rows with one doc_id have one place in
the order and go in or out together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import text as T

LEVELS = ["domain", "lang", "source"]
SEED = 17
SHARE = 60
EPOCHS = 2
#: Weights among siblings; what is not named has weight 1.
LANG_WEIGHTS = {"en": 4, "de": 2}
#: Hex digits of md5 that name a bucket of a leaf.
DIGITS = 3


def _weight(column: str, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for name, weight in sorted(weights.items()):
        out = F.when(F.col(column) == name, F.lit(weight)).otherwise(out)
    return out.cast("bigint")


def handed_down(parents: list[str], children: DataFrame) -> DataFrame:
    """Budgets of children (columns: parents, budget of the parent as `given`, name, weight, capacity).

    With siblings ordered by capacity / weight, a sibling is full if an even share of what the
    earlier, full ones left over reaches its capacity.
    """
    by = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = by.orderBy(F.col("capacity") / F.col("weight"), "name")
    rows = children.withColumn("taken", F.sum("capacity").over(order) - F.col("capacity")).withColumn("open", F.sum("weight").over(by) - F.sum("weight").over(order) + F.col("weight"))
    rows = rows.withColumn("full", (F.col("given") - F.col("taken")) * F.col("weight") >= F.col("capacity") * F.col("open"))
    none = F.lit(0).cast("bigint")
    rows = rows.withColumn("left", F.col("given") - F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(by), none)).withColumn("rest", F.sum(F.when(~F.col("full"), F.col("weight"))).over(by))
    return rows.withColumn("budget", F.when(F.col("full"), F.col("capacity")).otherwise(F.expr("(left * weight) div rest"))).drop("taken", "open", "full", "left", "rest")


def budgets(leaves: DataFrame, share: int, epochs: int, weights: dict[str, dict[str, int]]) -> DataFrame:
    """leaves (LEVELS, tokens) with `budget`; share is the percentage of all tokens to hand out."""
    leaves = leaves.withColumn("capacity", F.col("tokens") * epochs)
    above = None
    for k, level in enumerate(LEVELS):
        path = LEVELS[: k + 1]
        children = leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity"))
        children = children.withColumns({"name": F.col(level), "weight": _weight(level, weights.get(level, {}))})
        if above is None:
            children = children.withColumn("given", F.expr(f"sum(capacity) over (partition by 0) div {epochs} * {share} div 100"))
        else:
            children = children.join(above, path[:-1])
        above = handed_down(path[:-1], children).select(*path, F.col("budget").alias("given"))
    return leaves.join(above.withColumnRenamed("given", "budget"), LEVELS).drop("capacity")


def counted(docs: DataFrame, domain: Column) -> DataFrame:
    """doc_id, handle, LEVELS and n_tokens of each row."""
    empty = F.lit("")
    return T.handled(docs, F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(domain, empty).alias("domain"), F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source"), F.coalesce(F.regexp_count("text", F.lit(T.WORD)), F.lit(0)).cast("bigint").alias("n_tokens"))


def mix(docs: DataFrame, domain: Column, share: int = SHARE, epochs: int = EPOCHS, weights: dict | None = None, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, handle, LEVELS, n_tokens, leaf_tokens, leaf_budget, copies (times chosen)."""
    rows = materialize(counted(docs, domain), "mixing")  # the words are counted once
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    plan = budgets(leaves, share, epochs, {"lang": LANG_WEIGHTS} if weights is None else weights)
    plan = plan.withColumn("whole", F.expr("case when tokens > 0 then budget div tokens else 0 end")).withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("whole").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    rows = rows.join(plan, LEVELS).withColumn("key", key).withColumn("bucket", F.substring("key", 1, DIGITS))
    sums = rows.groupBy(*LEVELS, "bucket").agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("leaf_rest"))
    sums = sums.withColumn("through", F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("bucket"))).withColumn("before", F.col("through") - F.col("n"))
    # The bucket in which a leaf's prefix ends; earlier ones are in, later ones out.
    ends = sums.where("leaf_rest > 0 and before <= leaf_rest and through > leaf_rest").groupBy(*LEVELS).agg(F.min(F.struct("bucket", "before")).alias("end"))
    inside = rows.join(ends, LEVELS).where("bucket = end.bucket")
    inside = inside.withColumn("reached", F.col("end.before") + F.sum("n_tokens").over(Window.partitionBy(*LEVELS).orderBy("key")))
    last = inside.where("reached <= rest").groupBy(*LEVELS).agg(F.max("key").alias("last"))
    cut = ends.join(last, LEVELS, "left").select(*LEVELS, F.col("end.bucket").alias("end"), "last")
    rows = rows.join(cut, LEVELS, "left")
    extra = (F.col("rest") > 0) & F.coalesce((F.col("bucket") < F.col("end")) | ((F.col("bucket") == F.col("end")) & F.coalesce(F.col("key") <= F.col("last"), F.lit(False))), F.lit(True))
    return rows.select("doc_id", "_id", "_key", *LEVELS, "n_tokens", F.col("tokens").alias("leaf_tokens"), F.col("budget").alias("leaf_budget"), (F.col("whole") + extra.cast("bigint")).alias("copies"))


def mixed_documents(docs: DataFrame, domain: Column, **how) -> DataFrame:
    """The rows of docs that are chosen, each as often as it is chosen; all columns of docs stay."""
    chosen = mix(docs, domain, **how).where("copies > 0").groupBy("_id", "_key").agg(F.max("copies").alias("_copies"))
    keyed = T.handled(docs, T.boxed(docs)).join(chosen, ["_id", "_key"])
    return keyed.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies")))).select("row.*")


def op8_source_mixing(spark, sf_dir: str) -> DataFrame:
    """The domain is the first four letters of the source."""
    return mix(T.documents(spark, sf_dir), F.substring("source", 1, 4)).drop("_id", "_key")


def _handed_sql(k: int) -> str:
    path, parents = LEVELS[: k + 1], LEVELS[:k]
    weight = "case lang " + " ".join(f"when '{n}' then {w}" for n, w in LANG_WEIGHTS.items()) + " else 1 end" if LEVELS[k] == "lang" else "1"
    by = f"partition by {', '.join(parents)}" if parents else ""
    given = "(select cast(sum(tokens) as bigint) * %d // 100 from leaves)" % SHARE if not k else "p.budget"
    join = f"join b{k - 1} p using ({', '.join(parents)})" if k else ""
    return f"""
c{k} as (select {', '.join(path)}, capacity, {given} as given, cast({weight} as bigint) as weight
  from (select {', '.join(path)}, cast(sum(tokens) * {EPOCHS} as bigint) as capacity from leaves group by all) c {join}),
f{k} as (select *, (given - (cast(sum(capacity) over o as bigint) - capacity)) * weight >= capacity * (cast(sum(weight) over ({by}) as bigint) - cast(sum(weight) over o as bigint) + weight) as is_full
  from c{k} window o as ({by} order by capacity / weight, {LEVELS[k]})),
b{k} as (select {', '.join(path)}, case when is_full then capacity else
  ((given - cast(coalesce(sum(capacity) filter (is_full) over ({by}), 0) as bigint)) * weight) // cast(sum(weight) filter (not is_full) over ({by}) as bigint) end as budget from f{k})"""


ORACLE = f"""
with d as (select doc_id, coalesce(substr(source, 1, 4), '') as domain, coalesce(lang, '') as lang, coalesce(source, '') as source,
  cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as n_tokens from documents),
leaves as (select domain, lang, source, cast(sum(n_tokens) as bigint) as tokens from d group by all),
{','.join(_handed_sql(k) for k in range(3))},
plan as (select *, case when tokens > 0 then budget // tokens else 0 end as whole from leaves join b2 using (domain, lang, source)),
r as (select d.*, tokens, budget, whole, budget - whole * tokens as rest, md5('{SEED}|' || whole || '|' || doc_id) as key from d join plan using (domain, lang, source)),
s as (select *, cast(sum(n_tokens) over (partition by domain, lang, source order by key) as bigint) as reached from r)
select doc_id, domain, lang, source, n_tokens, tokens as leaf_tokens, budget as leaf_budget,
  whole + cast(rest > 0 and reached <= rest as bigint) as copies from s
"""
