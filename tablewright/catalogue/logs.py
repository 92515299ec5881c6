"""Change logs: publications, apply, conflicts, recovery, streams. The log is made of the events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.catalogue.registry import Tables, query
from tablewright.operators import derived, state
from tablewright.session import scratch_path
from tablewright.sources import versions
from tablewright.streaming import changes as logs
from tablewright.streaming.jobs import Subscriber

OPS = "case event_type when 'signup' then 'I' when 'error' then 'D' else 'U' end"


def _log(t: Tables) -> DataFrame:
    """Each event changes the row of its user."""
    image = F.struct(F.col("user_id").alias("k"), "value")
    rows = t.events.select(F.col("event_id").alias("lsn"), F.col("ts").alias("commit_ts"), (F.col("event_id") / 10).cast("bigint").alias("tx"), F.expr(OPS).alias("op"), image.alias("i"))
    return rows.select("lsn", "commit_ts", "tx", "op", F.when(F.col("op") != "I", F.col("i")).alias("old"), F.when(F.col("op") != "D", F.col("i")).alias("new"))


def _base(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("value"))


def _applied_sql(where: str = "true") -> str:
    return f"""with ev as (select user_id as k, event_id, value, {OPS} as op from events where {where}),
net as (select k, arg_max(value, event_id) as value, arg_max(op, event_id) filter (op in ('I', 'D')) as made from ev group by k),
base as (select c_custkey as k, c_acctbal as value from customer)
select k, value from base where k not in (select k from net) union all select k, value from net where made = 'I'
union all select k, net.value from net join base using (k) where made is null"""


def _versions(t: Tables) -> DataFrame:
    """Old and new row of each user's event, the first being an insert."""
    image = F.struct("user_id", "value", "event_type")
    before = F.lag(image).over(Window.partitionBy("user_id").orderBy("event_id"))
    rows = t.events.select(F.col("event_id").alias("lsn"), F.lit("events").alias("table"), before.alias("old"), image.alias("new"))
    return rows.withColumn("op", F.when(F.col("old").isNull(), "I").otherwise("U"))


_VERSIONS = """with v as (select event_id as lsn, user_id, value, event_type, lag(value) over w as old_value, lag(event_type) over w as old_type from events window w as (partition by user_id order by event_id))"""


@query(f"""{_VERSIONS} select lsn, case when old_value is null then 'I' when old_value > 50 and value > 50 then 'U' when old_value > 50 then 'D' else 'I' end as op from v where old_value > 50 or value > 50""")
def publication_row_filter(t: Tables) -> DataFrame:
    return logs.row_filter(_versions(t), lambda r: r["value"] > 50).select("lsn", "op")


@query(f"{_VERSIONS} select lsn, user_id, event_type, old_type from v")
def column_list(t: Tables) -> DataFrame:
    rows = logs.column_list(_versions(t), ["user_id", "event_type"])
    return rows.select("lsn", "new.user_id", "new.event_type", F.col("old.event_type").alias("old_type"))


def _either(r: Column) -> Column:
    return r["event_type"] == "error"


@query(f"""{_VERSIONS}, f as (select lsn, old_value is null as born, value > 50 or event_type = 'error' as now, coalesce(old_value > 50 or old_type = 'error', false) as was from v)
select lsn, case when born then 'I' when was and now then 'U' when was then 'D' else 'I' end as op from f where (born and now) or (not born and (was or now))""")
def filters_or(t: Tables) -> DataFrame:
    """A row passes if either publication's filter accepts it."""
    both = [logs.Publication("a", {"events": lambda r: r["value"] > 50}), logs.Publication("b", {"events": _either})]
    return logs.publish(_versions(t), both, "events").select("lsn", "op")


@query(f"{_VERSIONS} select lsn, 'I' as op, user_id, cast(null as double) as value from v where old_value is null and value > 50")
def publication_operations(t: Tables) -> DataFrame:
    """Inserts only, filtered, with a list of columns."""
    one = logs.Publication("a", {"events": lambda r: r["value"] > 50}, ops=("I",))
    rows = logs.publish(_versions(t), [one], "events")
    return logs.column_list(rows, ["user_id"]).select("lsn", "op", "new.user_id", F.lit(None).cast("double").alias("value"))


@query(_applied_sql())
def cdc_apply(t: Tables) -> DataFrame:
    return logs.apply_changes(_base(t), _log(t), "k", truncates=False)


@query(_applied_sql("event_id >= 500").replace("from customer", "from customer where false"))
def cdc_truncate(t: Tables) -> DataFrame:
    """A truncate in the log empties the table; what follows it counts."""
    log = _log(t)
    cut = log.where("lsn = 500").select(F.lit(499).cast("bigint").alias("lsn"), "commit_ts", "tx", F.lit("T").alias("op"), F.when(F.lit(False), F.col("old")).alias("old"), F.when(F.lit(False), F.col("new")).alias("new"))
    return logs.apply_changes(_base(t), log.where("lsn <> 499").unionByName(cut), "k")


@query("""select case when c_custkey % 7 = 0 then c_custkey + 1000000000000 else c_custkey end as k, case when c_custkey % 7 = 0 then -1.0 else c_acctbal end as value from customer where c_custkey % 21 <> 0""")
def cdc_key_change(t: Tables) -> DataFrame:
    """Every seventh row moves, to a key above all others; moves of rows that the target has lost are skipped."""
    base = state.delete(_base(t), F.col("k") % 21 == 0).state
    return logs.apply_changes(base, _moves(t.customer.where("c_custkey % 7 = 0"), 1000000000000), "k", truncates=False)


def _moves(keys: DataFrame, by: int) -> DataFrame:
    old = F.struct(F.col("c_custkey").alias("k"), F.lit(0.0).alias("value"))
    new = F.struct((F.col("c_custkey") + by).alias("k"), F.lit(-1.0).alias("value"))
    return keys.select(F.col("c_custkey").alias("lsn"), F.lit("U").alias("op"), old.alias("old"), new.alias("new"))


@query(_applied_sql())
def cdc_apply_stream(t: Tables) -> DataFrame:
    """The same log as a stream of files, applied batch by batch."""
    base, folder = _base(t), scratch_path(t.spark, "stream")
    follower = Subscriber(t.spark, f"{folder}/to", "k", base.schema)
    follower.start_from(base)
    # Three pieces, in the order of the log, each of as many files as it has tasks; the stream takes one piece a batch.
    last = t.events.agg(F.max("event_id")).first()[0] or 0
    for piece in range(3):
        _log(t).where(F.expr(f"lsn * 3 div {last + 1} = {piece}")).write.mode("append").parquet(f"{folder}/log")
        files = len(t.spark.read.parquet(f"{folder}/log").inputFiles())  # as many as the piece has, or more
        follower.follow(f"{folder}/log", _log(t).schema, files)
    return follower.read()


_CLASSES = f"""with ev as (select user_id as k, event_id, {OPS} as op from events),
h as (select *, last_value(case when op in ('I', 'D') then op end ignore nulls) over (partition by k order by event_id rows between unbounded preceding and 1 preceding) as made from ev),
x as (select h.*, case when made is null then k in (select c_custkey from customer) else made = 'I' end as there from h),
c as (select event_id as lsn, case when op = 'I' and there then 'insert_exists' when op = 'U' and not there then 'update_missing' when op = 'D' and not there then 'delete_missing' end as conflict from x)"""


@query(f"{_CLASSES} select lsn, conflict from c")
def cdc_conflicts(t: Tables) -> DataFrame:
    return logs.conflicts(_base(t), _log(t), "k").select("lsn", "conflict")


@query(f"{_CLASSES} select 'sub' as subscription, conflict, count(*) as n from c where conflict is not null group by 2")
def conflict_counts(t: Tables) -> DataFrame:
    return logs.conflict_counts(logs.conflicts(_base(t), _log(t), "k"), "sub")


@query("""select case when a.s_suppkey is null then 'I' when b.s_suppkey is null then 'D' else 'U' end as op, coalesce(a.s_suppkey, b.s_suppkey) as k from supplier a
full join (select case when s_suppkey % 9 = 0 then s_suppkey + 70000 else s_suppkey end as s_suppkey, case when s_suppkey % 5 = 0 then s_acctbal + 1 else s_acctbal end as s_acctbal from supplier) b on a.s_suppkey = b.s_suppkey
where a.s_suppkey is null or b.s_suppkey is null or a.s_acctbal <> b.s_acctbal""")
def version_diff(t: Tables) -> DataFrame:
    after = t.supplier.withColumn("s_acctbal", F.when(F.col("s_suppkey") % 5 == 0, F.col("s_acctbal") + 1).otherwise(F.col("s_acctbal")))
    after = after.withColumn("s_suppkey", F.when(F.col("s_suppkey") % 9 == 0, F.col("s_suppkey") + 70000).otherwise(F.col("s_suppkey")))
    two = [versions.store(v, scratch_path(t.spark, "version"), "s_suppkey", 64) for v in (t.supplier, after)]
    return logs.diff_versions(*two).select("op", F.coalesce("old.s_suppkey", "new.s_suppkey").alias("k"))


@query("select c_custkey, c_name from customer where c_acctbal > 5000")
def initial_copy(t: Tables) -> DataFrame:
    return logs.initial_copy(t.customer, lambda r: r["c_acctbal"] > 5000, ["c_custkey", "c_name"])


@query("select event_id as lsn from events where event_id > 700")
def follow_after_copy(t: Tables) -> DataFrame:
    return logs.follow(_log(t), 700).select("lsn")


@query("select event_id as lsn, 'a' as origin from events where user_id % 2 = 0")
def cascade_and_loop_guard(t: Tables) -> DataFrame:
    """Local changes go on to the next server marked with where they came from; marked ones do not come back."""
    log = _log(t).withColumn("origin", F.when(F.col("new.k") % 2 == 1, "b").when(F.col("old.k") % 2 == 1, "b"))
    return logs.republish(logs.local_only(log), "a").select("lsn", "origin")


@query(_applied_sql("ts <= timestamp '2024-01-15 00:00:00'"))
def pitr_state(t: Tables) -> DataFrame:
    return logs.recover(_base(t), _log(t), "k", commit_ts="2024-01-15 00:00:00")


@query(_applied_sql("event_id // 10 <= 42"))
def pitr_transaction(t: Tables) -> DataFrame:
    return logs.recover(_base(t), _log(t), "k", tx=42)


@query(_applied_sql("ts <= timestamp '2024-01-20 00:00:00' - interval 36 hours"))
def delayed_state(t: Tables) -> DataFrame:
    late = logs.delayed(_log(t), F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"), "36 HOURS")
    return logs.apply_changes(_base(t), late, "k", truncates=False)


@query("select n_nationkey, n_name, 0 as n_regionkey from nation where n_nationkey < 10")
def drifted_columns(t: Tables) -> DataFrame:
    """A column that the log lacks takes its default in new rows."""
    new = F.struct("n_nationkey", "n_name")
    log = t.nation.where("n_nationkey < 10").select(F.col("n_nationkey").cast("bigint").alias("lsn"), F.lit("I").alias("op"), F.when(F.lit(False), new).alias("old"), new.alias("new"))
    logs.check_drift(log, t.nation.schema)
    return logs.apply_changes(state.truncate(t.nation).state, log, "n_nationkey", defaults={"n_regionkey": F.lit(0)}, truncates=False)


@query("select c_custkey as k, c_acctbal as value from customer")
def resync(t: Tables) -> DataFrame:
    """A subscriber out of step takes only the differences from its source."""
    source = _base(t)
    behind = state.delete(state.update(source, {"value": F.lit(0.0)}, F.col("k") % 3 == 0).state, F.col("k") % 5 == 0).state
    two = [versions.store(v, scratch_path(t.spark, "version"), "k") for v in (behind, source)]
    steps = logs.diff_versions(*two).withColumn("lsn", F.lit(0).cast("bigint"))
    return logs.apply_changes(behind, steps, "k", truncates=False)


@query("select s_suppkey, s_name, case when s_acctbal < 0 then 0 else s_acctbal end as s_acctbal from supplier where s_nationkey <> 3")
def offload_copy(t: Tables) -> DataFrame:
    """A rule copies each change of a table to a second one, which follows it."""
    rows = t.supplier.select("s_suppkey", "s_name", "s_acctbal", "s_nationkey")
    first = state.update(rows, {"s_acctbal": F.lit(0.0)}, F.col("s_acctbal") < 0)
    second = state.delete(first.state, F.col("s_nationkey") == 3)
    steps = first.changes.withColumn("lsn", F.lit(1).cast("bigint")).unionByName(second.changes.withColumn("lsn", F.lit(2).cast("bigint")))
    copied = derived.fire({"supplier": steps}, [derived.Rule("copy", "supplier", lambda changed: {"second": changed})])["second"][0]
    return logs.apply_changes(rows, copied, "s_suppkey", truncates=False).drop("s_nationkey")
