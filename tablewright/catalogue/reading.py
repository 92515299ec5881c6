"""Scans, predicates, joins, groups, order, sets, recursion."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.catalogue.registry import Tables, query
from tablewright.functions.aggregates import weighted_mean
from tablewright.operators import policies, recursion, relational, replicas, scale, statistics

# -- scans and predicates


@query("select o_orderkey as order_id, o_custkey as customer_id, o_totalprice * 2 as doubled from orders")
def project_rename(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), (F.col("o_totalprice") * 2).alias("doubled"))


@query("select * from nation union all select n_nationkey + 100, n_name, n_regionkey from nation")
def rows_by_union(t: Tables) -> DataFrame:
    return relational.union_all(t.nation, t.nation.withColumn("n_nationkey", F.col("n_nationkey") + 100))


@query("select o_orderkey, o_totalprice from orders where o_totalprice >= 100000 and o_totalprice < 200000 and mod(o_orderkey, 2) = 0")
def filter_project(t: Tables) -> DataFrame:
    return t.orders.where(relational.half_open(F.col("o_totalprice"), 100000, 200000) & (F.col("o_orderkey") % 2 == 0)).select("o_orderkey", "o_totalprice")


@query("select o_orderkey from orders where o_totalprice <> 1013.7 and o_custkey <= 500 and o_orderkey > 10")
def compare(t: Tables) -> DataFrame:
    return t.orders.where((F.col("o_totalprice") != 1013.7) & (F.col("o_custkey") <= 500) & (F.col("o_orderkey") > 10)).select("o_orderkey")


@query("select l_orderkey, l_linenumber, l_quantity from lineitem where l_quantity between 10 and 20")
def between_range(t: Tables) -> DataFrame:
    return t.lineitem.where(F.col("l_quantity").between(10, 20)).select("l_orderkey", "l_linenumber", "l_quantity")


@query("select o_orderkey, o_orderpriority from orders where o_orderpriority in ('1-URGENT', '5-LOW')")
def in_list(t: Tables) -> DataFrame:
    return t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW")).select("o_orderkey", "o_orderpriority")


@query("select c_custkey, c_name from customer where c_name like '%1_' and c_name not like '%11_'")
def like_match(t: Tables) -> DataFrame:
    return t.customer.where(F.col("c_name").like("%1_") & ~F.col("c_name").like("%11_")).select("c_custkey", "c_name")


@query("select o_orderkey, nullif(o_orderstatus, 'P') is null as is_open from orders where nullif(o_orderstatus, 'F') is not null")
def null_tests(t: Tables) -> DataFrame:
    return t.orders.where(F.nullif(F.col("o_orderstatus"), F.lit("F")).isNotNull()).select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).isNull().alias("is_open"))


@query("select p_partkey from part where (p_size > 20 or p_type = 'ECONOMY') and not p_name like 'red%'")
def and_or_not(t: Tables) -> DataFrame:
    return t.part.where(((F.col("p_size") > 20) | (F.col("p_type") == "ECONOMY")) & ~F.col("p_name").like("red%")).select("p_partkey")


@query("select c_custkey, lower(c_mktsegment) as segment from customer where lower(c_mktsegment) = 'building'")
def function_predicate(t: Tables) -> DataFrame:
    return t.customer.where(F.lower("c_mktsegment") == "building").select("c_custkey", F.lower("c_mktsegment").alias("segment"))


@query("select o_orderkey from orders where mod(o_orderkey, 20) = 13")
def modulus_predicate(t: Tables) -> DataFrame:
    return t.orders.where(F.col("o_orderkey") % 20 == 13).select("o_orderkey")


@query("select case when l_quantity < 10 then 'low' when l_quantity < 25 then 'middle' else 'high' end as band, count(*) as n from lineitem group by 1")
def case_bands(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(relational.bands(F.col("l_quantity"), [10, 25], ["low", "middle", "high"]).alias("band")).agg(F.count("*").alias("n"))


@query("select n_nationkey, cast(null as varchar) as remark, cast(null as bigint) as amount from nation")
def typed_null(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey", relational.typed_null("string").alias("remark"), relational.typed_null("bigint").alias("amount"))


def _segment_policy() -> list[policies.Policy]:
    return [policies.Policy("own segment", ("public",), lambda role: F.lower("c_mktsegment") == role), policies.Policy("auditors", ("audit",), lambda role: F.col("c_acctbal") < 0)]


@query("select * from customer where lower(c_mktsegment) = 'building'")
def rls_policy(t: Tables) -> DataFrame:
    return policies.secured(t.customer, "building", _segment_policy())


@query("select * from customer where lower(c_mktsegment) = 'ann' or c_acctbal < 0")
def rls_group(t: Tables) -> DataFrame:
    return policies.secured(t.customer, "ann", _segment_policy(), members={"audit": ["ann"]})


@query("select * from customer")
def rls_bypass(t: Tables) -> DataFrame:
    return policies.secured(t.customer, "root", _segment_policy(), bypass=["root"])


# -- joins


@query("""select c_mktsegment, count(*) as n, cast(sum(cast(o_totalprice as decimal(12,2))) as double) as total
from customer join orders on c_custkey = o_custkey where c_custkey % 2 = 0 group by c_mktsegment having count(*) > 10""")
def join_view_even(t: Tables) -> DataFrame:
    """The flagship: a view over two tables, grouped and filtered."""
    view = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey")).where("c_custkey % 2 = 0")
    total = F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("double")
    return view.groupBy("c_mktsegment").agg(F.count("*").alias("n"), total.alias("total")).where("n > 10")


@query("select n_name, r_name from nation join region on n_regionkey = r_regionkey where n_nationkey > 5")
def inner_join(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).where("n_nationkey > 5").select("n_name", "r_name")


@query("select c_custkey, o_orderkey from customer left join orders on c_custkey = o_custkey and o_totalprice > 400000")
def join_extra_term(t: Tables) -> DataFrame:
    on = (F.col("c_custkey") == F.col("o_custkey")) & (F.col("o_totalprice") > 400000)
    return t.customer.join(t.orders, on, "left").select("c_custkey", "o_orderkey")


@query("select * from customer c where exists (select 1 from orders o where o.o_custkey = c.c_custkey and o.o_orderstatus = 'F')")
def semi_exists(t: Tables) -> DataFrame:
    return relational.exists(t.customer, t.orders.where("o_orderstatus = 'F'").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")


@query("select o_orderkey, o_custkey from orders where o_custkey in (select c_custkey from customer where c_acctbal < 0)")
def semi_any(t: Tables) -> DataFrame:
    return relational.any_of(t.orders, "o_custkey", t.customer.where("c_acctbal < 0"), "c_custkey").select("o_orderkey", "o_custkey")


@query("select c_custkey from customer c where not exists (select 1 from orders o where o.o_custkey = c.c_custkey)")
def anti_missing(t: Tables) -> DataFrame:
    return relational.missing(t.customer, t.orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey").select("c_custkey")


# -- groups


@query("select o_orderpriority, count(o_orderstatus) as cnt from orders group by 1")
def group_count(t: Tables) -> DataFrame:
    return relational.group_count(t.orders, "o_orderpriority", "o_orderstatus")


@query("select o_custkey, count(o_orderkey) as cnt from orders group by 1 having count(o_orderkey) > 10")
def group_having(t: Tables) -> DataFrame:
    return relational.group_count(t.orders, "o_custkey", "o_orderkey", more_than=10)


@query("select count(*) as n from lineitem")
def global_count(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count("*").alias("n"))


@query("select min(o_totalprice) as least, max(o_totalprice) as greatest from orders")
def min_max(t: Tables) -> DataFrame:
    return relational.least_and_greatest(t.orders, "o_totalprice")


@query("select distinct l_returnflag, l_linestatus from lineitem")
def distinct_rows(t: Tables) -> DataFrame:
    return t.lineitem.select("l_returnflag", "l_linestatus").distinct()


@query("select n_regionkey, string_agg(n_name, ',' order by n_name) as names from nation group by 1")
def collect_array(t: Tables) -> DataFrame:
    return t.nation.groupBy("n_regionkey").agg(F.array_join(F.sort_array(F.collect_list("n_name")), ",").alias("names"))


@query("select l_returnflag, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) as mean from lineitem group by 1")
def uda_merge(t: Tables) -> DataFrame:
    means = weighted_mean().over(t.lineitem, "l_returnflag", ["l_discount", "l_quantity"])
    return means.select("l_returnflag", F.round("mean", 6).alias("mean"))


@query("""select 'flag' as columns, count(distinct l_returnflag) as n from lineitem union all
select 'flag, status', count(*) from (select distinct l_returnflag, l_linestatus from lineitem) union all
select 'part, supplier', count(*) from (select distinct l_partkey, l_suppkey from lineitem)""")
def ndistinct(t: Tables) -> DataFrame:
    return statistics.ndistinct(t.lineitem, {"flag": ["l_returnflag"], "flag, status": ["l_returnflag", "l_linestatus"], "part, supplier": ["l_partkey", "l_suppkey"]})


@query("select l_suppkey, count(*) as n, round(count(*) / (select count(*) from lineitem), 6) as share from lineitem group by 1 order by n desc, l_suppkey limit 20")
def mcv(t: Tables) -> DataFrame:
    return statistics.most_common(t.lineitem, "l_suppkey", 20)


@query("""select round(sum(case when r = 1 then n else 0 end) / sum(n), 6) as degree from
(select l_orderkey, sum(n) as n, count(*) as r from (select l_orderkey, l_returnflag, count(*) as n from lineitem group by 1, 2) group by 1)""")
def dependency_degree(t: Tables) -> DataFrame:
    return statistics.dependency(t.lineitem, "l_orderkey", "l_returnflag")


@query("""select 'o_custkey' as "column", count(*) as rows, count(*) - count(o_custkey) as nulls, cast(min(o_custkey) as varchar) as least, cast(max(o_custkey) as varchar) as greatest, count(distinct o_custkey) as distinct_values from orders
union all select 'o_orderstatus', count(*), count(*) - count(o_orderstatus), min(o_orderstatus), max(o_orderstatus), count(distinct o_orderstatus) from orders""")
def profile(t: Tables) -> DataFrame:
    return statistics.profile(t.orders, ["o_custkey", "o_orderstatus"])


@query("""select user_id, sum(v) as total from (select user_id, event_id % 3 as replica, max(event_id % 17) as v from events group by 1, 2) group by 1""")
def g_counter(t: Tables) -> DataFrame:
    states = t.events.select("user_id", (F.col("event_id") % 3).alias("replica"), (F.col("event_id") % 17).alias("v"))
    return replicas.g_counter(states, "user_id", "replica", "v")


@query("""select user_id, sum(p) - sum(m) as total from
(select user_id, event_id % 3 as replica, max(event_id % 17) as p, max(event_id % 5) as m from events group by 1, 2) group by 1""")
def pn_counter(t: Tables) -> DataFrame:
    states = t.events.select("user_id", (F.col("event_id") % 3).alias("replica"), (F.col("event_id") % 17).alias("p"), (F.col("event_id") % 5).alias("m"))
    return replicas.pn_counter(states, "user_id", "replica", "p", "m")


@query("select distinct user_id, event_type from events")
def g_set(t: Tables) -> DataFrame:
    return replicas.g_set(t.events, "user_id", "event_type")


@query("select user_id, event_type, max(value) as value from events group by 1, 2")
def g_map(t: Tables) -> DataFrame:
    return replicas.g_map(t.events, "user_id", "event_type", "value")


@query("""select user_id, value, written, replica from (select user_id, value, hour(ts) as written, event_id % 3 as replica, event_type = 'error' as gone,
row_number() over (partition by user_id order by hour(ts) desc, event_id % 3 desc, value desc, (event_type = 'error') desc) as k from events) where k = 1 and not gone""")
def lww_map(t: Tables) -> DataFrame:
    states = t.events.select("user_id", "value", F.hour("ts").cast("bigint").alias("written"), (F.col("event_id") % 3).alias("replica"), (F.col("event_type") == "error").alias("gone"))
    return replicas.lww_map(states, "user_id", "value", "written", "replica", "gone")


@query("""select strftime(date_trunc('hour', ts), '%Y-%m-%d %H') as hour, count(*) as requests, round(avg(value), 6) as latency, round(count(*) / 3600 * avg(value), 6) as in_flight from events group by 1""")
def littles_law(t: Tables) -> DataFrame:
    rows = statistics.concurrency(t.events, "ts", "value")
    return rows.select(F.date_format("bucket", "yyyy-MM-dd HH").alias("hour"), "requests", F.round("latency", 6).alias("latency"), F.round(F.col("requests") / 3600 * F.col("latency"), 6).alias("in_flight"))


# -- order and pages


@query("select c_custkey, c_name, row_number() over (order by c_mktsegment, c_custkey) as rn from customer")
def order_by_column(t: Tables) -> DataFrame:
    return scale.number_rows(t.customer.select("c_custkey", "c_name", "c_mktsegment"), ["c_mktsegment", "c_custkey"]).drop("c_mktsegment")


@query("select o_orderkey, o_custkey from orders order by mod(o_orderkey, 20), o_orderkey desc limit 500")
def order_by_expression(t: Tables) -> DataFrame:
    return relational.ordered(t.orders, F.col("o_orderkey") % 20, "-o_orderkey").select("o_orderkey", "o_custkey").limit(500)


@query("""select o_orderkey, x, row_number() over (order by x desc nulls first, o_orderkey) as falling from
(select o_orderkey, nullif(o_custkey % 7, 3) as x from orders)""")
def null_placement(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.nullif(F.col("o_custkey") % 7, F.lit(3)).alias("x"))
    return scale.number_rows(rows, ["-x", "o_orderkey"], "falling")


@query("select c_custkey, c_acctbal from customer order by c_acctbal nulls last, c_custkey limit 25 offset 50")
def offset_limit(t: Tables) -> DataFrame:
    return relational.page(t.customer, ["c_acctbal", "c_custkey"], 50, 25).select("c_custkey", "c_acctbal")


@query("select o_orderkey, (row_number() over (order by o_orderkey) - 1) // 1000 + 1 as batch from orders where o_orderstatus = 'F'")
def key_batches(t: Tables) -> DataFrame:
    return relational.batches(t.orders.where("o_orderstatus = 'F'").select("o_orderkey"), ["o_orderkey"], 1000)


# -- sets and recursion


@query("select n_regionkey as k from nation union select r_regionkey from region")
def distinct_union(t: Tables) -> DataFrame:
    return relational.union_distinct(t.nation.select(F.col("n_regionkey").alias("k")), t.region.select("r_regionkey"))


@query("select n_regionkey as k from nation union all select r_regionkey from region")
def union_all(t: Tables) -> DataFrame:
    return relational.union_all(t.nation.select(F.col("n_regionkey").alias("k")), t.region.select("r_regionkey"))


@query("with big as (select * from orders where o_totalprice > 300000) select o_orderstatus, count(*) as n from big group by 1")
def plain_cte(t: Tables) -> DataFrame:
    big = t.orders.where("o_totalprice > 300000")
    return big.groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("""with recursive tree as (select p_partkey, cast(p_partkey as varchar) as path, 1 as depth, p_partkey as root, cast(null as bigint) as parent from part where p_partkey = 0
union all select p.p_partkey, p.p_partkey || '->' || tree.path, depth + 1, root, tree.p_partkey from part p join tree on p.p_partkey // 4 = tree.p_partkey and p.p_partkey > 0) select * from tree""")
def recursive_tree(t: Tables) -> DataFrame:
    parts = t.part.select("p_partkey", F.expr("case when p_partkey > 0 then p_partkey div 4 end").alias("parent"))
    return recursion.hierarchy(parts, "p_partkey", "parent").select("p_partkey", "path", "depth", "root", "parent")


@query("""with o as (select o_orderkey as k, row_number() over (partition by o_orderkey // 10000 order by o_orderkey) as depth from orders)
select k, depth, k - k % 10000 as root, case when depth > 1 then k - 1 end as parent from o where depth = k % 10000 + 1""")
def deep_chain(t: Tables) -> DataFrame:
    """Chains of 10,000 orders, each below the one before it: a deep hierarchy, in 14 rounds."""
    orders = t.orders.select(F.col("o_orderkey").alias("k"), F.expr("case when o_orderkey % 10000 > 0 then o_orderkey - 1 end").alias("parent"))
    return recursion.hierarchy(orders, "k", "parent", path=None)


@query("""with recursive e as (select distinct p_partkey % 100 as src, (p_partkey * 7 + 1) % 100 as dst from part),
r as (select cast(3 as bigint) as node union select dst from r join e on src = node) select node from r""")
def recursive_graph(t: Tables) -> DataFrame:
    edges = t.part.select((F.col("p_partkey") % 100).alias("src"), ((F.col("p_partkey") * 7 + 1) % 100).alias("dst"))
    return recursion.reachable(edges, t.part.where("p_partkey = 3").select(F.col("p_partkey").alias("node")))


@query("""with recursive p as (select p_partkey as k, p_partkey // 4 as up from part where p_partkey > 0)
select a.k, b.k as sibling from p a join p b on a.up = b.up and a.k < b.k""")
def self_join(t: Tables) -> DataFrame:
    p = t.part.where("p_partkey > 0").select(F.col("p_partkey").alias("k"), F.expr("p_partkey div 4").alias("up"))
    return p.join(p.select(F.col("k").alias("sibling"), "up"), "up").where("k < sibling").select("k", "sibling")


@query("""select event_id, user_id, lag(value) over (partition by user_id order by event_id) as before from events""")
def previous_row(t: Tables) -> DataFrame:
    return scale.previous_value(t.events.select("event_id", "user_id", "value"), "user_id", "event_id", F.col("value"), "before").drop("value")


@query("select user_id, value from (select user_id, value, row_number() over (partition by user_id order by event_id) as k from events) where k = 1")
def first_row(t: Tables) -> DataFrame:
    k = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    return t.events.select("user_id", "value", k.alias("k")).where("k = 1").drop("k")
