"""Table state: inserts, updates, deletes, merges, archives, numbers, rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.catalogue.registry import Tables, query
from tablewright.operators import deltas, relational, rules, state
from tablewright.plans.tabledef import Check, ForeignKey, Serial, TableDef, Unique, table


def nation() -> TableDef:
    return table("nation", "n_nationkey int, n_name string, n_regionkey int", defaults={"n_regionkey": "4"}, uniques=(Unique(("n_nationkey",), primary=True),))


@query("select * from nation union all select n_nationkey + 100, 'new ' || n_name, 4 from nation where n_nationkey < 5")
def insert_defaults(t: Tables) -> DataFrame:
    rows = t.nation.where("n_nationkey < 5").select((F.col("n_nationkey") + 100).alias("n_nationkey"), F.concat(F.lit("new "), "n_name").alias("n_name"))
    return state.insert(t.nation, rows, nation()).state


@query("select * from nation union all select r_regionkey + 200, r_name, r_regionkey from region")
def insert_from_query(t: Tables) -> DataFrame:
    rows = t.region.select((F.col("r_regionkey") + 200).alias("n_nationkey"), F.col("r_name").alias("n_name"), F.col("r_regionkey").alias("n_regionkey"))
    return state.insert(t.nation, rows).state


@query("select * from nation union all select r_regionkey + 300, r_name, 4 from region")
def insert_positional(t: Tables) -> DataFrame:
    return state.insert(t.nation, t.region.select(F.col("r_regionkey") + 300, "r_name"), nation(), ["n_nationkey", "n_name"]).state


@query("select o_orderkey, o_custkey, case when o_orderstatus = 'P' then 'Q' else o_orderstatus end as o_orderstatus, case when o_orderstatus = 'P' then o_custkey * 1.0 else o_totalprice end as o_totalprice from orders")
def update_where(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return state.update(rows, {"o_orderstatus": F.lit("Q"), "o_totalprice": F.col("o_custkey")}, F.col("o_orderstatus") == "P").state


@query("select s_suppkey, upper(s_name) as s_name, s_nationkey, s_acctbal from supplier")
def update_all(t: Tables) -> DataFrame:
    return state.update(t.supplier, {"s_name": F.upper("s_name")}).state


@query("select o_orderkey from orders where o_totalprice >= 100000 or nullif(o_orderstatus, 'F') is null")
def delete_where(t: Tables) -> DataFrame:
    kept = state.delete(t.orders, (F.col("o_totalprice") < 100000) & (F.nullif(F.col("o_orderstatus"), F.lit("F")) != "x")).state
    return kept.select("o_orderkey")


@query("select o_orderkey, o_totalprice from orders where o_totalprice < 20000")
def delete_returning(t: Tables) -> DataFrame:
    return state.delete(t.orders, F.col("o_totalprice") < 20000).removed.select("o_orderkey", "o_totalprice")


@query("select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'F')")
def delete_keys(t: Tables) -> DataFrame:
    return state.delete_keys(t.customer, t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey").state.select("c_custkey")


@query("select 'kept' as place, o_orderkey from orders where o_orderstatus <> 'F' union all select 'moved', o_orderkey from orders where o_orderstatus = 'F'")
def move_returning(t: Tables) -> DataFrame:
    kept, moved = state.move(t.orders, F.col("o_orderstatus") == "F", t.orders.limit(0))
    return kept.select(F.lit("kept").alias("place"), "o_orderkey").union(moved.select(F.lit("moved"), "o_orderkey"))


@query("select p_partkey, case when p_retailprice < 920 then p_retailprice + 100 else p_retailprice end as p_retailprice from part")
def delete_change_insert(t: Tables) -> DataFrame:
    """Rows are taken out, changed and put back."""
    parts = t.part.select("p_partkey", "p_retailprice")
    out = state.delete(parts, F.col("p_retailprice") < 920)
    return state.insert(out.state, out.removed.withColumn("p_retailprice", F.col("p_retailprice") + 100)).state


@query("""select s_suppkey, case when s_suppkey % 3 = 0 and s_suppkey % 2 = 0 then s_name || '*' else s_name end as s_name, s_nationkey, s_acctbal from supplier where not (s_suppkey % 3 = 0 and s_acctbal < 0)
union all select s_suppkey + 100000, s_name, 0, null from supplier where s_suppkey % 5 = 0""")
def merge_three_way(t: Tables) -> DataFrame:
    source = t.supplier.where("s_suppkey % 3 = 0").select("s_suppkey", "s_name").union(t.supplier.where("s_suppkey % 5 = 0").select(F.col("s_suppkey") + 100000, "s_name"))
    defined = table("supplier", "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double", defaults={"s_nationkey": "0"})
    branches = [
        state.matched_delete(F.col("t.s_acctbal") < 0),
        state.matched_update({"s_name": F.concat("t.s_name", F.lit("*"))}, F.col("t.s_suppkey") % 2 == 0),
        state.matched_nothing(),
        state.unmatched_insert({"s_suppkey": F.col("s.s_suppkey"), "s_name": F.col("s.s_name")}),
    ]
    return state.merge(t.supplier, source, {"s_suppkey": "s_suppkey"}, branches, defined).state


@query("""select op, count(*) as n from (select 'U' as op from supplier where s_suppkey % 2 = 0 union all select 'I' from nation where n_nationkey < 3) group by 1""")
def merge_changes(t: Tables) -> DataFrame:
    source = t.supplier.where("s_suppkey % 2 = 0").select("s_suppkey").union(t.nation.where("n_nationkey < 3").select((F.col("n_nationkey") + 100000).cast("bigint")))
    out = state.merge(t.supplier, source, {"s_suppkey": "s_suppkey"}, [state.matched_update({"s_acctbal": F.lit(0.0)}), state.unmatched_insert({"s_suppkey": F.col("s.s_suppkey")})])
    return out.changes.groupBy("op").agg(F.count("*").alias("n"))


_INCOMING = "select s_suppkey * 2 as s_suppkey, 'new ' || s_name as s_name, 1 as s_nationkey, 0.0 as s_acctbal from supplier"


def _incoming(t: Tables) -> DataFrame:
    return t.supplier.select((F.col("s_suppkey") * 2).alias("s_suppkey"), F.concat(F.lit("new "), "s_name").alias("s_name"), F.lit(1).alias("s_nationkey"), F.lit(0.0).alias("s_acctbal"))


@query(f"""with i as ({_INCOMING}) select o.s_suppkey, coalesce(i.s_name, o.s_name) as s_name, o.s_nationkey, o.s_acctbal from supplier o left join i using (s_suppkey)
union all select * from i where s_suppkey not in (select s_suppkey from supplier)""")
def upsert_update(t: Tables) -> DataFrame:
    return state.upsert(t.supplier, _incoming(t), "s_suppkey", {"s_name": F.col("s.s_name")}).state


@query(f"with i as ({_INCOMING}) select * from supplier union all select * from i where s_suppkey not in (select s_suppkey from supplier)")
def upsert_ignore(t: Tables) -> DataFrame:
    return state.upsert(t.supplier, _incoming(t), "s_suppkey").state


@query("""select 'orders' as place, count(*) as n from orders where o_orderstatus <> 'F' union all
select 'archived orders', count(*) from orders where o_orderstatus = 'F' union all
select 'lines', count(*) from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus <> 'F' union all
select 'archived lines', count(*) from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus = 'F'""")
def archive_parent_child(t: Tables) -> DataFrame:
    out = state.archive(t.orders, t.lineitem, "o_orderkey", F.col("o_orderstatus") == "F", F.lit("2024-01-01").cast("date"), child_key="l_orderkey")
    named = {"orders": out.parents, "archived orders": out.archived_parents, "lines": out.children, "archived lines": out.archived_children}
    return relational.union_all(*[d.agg(F.lit(n).alias("place"), F.count("*").alias("n")) for n, d in named.items()])


@query("""with r as (select o_orderkey, (row_number() over (order by o_orderkey) - 1) // 1000 + 1 as round from orders where o_orderstatus = 'F'),
n as (select l_orderkey, count(*) as n from lineitem group by 1)
select round, count(*) as parents, coalesce(cast(sum(n) as bigint), 0) as children from r left join n on o_orderkey = l_orderkey group by 1
union all select max(round) + 1, 0, 0 from r""")
def archive_batched(t: Tables) -> DataFrame:
    return state.archive_rounds(t.orders, t.lineitem, "o_orderkey", F.col("o_orderstatus") == "F", 1000, "l_orderkey")


@query("""select case n_nationkey when 3 then 7 when 7 then 3 else n_nationkey end as n_nationkey, n_name, n_regionkey from nation""")
def key_swap(t: Tables) -> DataFrame:
    """Two keys change places; the unique rule is checked once, after both."""
    swapped = state.update(t.nation, {"n_nationkey": F.when(F.col("n_nationkey") == 3, 7).otherwise(3)}, F.col("n_nationkey").isin(3, 7)).state
    return rules.enforce(swapped, nation())


@query("select 1000 + 2 * row_number() over (order by n_name) as id, n_name, n_regionkey from nation")
def serial_assign(t: Tables) -> DataFrame:
    return state.assign_serial(t.nation.select("n_name", "n_regionkey"), Serial("id", last=1000, step=2), ["n_name"])[0]


@query("select n_nationkey, n_name as title, n_regionkey, 5 as level from nation where n_name <> 'NATION_1'")
def alter_table(t: Tables) -> DataFrame:
    """A column is added with a default, another renamed; the checks follow the name."""
    defined = nation().add(Check("no_one", "n_name <> 'NATION_1'")).add_column("level", "int", "5").rename_column("n_name", "title")
    rows = state.rename_column(state.add_column(t.nation, "level", "int", "5"), "n_name", "title")
    return state.delete(rows, ~F.expr(defined.checks[0].expression)).state


@query("select c_custkey, c_name, c_nationkey, case when c_mktsegment = 'BUILDING' and c_acctbal < 0 then 0 else c_acctbal end as c_acctbal, c_mktsegment from customer where not (c_mktsegment = 'BUILDING' and c_custkey % 7 = 0)")
def view_update(t: Tables) -> DataFrame:
    columns, shown = {"id": "c_custkey", "balance": "c_acctbal"}, F.col("c_mktsegment") == "BUILDING"
    base = state.update_through_view(t.customer, columns, shown, {"balance": F.lit(0.0)}, F.col("balance") < 0).state
    return state.delete_through_view(base, columns, shown, F.col("id") % 7 == 0).state


@query("select 'U' as op, o_orderkey as k, o_totalprice as before, o_totalprice * 2 as after from orders where o_orderstatus = 'O'")
def transition_rows(t: Tables) -> DataFrame:
    out = state.update(t.orders, {"o_totalprice": F.col("o_totalprice") * 2}, F.col("o_orderstatus") == "O")
    return out.changes.select("op", F.col("old.o_orderkey").alias("k"), F.col("old.o_totalprice").alias("before"), F.col("new.o_totalprice").alias("after"))


# -- rules


@query("select o_orderkey, 'x' as null_columns from orders where nullif(o_orderstatus, 'P') is null")
def check_not_null(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("x"))
    return rules.null_violations(rows, ["x", "o_orderkey"]).select("o_orderkey", F.array_join("null_columns", ",").alias("null_columns"))


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def check_unique(t: Tables) -> DataFrame:
    return rules.unique_violations(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("select l_orderkey, count(*) as n from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P') group by 1")
def check_fk(t: Tables) -> DataFrame:
    return rules.foreign_key_violations(t.lineitem, t.orders.where("o_orderstatus <> 'P'"), "l_orderkey", "o_orderkey")


@query("select p_partkey from part where not (nullif(p_size, 7) < 40)")
def check_expr(t: Tables) -> DataFrame:
    return rules.check_violations(t.part, "nullif(p_size, 7) < 40").select("p_partkey")


@query("select p_partkey, p_name from part where length(p_name) > 11")
def check_length(t: Tables) -> DataFrame:
    return rules.length_violations(t.part, {"p_name": 11}).select("p_partkey", "p_name")


def lines() -> TableDef:
    return table(
        "lineitem",
        "l_orderkey bigint, l_linenumber int, l_quantity double",
        uniques=(Unique(("l_orderkey", "l_linenumber"), name="line_key", deferrable=True),),
        checks=(Check("few", "l_quantity < 45"), Check("some", "l_quantity > 2")),
        foreign_keys=(ForeignKey(("l_orderkey",), "orders", ("o_orderkey",), name="order_fk"),),
    )


@query("""select 'few' as rule, count(*) as n from lineitem where not l_quantity < 45 having count(*) > 0
union all select 'some', count(*) from lineitem where not l_quantity > 2 having count(*) > 0""")
def rule_timing(t: Tables) -> DataFrame:
    """At the statement the deferrable rule is not checked yet."""
    return rules.violations(t.lineitem, lines(), {"orders": t.orders}, deferred=False)


@query("""select 'some' as rule, count(*) as n from lineitem where not l_quantity > 2 having count(*) > 0
union all select 'line_key', count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1) having count(*) > 0""")
def rules_disabled(t: Tables) -> DataFrame:
    return rules.violations(t.lineitem, lines().disable("few"), {"orders": t.orders})


@query("""select 'balance covers orders' as rule, count(*) as n from
(select c_custkey from customer join orders on o_custkey = c_custkey group by c_custkey, c_acctbal having sum(o_totalprice) > c_acctbal * 100) having count(*) > 0""")
def cross_table_rule(t: Tables) -> DataFrame:
    def over(customers: DataFrame) -> DataFrame:
        spent = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("spent"))
        return customers.join(spent, "c_custkey").where("spent > c_acctbal * 100")

    return rules.violations(t.customer, table("customer", "c_custkey bigint"), extra={"balance covers orders": over})


@query("select n_nationkey, n_name from nation where n_name = 'NATION_7'")
def exactly_one(t: Tables) -> DataFrame:
    row = relational.strict_one(t.nation.where("n_name = 'NATION_7'").select("n_nationkey", "n_name"))
    return t.nation.where(F.col("n_nationkey") == row.n_nationkey).select("n_nationkey", "n_name")


_CHANGED = """with o as (select case when o_orderkey % 50 = 13 then o_orderkey + 1 when o_orderkey % 50 in (21, 22) then 43 - o_orderkey % 50 + o_orderkey // 50 * 50 else o_orderkey end as k from orders where o_orderkey % 50 <> 7 union all select o_orderkey + 10000000 from orders where o_orderkey % 50 = 5),
l as (select case when l_orderkey % 50 = 7 and l_linenumber = 1 then l_orderkey + 1 when l_orderkey % 50 = 5 then l_orderkey + 10000000 when l_orderkey % 50 = 6 then l_orderkey + 20000000 else l_orderkey end as k from lineitem where l_orderkey % 50 <> 9)"""


@query(f"""{_CHANGED} select 'orders' as "table", k, count(*) as n from o group by k having count(*) > 1
union all select 'lineitem', k, count(*) from l where k not in (select k from o) group by k""")
def delta_rules(t: Tables) -> DataFrame:
    """Unique and foreign keys after inserts, key updates, swaps and deletes in two tables, looked up for touched keys only."""
    at = F.col("o_orderkey") % 50
    moved = F.when(at == 13, F.col("o_orderkey") + 1).when(at.isin(21, 22), F.lit(43) - at + F.expr("o_orderkey div 50 * 50"))
    none, own = F.lit(None).cast("struct<k:bigint>"), F.struct(F.col("o_orderkey").alias("k"))
    orders = t.orders.where(at.isin(7, 13, 21, 22)).select(own.alias("old"), F.when(at != 7, F.struct(moved.alias("k"))).alias("new"))
    orders = orders.unionByName(t.orders.where(at == 5).select(none.alias("old"), F.struct((F.col("o_orderkey") + 10000000).alias("k")).alias("new")))
    line = F.col("l_orderkey") % 50
    to = F.when(line == 7, F.col("l_orderkey") + 1).when(line == 5, F.col("l_orderkey") + 10000000).when(line == 6, F.col("l_orderkey") + 20000000)
    changed = t.lineitem.where(line.isin(5, 6, 9) | ((line == 7) & (F.col("l_linenumber") == 1)))
    lines_ = changed.select(F.struct(F.col("l_orderkey").alias("k")).alias("old"), F.when(line != 9, F.struct(to.alias("k"))).alias("new"))
    before, below = t.orders.select(F.col("o_orderkey").alias("k")), t.lineitem.select(F.col("l_orderkey").alias("k"))
    twice = deltas.unique_violations(before, orders, "k").select(F.lit("orders").alias("table"), "k", "n")
    return twice.unionByName(deltas.foreign_key_violations(below, lines_, before, orders, "k", "k").select(F.lit("lineitem").alias("table"), "k", "n"))
