"""Views, stored results, audit rows, rules that fire."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.catalogue.registry import Tables, query
from tablewright.operators import derived, state


@query("select o_orderstatus, count(*) as n from orders where o_orderkey % 2 = 0 group by 1")
def view_read(t: Tables) -> DataFrame:
    derived.create_view(t.orders.where("o_orderkey % 2 = 0"), "tw_even_orders")
    return t.spark.sql("select o_orderstatus, count(*) as n from tw_even_orders group by 1")


@query("select c_mktsegment, count(*) as n from customer where c_acctbal >= 0 group by 1")
def matview_refresh(t: Tables) -> DataFrame:
    rows = {"customer": t.customer}
    kept = derived.StoredView(t.spark, lambda: rows["customer"].groupBy("c_mktsegment").agg(F.count("*").alias("n")))
    kept.refresh()
    rows["customer"] = state.delete(t.customer, F.col("c_acctbal") < 0).state
    return kept.refresh()


def _inserted(t: Tables) -> state.Outcome:
    rows = t.events.where("event_type = 'signup'").select("event_id", "user_id", "value")
    return state.insert(t.events.select("event_id", "user_id", "value").limit(0), rows)


@query("select 45 + row_number() over (order by event_id) as log_id, event_id, '2024-05-01' as entry_date, 'INSERT' as operation from events where event_type = 'signup'")
def audit_rows(t: Tables) -> DataFrame:
    return derived.audit_rows(_inserted(t).changes, "event_id", F.lit("2024-05-01"), number="log_id", last=45)


@query("select 'UPDATE' as operation, o_orderkey as k, o_orderstatus as before, 'X' as after from orders where o_orderstatus = 'P'")
def audit_images(t: Tables) -> DataFrame:
    out = state.update(t.orders, {"o_orderstatus": F.lit("X")}, F.col("o_orderstatus") == "P")
    return derived.audit_images(out.changes).select("operation", F.col("old.o_orderkey").alias("k"), F.col("old.o_orderstatus").alias("before"), F.col("new.o_orderstatus").alias("after"))


@query("select 'DELETE' as operation, count(*) as rows, '2024-05-01' as entry_date from orders where o_totalprice < 10000")
def audit_statement(t: Tables) -> DataFrame:
    out = state.delete(t.orders, F.col("o_totalprice") < 10000)
    return derived.audit_statement(out.changes, "D", F.lit("2024-05-01"))


@query("select o_orderkey, '2024-05-01' as entry_date, 'UPDATE' as operation from orders where o_orderstatus = 'P' and o_totalprice > 250000")
def audit_when(t: Tables) -> DataFrame:
    out = state.update(t.orders, {"o_totalprice": F.col("o_totalprice") / 2}, F.col("o_orderstatus") == "P")
    return derived.audit_rows(out.changes, "o_orderkey", F.lit("2024-05-01"), ["U"], when=lambda old, new: old["o_totalprice"] - new["o_totalprice"] > 125000)


@query("select event_id, '2024-05-01' as entry_date, 'INSERT' as operation from events where event_type = 'signup' and value < 50")
def audit_deferred(t: Tables) -> DataFrame:
    """Rows that are gone again at commit are not audited."""
    out = _inserted(t)
    final = state.delete(out.state, F.col("value") >= 50).state
    return derived.audit_deferred(out.changes, final, "event_id", F.lit("2024-05-01"))


@query("select s_suppkey as k, s_nationkey as nation from supplier where s_acctbal < 0")
def depth_guard(t: Tables) -> DataFrame:
    """A rule that would fire itself again stops at its depth."""

    def copy(rows: DataFrame) -> dict[str, DataFrame]:
        return {"supplier": rows}

    deleted = state.delete(t.supplier, F.col("s_acctbal") < 0).changes
    done = derived.fire({"supplier": deleted}, [derived.Rule("again", "supplier", copy)])
    assert len(done["supplier"]) == 2
    return done["supplier"][1].select(F.col("old.s_suppkey").alias("k"), F.col("old.s_nationkey").alias("nation"))
