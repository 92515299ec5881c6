"""Scalar functions, user functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.catalogue.registry import Tables, query
from tablewright.functions import routines, scalars


@query("select p_partkey, lower(p_brand) as brand from part")
def lower_text(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.lower("p_brand").alias("brand"))


@query("select o_orderkey, mod(o_orderkey - 7000, 3) as m from orders")
def mod_negative(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", ((F.col("o_orderkey") - 7000) % 3).alias("m"))


@query("select p_partkey, p_name || '/' || p_size || '/' || p_partkey as label, p_name || nullif(p_type, 'ECONOMY') as maybe from part")
def concat_text(t: Tables) -> DataFrame:
    label = scalars.text_concat(F.col("p_name"), F.lit("/"), F.col("p_size"), F.lit("/"), F.col("p_partkey"))
    return t.part.select("p_partkey", label.alias("label"), scalars.text_concat(F.col("p_name"), F.nullif(F.col("p_type"), F.lit("ECONOMY"))).alias("maybe"))


@query("select c_custkey, cast(substr(c_name, 10) as bigint) as number, cast(c_custkey as varchar) as text from customer")
def cast_values(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.substring("c_name", 10, 20).cast("bigint").alias("number"), F.col("c_custkey").cast("string").alias("text"))


@query("select o_orderkey, date_diff('day', cast(o_orderdate as date), date '2002-01-01') as age from orders where o_orderdate < date '1996-01-01'")
def date_argument(t: Tables) -> DataFrame:
    """The present date is an argument, so that a query gives the same rows on any day."""
    rows = t.orders.where(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    return rows.select("o_orderkey", F.date_diff(F.lit("2002-01-01").cast("date"), F.col("o_orderdate").cast("date")).cast("bigint").alias("age"))


@query("select l_orderkey, l_linenumber, l_partkey, cast(ceil(l_quantity / 7) as bigint) as boxes, (l_partkey - 1000) // 7 as q from lineitem where l_partkey >= 1000")
def ceil_and_div(t: Tables) -> DataFrame:
    rows = t.lineitem.where("l_partkey >= 1000")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.ceil(F.col("l_quantity") / 7).cast("bigint").alias("boxes"), scalars.int_div("l_partkey - 1000", "7").alias("q"))


@query("""select s_suppkey, 'update "supplier" set s_name = ''' || replace(s_name, '0', '''''') || ''' where k = ' || s_suppkey as statement from supplier""")
def format_statement(t: Tables) -> DataFrame:
    name = scalars.quote_literal_column(F.replace(F.col("s_name"), F.lit("0"), F.lit("'")))
    head = scalars.format_sql("update %I set s_name = ", "supplier")
    return t.supplier.select("s_suppkey", F.concat(F.lit(head), name, F.lit(" where k = "), F.col("s_suppkey").cast("string")).alias("statement"))


@query("select n_nationkey, 'nation ' || n_name || ' is 100% in ' || coalesce(cast(nullif(n_regionkey, 2) as varchar), '<NULL>') as note from nation")
def message_text(t: Tables) -> DataFrame:
    note = scalars.message("nation % is 100%% in %", F.col("n_name"), F.nullif(F.col("n_regionkey"), F.lit(2)))
    return t.nation.select("n_nationkey", note.alias("note"))


@query("""select doc_id, n, case when n < 10240 then n || ' bytes' when (n // 512) < 20479 then ((n // 512) + 1) // 2 || ' kB'
when (n // 524288) < 20479 then ((n // 524288) + 1) // 2 || ' MB' else ((n // 536870912) + 1) // 2 || ' GB' end as pretty
from (select doc_id, n_chars * n_chars as n from documents)""")
def size_pretty(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", (F.col("n_chars") * F.col("n_chars")).alias("n"))
    return rows.select("doc_id", "n", scalars.size_pretty(F.col("n")).alias("pretty"))


@query("""select event_id, printf('%X/%X', p // 4294967296, p % 4294967296) as at, p from (select event_id, event_id * 987654321 as p from events)""")
def position_text(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", scalars.position_text(F.col("event_id") * 987654321).alias("at"))
    return rows.select("event_id", "at", scalars.position_number(F.col("at")).alias("p"))


@query("select p_partkey, nullif(len(regexp_extract_all(p_name, '[aeiou]')), 0) as vowels from part")
def array_length(t: Tables) -> DataFrame:
    vowels = F.regexp_extract_all("p_name", F.lit("[aeiou]"), F.lit(0))
    return t.part.select("p_partkey", scalars.array_length(vowels).cast("bigint").alias("vowels"))


@query("select n_regionkey, 5 * count(*) as ticks from nation group by 1")
def counter_times(t: Tables) -> DataFrame:
    return t.nation.groupBy("n_regionkey").agg(F.count("*").alias("n")).select("n_regionkey", scalars.times_counter(F.col("n"), 5).alias("ticks"))


@query("select p_partkey, p_size * 10 + 7 as a, p_size * 3 + 7 as b from part")
def udf_defaults(t: Tables) -> DataFrame:
    routines.scalar_function(t.spark, "scaled", {"x": "bigint", "factor": ("bigint", 10), "plus": ("bigint", 7)}, "bigint", "x * factor + plus")
    t.part.createOrReplaceTempView("tw_part")
    return t.spark.sql("select p_partkey, scaled(p_size) as a, scaled(p_size, factor => 3) as b from tw_part")


@query("select p_partkey as k, p_name as name from part where p_size > 40")
def table_function(t: Tables) -> DataFrame:
    t.part.createOrReplaceTempView("tw_part")
    routines.table_function(t.spark, "parts_over", {"k": "bigint", "name": "string"}, "select p_partkey, p_name from tw_part where p_size > least_size", {"least_size": "int"})
    return t.spark.sql("select * from parts_over(40)")


@query("select * from nation where n_regionkey = 1")
def set_of_rows(t: Tables) -> DataFrame:
    t.nation.createOrReplaceTempView("tw_nation")
    routines.set_function(t.spark, "nations_of_one", t.nation, "select * from tw_nation where n_regionkey = 1")
    return t.spark.sql("select * from nations_of_one()")


@query("select n_name as x from nation")
def names_as_arguments(t: Tables) -> DataFrame:
    t.nation.createOrReplaceTempView("tw_nation")
    return routines.by_name(t.spark, "select identifier(:c) as x from identifier(:t)", t="tw_nation", c="n_name")
