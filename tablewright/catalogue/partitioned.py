"""Partitioned and inherited tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.catalogue.registry import Tables, query
from tablewright.operators import partitions, state
from tablewright.plans.tabledef import Part, table
from tablewright.session import scratch_path
from tablewright.sources import parts

PRICES = partitions.by_range("p_retailprice", {"low": (900.0, 930.0), "middle": (930.0, 960.0)}, default="rest")
YEARS = partitions.by_range("o_orderdate", {f"y{y}": (dt.datetime(y, 1, 1), dt.datetime(y + 1, 1, 1)) for y in range(1995, 2000)}, default="later")
_PRICE_CASE = "case when p_retailprice < 930 then 'low' when p_retailprice < 960 then 'middle' else 'rest' end"


@query("select o_orderkey, case when year(o_orderdate) < 2000 then 'y' || year(o_orderdate) else 'later' end as part from orders")
def range_route(t: Tables) -> DataFrame:
    return partitions.route(t.orders, YEARS, "part").select("o_orderkey", "part")


@query("select n_nationkey, case when n_regionkey in (0, 1) then 'south' when n_regionkey = 2 then 'east' end as part from nation")
def list_route(t: Tables) -> DataFrame:
    return partitions.route(t.nation, partitions.by_list("n_regionkey", {"south": [0, 1], "east": [2]}), "part").select("n_nationkey", "part")


@query("select o_orderkey, 'p' || (o_orderkey % 4) as part, cast(('0x' || substr(md5(o_orderpriority), 1, 8)) as bigint) % 3 as slot from orders")
def hash_route(t: Tables) -> DataFrame:
    rows = partitions.route(t.orders, partitions.by_hash("o_orderkey", 4), "part")
    return rows.select("o_orderkey", "part", partitions.hash_slot(F.col("o_orderpriority"), 3, text=True).alias("slot"))


@query(f"select p_partkey, {_PRICE_CASE} as part from part")
def default_route(t: Tables) -> DataFrame:
    return partitions.route(t.part, PRICES, "part").select("p_partkey", "part")


@query("select p_partkey, case when p_retailprice < 930 then 'low' when p_retailprice < 960 then 'middle' else 'rest' end as part, case when p_retailprice < 930 then 'p' || (p_partkey % 2) end as part_sub from part")
def sub_route(t: Tables) -> DataFrame:
    return partitions.route_sub(t.part, PRICES, {"low": partitions.by_hash("p_partkey", 2)}, "part").select("p_partkey", "part", "part_sub")


@query("select n_nationkey from nation where n_regionkey > 2")
def unroutable_rows(t: Tables) -> DataFrame:
    return partitions.unroutable(t.nation, partitions.by_list("n_regionkey", {"south": [0, 1], "east": [2]})).select("n_nationkey")


def _stored(t: Tables) -> str:
    path = scratch_path(t.spark, "parts")
    parts.write(t.part, PRICES, path)
    return path


@query("select p_partkey, p_name, p_retailprice from part")
def routed_insert(t: Tables) -> DataFrame:
    return parts.read(t.spark, _stored(t), PRICES).select("p_partkey", "p_name", "p_retailprice")


@query("select p_partkey from part where p_retailprice >= 930 and p_retailprice < 960")
def read_partition(t: Tables) -> DataFrame:
    return parts.read_part(t.spark, _stored(t), "middle").select("p_partkey")


@query("select p_partkey, p_retailprice from part where p_retailprice between 905 and 935")
def part_pruned_scan(t: Tables) -> DataFrame:
    return parts.read(t.spark, _stored(t), PRICES, 905.0, 935.0).select("p_partkey", "p_retailprice")


@query("select p_partkey, p_retailprice from part where p_retailprice >= 930")
def drop_partition(t: Tables) -> DataFrame:
    return parts.without_part(t.spark, _stored(t), "low").select("p_partkey", "p_retailprice")


@query("select p_partkey, p_retailprice from part where p_retailprice >= 930 union all select p_partkey, 900.0 from part where p_retailprice < 910")
def exchange_partition(t: Tables) -> DataFrame:
    path = _stored(t)
    parts.replace_part(t.part.where("p_retailprice < 910").withColumn("p_retailprice", F.lit(900.0)), PRICES, "low", path)
    return parts.read(t.spark, path, PRICES).select("p_partkey", "p_retailprice")


@query("select p_partkey, p_size from part where p_size < 40")
def attach_partition(t: Tables) -> DataFrame:
    sizes = partitions.by_range("p_size", {"small": (0, 20)}, default="other")
    path = scratch_path(t.spark, "parts")
    parts.write(t.part.where("p_size < 20").select("p_partkey", "p_size"), sizes, path)
    grown = parts.attach(t.part.where("p_size between 20 and 39").select("p_partkey", "p_size"), Part("large", (20,), (40,)), sizes, path)
    return parts.read(t.spark, path, grown)


@query("""with n as (select p_partkey, p_retailprice, p_retailprice + 30 as up from part where p_size = 10)
select p_partkey, case when p_retailprice < 930 then 'low' when p_retailprice < 960 then 'middle' else 'rest' end as old_part, case when up < 930 then 'low' when up < 960 then 'middle' else 'rest' end as new_part from n
where p_retailprice < 960""")
def row_movement(t: Tables) -> DataFrame:
    """The rows that an update of the key sends to another partition."""
    out = state.update(t.part, {"p_retailprice": F.col("p_retailprice") + 30}, F.col("p_size") == 10)
    return partitions.moved_rows(t.part, out.state, "p_partkey", PRICES)


@query("select p_partkey, cast(floor((p_retailprice - (select min(p_retailprice) from part)) / 25) as bigint) + 1 as part from part")
def equal_range_parts(t: Tables) -> DataFrame:
    return partitions.split_equal(t.part, "p_retailprice", 25, "part").select("p_partkey", "part")


_CHILDREN = {"cheap": "p_retailprice < 930", "dear": "p_retailprice >= 970"}


@query("select p_partkey, case when p_retailprice < 930 then 'cheap' when p_retailprice >= 970 then 'dear' else 'goods' end as place from part")
def inherit_union(t: Tables) -> DataFrame:
    routed = partitions.inherit_route(t.part, _CHILDREN, "goods")
    tables = {n: routed.where(F.col("_table") == n).drop("_table") for n in ("goods", *_CHILDREN)}
    return partitions.inherit_read(tables, "goods", name="place").select("p_partkey", "place")


@query("select p_partkey from part where p_retailprice >= 930 and p_retailprice < 970")
def inherit_only(t: Tables) -> DataFrame:
    routed = partitions.inherit_route(t.part, _CHILDREN, "goods")
    tables = {n: routed.where(F.col("_table") == n).drop("_table") for n in ("goods", *_CHILDREN)}
    return partitions.inherit_read(tables, "goods", only=True).select("p_partkey")


@query("select p_partkey from part where p_retailprice >= 975")
def child_elimination(t: Tables) -> DataFrame:
    tables = {"goods": t.part.where("p_retailprice >= 930 and p_retailprice < 970"), "cheap": t.part.where(_CHILDREN["cheap"]), "dear": t.part.where(_CHILDREN["dear"])}
    return partitions.read_children(tables, {"cheap": (None, 930.0), "dear": (970.0, None)}, "goods", "p_retailprice", low=975.0).select("p_partkey")


@query("select n_nationkey as id, n_name as name, n_regionkey as region, 'x' as extra from nation")
def merged_parents(t: Tables) -> DataFrame:
    """A child of two parents has each column once, and its own."""
    child = partitions.merged_columns([table("a", "id int, name string"), table("b", "id int, region int")], "child", "extra string")
    rows = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"), F.lit("x").alias("extra"))
    return rows.select(*child.schema.names)


@query("select o_orderstatus, count(*) as n, max(o_totalprice) as top from orders group by 1")
def shard_gather(t: Tables) -> DataFrame:
    sharded = partitions.shards(t.orders, "o_custkey", 4)
    return partitions.gathered(sharded, ["o_orderstatus"], [F.count("*").alias("n"), F.max("o_totalprice").alias("top")], [F.sum("n").alias("n"), F.max("top").alias("top")])
