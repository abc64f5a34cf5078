"""Test queries for projections, filters, joins, aggregates, pivots, ordering,
batch event-time windows, the UDF surface and the end-to-end jobs.

Every query reads whole driver tables.  Doubles that come from summing
non-integers are rounded in both the query and its oracle, since the two
engines add in different orders.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidewater.functions import columns as C
from tidewater.functions.udfs import (register_brand_number, register_country_grouping,
                                      register_has_passed)
from tidewater.operators import relational as R
from tidewater.operators.pivot import pivot_agg, sparse_pivot
from tidewater.operators.stats import correlations
from tidewater.operators.text import STOP_WORDS, remove_stop_words, tokenize, word_counts
from tidewater.operators.windows import sliding_sum, top_k_per_window, window_agg
from tidewater.plans import jobs
from tidewater.plans.registry import half_up, register
from tidewater.sources.tables import Tables

# The columns that the oracle of pivot_user_item expects; the query finds its own.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August",
          "September", "October", "November", "December")


def _stop_list_sql() -> str:
    return ", ".join("'" + w + "'" for w in STOP_WORDS)


def _month_pivot_sql() -> str:
    return ",\n  ".join(
        f"nullif(count(*) filter (where monthname(o_orderdate) = '{m}'), 0) as \"{m}\""
        for m in MONTHS)


def _event_pivot_sql() -> str:
    return ",\n  ".join(
        half_up(f"sum(value) filter (where event_type = '{e}')", 4) + f' as "{e}"'
        for e in EVENT_TYPES)


def _status_pivot_sql() -> str:
    out = []
    for s in ("F", "O", "P"):
        out.append(half_up(f"avg(o_totalprice) filter (where o_orderstatus = '{s}')", 2)
                   + f' as "{s}_avg"')
        out.append(half_up(f"stddev_samp(o_totalprice) filter (where o_orderstatus = '{s}')", 2)
                   + f' as "{s}_std_dev"')
    return ",\n  ".join(out)


def _year_pivot_sql(years=range(1995, 2002)) -> str:
    out = []
    for y in years:
        out.append(half_up(f"avg(o_totalprice) filter (where year(o_orderdate) = {y})", 2)
                   + f' as "{y}_avg"')
        out.append(half_up(f"stddev_samp(o_totalprice) filter (where year(o_orderdate) = {y})", 2)
                   + f' as "{y}_std_dev"')
    return ",\n  ".join(out)


# --------------------------------------------------------------------------
# 2.2 projections, filters, scalar functions
# --------------------------------------------------------------------------

@register("project_alias_cast", """
select o_orderkey, o_custkey as customer_id,
       cast(strftime(o_orderdate, '%Y') as integer) as order_year, o_orderstatus as status
from orders""")
def q_project_alias_cast(spark, sf):
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", F.col("o_custkey").alias("customer_id"),
                    F.date_format("o_orderdate", "yyyy").alias("order_year").cast("int"),
                    F.col("o_orderstatus").alias("status"))


@register("rename_column", "select p_partkey, p_retailprice as label from part")
def q_rename_column(spark, sf):
    return (Tables(spark, sf).part.withColumnRenamed("p_retailprice", "label")
            .select("p_partkey", "label"))


@register("drop_columns", """
select l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag,
       l_linestatus
from lineitem""")
def q_drop_columns(spark, sf):
    return Tables(spark, sf).lineitem.drop("l_partkey", "l_suppkey", "l_tax", "l_shipdate")


@register("ratio_column", """
select p_partkey, p_retailprice / nullif(cast(p_size - 1 as double), 0) as price_per_extra_size
from part""")
def q_ratio_column(spark, sf):
    p = Tables(spark, sf).part
    return p.select("p_partkey",
                    C.safe_ratio("p_retailprice", F.col("p_size") - 1).alias("price_per_extra_size"))


@register("scale_column", """
select l_orderkey, l_linenumber, l_discount * 100 as discount_pct from lineitem""")
def q_scale_column(spark, sf):
    li = Tables(spark, sf).lineitem
    return li.select("l_orderkey", "l_linenumber", (F.col("l_discount") * 100).alias("discount_pct"))


@register("constant_measure", """
select event_id, event_type as course_name, 5 as seconds_watched from events""")
def q_constant_measure(spark, sf):
    e = Tables(spark, sf).events
    return e.select("event_id", F.col("event_type").alias("course_name"),
                    F.lit(5).alias("seconds_watched"))


@register("swap_key_value", "select o_custkey as key, o_orderkey as value from orders")
def q_swap_key_value(spark, sf):
    pairs = Tables(spark, sf).orders.select(F.col("o_orderkey").alias("key"),
                                            F.col("o_custkey").alias("value"))
    return pairs.select(F.col("value").alias("key"), F.col("key").alias("value"))


@register("null_to_zero", """
select c.c_custkey, coalesce(u.n_urgent, 0) as n_urgent
from customer c
left join (select o_custkey, count(*) as n_urgent from orders
           where o_orderpriority = '1-URGENT' group by o_custkey) u
  on c.c_custkey = u.o_custkey""")
def q_null_to_zero(spark, sf):
    t = Tables(spark, sf)
    urgent = (t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
              .groupBy(F.col("o_custkey").alias("c_custkey"))
              .agg(F.count(F.lit(1)).alias("n_urgent")))
    joined = t.customer.select("c_custkey").join(urgent, "c_custkey", "left")
    return R.fill_zero(joined, ["n_urgent"])


@register("binary_label", """
select l_orderkey, l_linenumber,
       case when l_discount > 0.05 then 0 else 1 end as label_low_discount,
       case when l_quantity >= 25 then 1 else 0 end as label_bulk
from lineitem""")
def q_binary_label(spark, sf):
    li = Tables(spark, sf).lineitem
    return li.select("l_orderkey", "l_linenumber",
                     C.binary_label("l_discount", 0.05, when_true=0, when_false=1)
                     .alias("label_low_discount"),
                     C.binary_label("l_quantity", 25, inclusive=True).alias("label_bulk"))


@register("band_score", """
select c_custkey,
       case when c_acctbal / 10000.0 > cast(0.9 as double) then 10
            when c_acctbal / 10000.0 > cast(0.5 as double) then 4
            when c_acctbal / 10000.0 > cast(0.25 as double) then 2 else 0 end as score
from customer""")
def q_band_score(spark, sf):
    c = Tables(spark, sf).customer
    return c.select("c_custkey", C.band_score(F.col("c_acctbal") / F.lit(10000.0)).alias("score"))


_FILTER_ORACLE = """
select o_orderkey, o_custkey, o_totalprice from orders
where o_orderstatus = 'F' and o_orderdate >= timestamp '1998-01-01'"""


@register("filter_sql_text", _FILTER_ORACLE)
def q_filter_sql_text(spark, sf):
    o = Tables(spark, sf).orders
    return (o.filter("o_orderstatus = 'F' AND o_orderdate >= timestamp_ntz'1998-01-01 00:00:00'")
            .select("o_orderkey", "o_custkey", "o_totalprice"))


@register("filter_column_expr", _FILTER_ORACLE)
def q_filter_column_expr(spark, sf):
    o = Tables(spark, sf).orders
    cond = ((F.col("o_orderstatus") == F.lit("F"))
            & (F.col("o_orderdate") >= F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")))
    return o.filter(cond).select("o_orderkey", "o_custkey", "o_totalprice")


@register("filter_row_predicate", _FILTER_ORACLE)
def q_filter_row_predicate(spark, sf):
    """A predicate over the whole row, written as a function of its columns, so
    that it reaches the scan like any other filter."""
    o = Tables(spark, sf).orders

    def keep(row):
        since = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
        return row["o_orderstatus"].eqNullSafe("F") & ~(row["o_orderdate"] < since)

    return o.filter(keep(o)).select("o_orderkey", "o_custkey", "o_totalprice")


@register("stopword_filter", f"""
with t as (select unnest(string_split_regex(lower(text), '[^\\p{{L}}\\p{{M}}]+')) as word from documents)
select word, count(*) as n from t
where word <> '' and word not in ({_stop_list_sql()})
group by word""")
def q_stopword_filter(spark, sf):
    docs = Tables(spark, sf).documents
    words = remove_stop_words(tokenize(docs, "text"), "word", STOP_WORDS)
    return word_counts(words, "word", "n")


@register("month_name", "select o_orderkey, monthname(o_orderdate) as month from orders")
def q_month_name(spark, sf):
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", C.month_name("o_orderdate").alias("month"))


@register("month_number",
          "select o_orderkey, cast(month(o_orderdate) as integer) as month_num from orders")
def q_month_number(spark, sf):
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", C.month_number("o_orderdate").alias("month_num"))


@register("month_name_to_number", """
select monthname(o_orderdate) as month, cast(month(o_orderdate) as integer) as month_num,
       count(*) as n_orders
from orders group by 1, 2""")
def q_month_name_to_number(spark, sf):
    o = Tables(spark, sf).orders
    named = o.select(C.month_name("o_orderdate").alias("month"))
    return (named.groupBy("month").agg(F.count(F.lit(1)).alias("n_orders"))
            .select("month", C.month_number_from_name("month").alias("month_num"), "n_orders"))


@register("split_field", """
select c_custkey, split_part(c_name, '#', 1) as name_prefix,
       split_part(c_name, '#', 2) as name_number
from customer""")
def q_split_field(spark, sf):
    c = Tables(spark, sf).customer
    return c.select("c_custkey", C.split_field("c_name", "#", 1).alias("name_prefix"),
                    C.split_field("c_name", "#", 2).alias("name_number"))


@register("prefix_test",
          "select o_orderkey, starts_with(o_orderpriority, '1') as is_urgent from orders")
def q_prefix_test(spark, sf):
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", F.col("o_orderpriority").startswith("1").alias("is_urgent"))


@register("round_to", f"""
select c_custkey, c_acctbal, {half_up("c_acctbal", 1)} as acctbal_1dp from customer""")
def q_round_to(spark, sf):
    """HALF_UP on the decimal value: 1863.85 -> 1863.9, -5.25 -> -5.3."""
    c = Tables(spark, sf).customer
    return c.select("c_custkey", "c_acctbal", C.round_half_up("c_acctbal", 1).alias("acctbal_1dp"))


@register("binary_to_string", "select p_partkey, p_name as name from part")
def q_binary_to_string(spark, sf):
    p = Tables(spark, sf).part
    raw = p.select("p_partkey", F.col("p_name").cast("binary").alias("payload"))
    return raw.select("p_partkey", C.binary_to_string("payload").alias("name"))


# --------------------------------------------------------------------------
# 2.3 joins
# --------------------------------------------------------------------------

@register("inner_equi_join", """
select o.o_orderkey, c.c_name, o.o_totalprice
from orders o join customer c on o.o_custkey = c.c_custkey""")
def q_inner_equi_join(spark, sf):
    t = Tables(spark, sf)
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return R.inner_join(t.orders, c, "o_custkey").select("o_orderkey", "c_name", "o_totalprice")


@register("using_join_of_aggregates", """
select l_partkey as item, count(*) as n_ratings, avg(l_quantity) as avg_rating
from lineitem group by 1""")
def q_using_join_of_aggregates(spark, sf):
    li = Tables(spark, sf).lineitem.select(F.col("l_partkey").alias("item"), "l_quantity")
    return R.mean_and_count_by(li, "item", "l_quantity", "avg_rating", "n_ratings")


@register("broadcast_lookup", """
select l.l_orderkey, l.l_linenumber, p.p_name
from lineitem l left join part p on l.l_partkey = p.p_partkey""")
def q_broadcast_lookup(spark, sf):
    t = Tables(spark, sf)
    names = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    facts = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return R.lookup(facts, names, "l_partkey").select("l_orderkey", "l_linenumber", "p_name")


# --------------------------------------------------------------------------
# 2.4 aggregation, distinct, pivot
# --------------------------------------------------------------------------

@register("count_by_key", "select l_partkey, count(*) as n from lineitem group by 1")
def q_count_by_key(spark, sf):
    return R.count_by(Tables(spark, sf).lineitem, "l_partkey", "n")


@register("count_by_composite_key", """
select l_returnflag, l_linestatus, count(*) as n from lineitem group by 1, 2""")
def q_count_by_composite_key(spark, sf):
    return R.count_by(Tables(spark, sf).lineitem, ["l_returnflag", "l_linestatus"], "n")


@register("sum_by_key", "select l_suppkey, sum(l_quantity) as total_qty from lineitem group by 1")
def q_sum_by_key(spark, sf):
    return R.sum_by(Tables(spark, sf).lineitem, "l_suppkey", "l_quantity", "total_qty")


@register("sum_count_by_key", """
select l_partkey, sum(l_quantity) as total_qty, count(*) as n from lineitem group by 1""")
def q_sum_count_by_key(spark, sf):
    return R.sum_count_by(Tables(spark, sf).lineitem, "l_partkey", "l_quantity", "total_qty", "n")


@register("avg_by_key", "select l_partkey, avg(l_quantity) as avg_qty from lineitem group by 1")
def q_avg_by_key(spark, sf):
    return R.avg_by(Tables(spark, sf).lineitem, "l_partkey", "l_quantity", "avg_qty")


@register("having_min_count", """
select l_partkey, count(*) as n from lineitem group by 1 having count(*) > 10""")
def q_having_min_count(spark, sf):
    return R.having(R.count_by(Tables(spark, sf).lineitem, "l_partkey", "n"), F.col("n") > 10)


@register("max_mean_by_keys", f"""
select o_orderstatus, o_orderpriority, max(o_totalprice) as max_price,
       {half_up("avg(o_totalprice)", 4)} as mean_price
from orders group by 1, 2""")
def q_max_mean_by_keys(spark, sf):
    o = Tables(spark, sf).orders
    return (R.max_mean_by(o, ["o_orderstatus", "o_orderpriority"], "o_totalprice",
                          "max_price", "mean_price")
            .withColumn("mean_price", F.round("mean_price", 4)))


@register("stddev_by_key", f"""
select o_orderpriority, {half_up("avg(o_totalprice)", 2)} as avg,
       {half_up("stddev_samp(o_totalprice)", 2)} as std_dev
from orders group by 1""")
def q_stddev_by_key(spark, sf):
    return R.mean_stddev_by(Tables(spark, sf).orders, "o_orderpriority", "o_totalprice", 2)


@register("distinct_rows", """
select distinct o.o_custkey, l.l_suppkey
from lineitem l join orders o on l.l_orderkey = o.o_orderkey""")
def q_distinct_rows(spark, sf):
    t = Tables(spark, sf)
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return R.distinct_rows(t.lineitem.select("l_orderkey", "l_suppkey").join(o, "l_orderkey"),
                           ["o_custkey", "l_suppkey"])


@register("distinct_column_sorted", """
select distinct cast(year(o_orderdate) as integer) as order_year from orders
order by order_year desc""")
def q_distinct_column_sorted(spark, sf):
    o = Tables(spark, sf).orders.select(F.year("o_orderdate").alias("order_year"))
    return R.distinct_sorted(o, "order_year", descending=True)


@register("global_sum", "select cast(count(*) as bigint) as total from orders")
def q_global_sum(spark, sf):
    counts = R.count_by(Tables(spark, sf).orders, "o_orderpriority", "total")
    return R.global_sum(counts, "total", "total")


@register("pivot_inferred_multi_agg", f"""
select c.c_mktsegment,
  {_status_pivot_sql()}
from orders o join customer c on o.o_custkey = c.c_custkey
group by c.c_mktsegment""")
def q_pivot_inferred_multi_agg(spark, sf):
    t = Tables(spark, sf)
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    j = t.orders.select("o_custkey", "o_orderstatus", "o_totalprice").join(c, "o_custkey")
    return pivot_agg(j, "c_mktsegment", "o_orderstatus",
                     {"avg": (lambda c: F.round(F.avg(c), 2), "o_totalprice"),
                      "std_dev": (lambda c: F.round(F.stddev_samp(c), 2), "o_totalprice")})


@register("pivot_explicit_values", f"""
select o_orderpriority,
  {_month_pivot_sql()}
from orders group by o_orderpriority""")
def q_pivot_explicit_values(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderpriority",
                                        C.month_name("o_orderdate").alias("month"))
    return pivot_agg(o, "o_orderpriority", "month", {"count": (F.count, F.lit(1))}, MONTHS)


@register("pivot_user_item", f"""
select user_id,
  {_event_pivot_sql()}
from events group by user_id""")
def q_pivot_user_item(spark, sf):
    e = Tables(spark, sf).events
    return pivot_agg(e, "user_id", "event_type", {"sum": (lambda c: F.round(F.sum(c), 4), "value")})


@register("ratio_of_counts", """
with s as (select n.n_regionkey, n.n_nationkey from supplier s
           join nation n on s.s_nationkey = n.n_nationkey),
     c as (select n_regionkey, n_nationkey, count(*) as n_suppliers from s group by 1, 2),
     p as (select n_regionkey, count(*) as n_region from s group by 1)
select c.n_nationkey, c.n_suppliers, cast(c.n_suppliers as double) / p.n_region as share
from c join p on c.n_regionkey = p.n_regionkey""")
def q_ratio_of_counts(spark, sf):
    t = Tables(spark, sf)
    nations = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    s = t.supplier.select("s_nationkey").join(nations, "s_nationkey")
    child = s.groupBy("n_regionkey", F.col("s_nationkey").alias("n_nationkey")) \
             .agg(F.count(F.lit(1)).alias("n_suppliers"))
    # parent totals from the (small) child counts: the fact side is read once
    parent = child.groupBy("n_regionkey").agg(F.sum("n_suppliers").alias("n_region"))
    return (R.ratio_of_counts(child, parent, "n_regionkey", "n_suppliers", "n_region")
            .select("n_nationkey", "n_suppliers", "share"))


@register("pearson_corr", f"""
select 'l_extendedprice' as feature, {half_up("corr(l_quantity, l_extendedprice)", 6)} as corr
from lineitem
union all select 'l_discount', {half_up("corr(l_quantity, l_discount)", 6)} from lineitem
union all select 'l_tax', {half_up("corr(l_quantity, l_tax)", 6)} from lineitem""")
def q_pearson_corr(spark, sf):
    li = Tables(spark, sf).lineitem
    return correlations(li, "l_quantity", ["l_extendedprice", "l_discount", "l_tax"], digits=6)


# --------------------------------------------------------------------------
# 2.5 sort, limit, top-k
# --------------------------------------------------------------------------

@register("sort_asc", """
select s_suppkey, s_name, s_acctbal from supplier order by s_acctbal, s_suppkey""")
def q_sort_asc(spark, sf):
    s = Tables(spark, sf).supplier.select("s_suppkey", "s_name", "s_acctbal")
    return R.sort_by(s, ["s_acctbal", "s_suppkey"])


@register("sort_desc", """
select s_suppkey, s_name, s_acctbal from supplier order by s_acctbal desc, s_suppkey desc""")
def q_sort_desc(spark, sf):
    s = Tables(spark, sf).supplier.select("s_suppkey", "s_name", "s_acctbal")
    return R.sort_by(s, ["s_acctbal", "s_suppkey"], descending=True)


@register("top_k", """
select p_partkey, p_name, p_retailprice from part
order by p_retailprice, p_partkey limit 10""")
def q_top_k(spark, sf):
    p = Tables(spark, sf).part.select("p_partkey", "p_name", "p_retailprice")
    return R.top_k(p, 10, [F.col("p_retailprice").asc(), F.col("p_partkey").asc()])


@register("limit_unordered", """
select c_custkey, c_name from customer order by c_custkey limit 5""")
def q_limit_unordered(spark, sf):
    c = Tables(spark, sf).customer.select("c_custkey", "c_name")
    return R.top_k(c, 5, [F.col("c_custkey").asc()])


@register("top_k_per_window", """
with s as (select time_bucket(interval 1 hour, ts) as window_start, user_id,
                  cast(sum(5) as bigint) as seconds_watched
           from events group by 1, 2),
     r as (select *, row_number() over (partition by window_start
                                        order by seconds_watched desc, user_id) as rn from s)
select window_start, window_start + interval 1 hour as window_end, user_id, seconds_watched,
       cast(rn as integer) as rank
from r where rn <= 3""")
def q_top_k_per_window(spark, sf):
    e = Tables(spark, sf).events
    return top_k_per_window(e, "ts", "1 hour", "user_id", F.lit(5), 3, "seconds_watched")


# --------------------------------------------------------------------------
# 2.6 event-time windows, batch form
# --------------------------------------------------------------------------

@register("tumbling_event_window", """
select time_bucket(interval 2 minute, ts) as window_start,
       time_bucket(interval 2 minute, ts) + interval 2 minute as window_end,
       event_type as course_name, cast(sum(5) as bigint) as seconds_watched
from events group by 1, 2, 3""")
def q_tumbling_event_window(spark, sf):
    e = Tables(spark, sf).events.select("ts", F.col("event_type").alias("course_name"))
    return window_agg(e, "ts", "course_name", "2 minutes", None,
                      {"seconds_watched": F.sum(F.lit(5))})


@register("sliding_window_60m_1m", """
with b as (select time_bucket(interval 1 minute, ts) as b, event_type, count(*) as n
           from events group by 1, 2)
select b - k * interval 1 minute as window_start,
       b - k * interval 1 minute + interval 60 minute as window_end,
       event_type as course_name, cast(sum(n) * 5 as bigint) as seconds_watched
from b, range(60) r(k)
group by 1, 2, 3""")
def q_sliding_window_60m_1m(spark, sf):
    e = Tables(spark, sf).events.select("ts", F.col("event_type").alias("course_name"))
    return sliding_sum(e, "ts", "course_name", "60 minutes", "1 minute", F.lit(5),
                       "seconds_watched")


@register("sliding_window_default_slide", """
with b as (select time_bucket(interval 2 second, ts) as b, event_type, count(*) as n
           from events group by 1, 2)
select b - k * interval 2 second as window_start,
       b - k * interval 2 second + interval 2 minute as window_end,
       event_type as level, cast(sum(n) as bigint) as n
from b, range(60) r(k)
group by 1, 2, 3""")
def q_sliding_window_default_slide(spark, sf):
    e = Tables(spark, sf).events.select("ts", F.col("event_type").alias("level"))
    return sliding_sum(e, "ts", "level", "2 minutes", "2 seconds", None, "n")


# --------------------------------------------------------------------------
# 2.7 UDF surface
# --------------------------------------------------------------------------

@register("udf_pass_rule", """
select o_orderkey,
       case when o_orderstatus = 'F' then starts_with(o_orderpriority, '1')
            else starts_with(o_orderpriority, '1') or starts_with(o_orderpriority, '2')
                 or starts_with(o_orderpriority, '3') end as passed
from orders""")
def q_udf_pass_rule(spark, sf):
    o = Tables(spark, sf).orders
    return o.select("o_orderkey",
                    C.pass_rule("o_orderpriority", "o_orderstatus", "F", ("1",), ("1", "2", "3"))
                    .alias("passed"))


@register("sql_called_rules", """
select o_orderkey,
       case when o_orderstatus = 'Biology' then starts_with(o_orderpriority, 'A')
            else starts_with(o_orderpriority, 'A') or starts_with(o_orderpriority, 'B')
                 or starts_with(o_orderpriority, 'C') end as passed,
       case when o_orderstatus in ('GB', 'US', 'IN', 'UNKNOWN') then o_orderstatus
            when o_orderstatus in ('DE', 'FR', 'EU') then 'EUROPE' else 'OTHER' end as country
from (select o_orderkey, substr('DBCAE', cast(substr(o_orderpriority, 1, 1) as int), 1) as o_orderpriority,
             case o_orderstatus when 'F' then 'Biology' when 'O' then 'DE' else 'US' end as o_orderstatus
      from orders)""")
def q_sql_called_rules(spark, sf):
    """The pass rule and the country grouping, registered and called from SQL text."""
    register_has_passed(spark)
    register_country_grouping(spark)
    view = f"tw_exam_{uuid.uuid4().hex[:8]}"
    o = Tables(spark, sf).orders
    grade = F.substring(F.lit("DBCAE"), F.substring("o_orderpriority", 1, 1).cast("int"), F.lit(1))
    subject = F.when(F.col("o_orderstatus") == "F", "Biology").when(
        F.col("o_orderstatus") == "O", "DE").otherwise("US")
    o.select("o_orderkey", grade.alias("grade"), subject.alias("subject")).createOrReplaceTempView(view)
    return spark.sql(f"""
        select o_orderkey, hasPassed(grade, subject) as passed, countryGrouping(subject) as country
        from {view}""")


# Nation grouping used by the test query: a few nations kept, region 3's
# other members folded into one group, the rest OTHER.
_KEEP_NATIONS = ("NATION_0", "NATION_1", "NATION_2", "NATION_3")
_GROUPED_NATIONS = ("NATION_8", "NATION_13", "NATION_18", "NATION_23")


@register("category_grouping", f"""
select c.c_custkey,
       case when n.n_name in ({", ".join("'" + x + "'" for x in _KEEP_NATIONS)}) then n.n_name
            when n.n_name in ({", ".join("'" + x + "'" for x in _GROUPED_NATIONS)}) then 'EUROPE'
            else 'OTHER' end as country
from customer c left join nation n on c.c_nationkey = n.n_nationkey""")
def q_category_grouping(spark, sf):
    t = Tables(spark, sf)
    names = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    c = R.lookup(t.customer.select("c_custkey", "c_nationkey"), names, "c_nationkey")
    return c.select("c_custkey", C.category_group("n_name", _KEEP_NATIONS,
                                                  {"EUROPE": _GROUPED_NATIONS}).alias("country"))


@register("register_sql_udf", """
select p_partkey, cast(split_part(p_brand, '#', 2) as integer) as brand_no from part""")
def q_register_sql_udf(spark, sf):
    register_brand_number(spark)
    view = f"tw_part_{uuid.uuid4().hex[:8]}"
    Tables(spark, sf).part.createOrReplaceTempView(view)
    return spark.sql(f"select p_partkey, brand_number(p_brand) as brand_no from {view}")


# --------------------------------------------------------------------------
# 2.9 end-to-end jobs
# --------------------------------------------------------------------------

@register("lowest_rated_items", """
with s as (select l_partkey as item, count(*) as n_ratings, avg(l_quantity) as avg_rating
           from lineitem group by 1 having count(*) > 10
           order by avg_rating, item limit 10)
select s.item, p.p_name as name, s.n_ratings, s.avg_rating
from s left join part p on p.p_partkey = s.item""")
def q_lowest_rated_items(spark, sf):
    t = Tables(spark, sf)
    ratings = t.lineitem.select(F.col("l_partkey").alias("item"), F.col("l_quantity").alias("rating"))
    names = t.part.select(F.col("p_partkey").alias("item"), F.col("p_name").alias("name"))
    return jobs.lowest_rated_items(ratings, names)


@register("course_popularity", """
with v as (select distinct o.o_custkey as u, l.l_suppkey as ch
           from lineitem l join orders o on l.l_orderkey = o.o_orderkey),
     cc as (select s_nationkey as course, count(*) as n_ch from supplier group by 1),
     w as (select v.u, s.s_nationkey as course, count(*) as n_w
           from v join supplier s on s.s_suppkey = v.ch group by 1, 2),
     sc as (select w.course,
                   case when cast(n_w as double) / n_ch > 0.9 then 10
                        when cast(n_w as double) / n_ch > 0.5 then 4
                        when cast(n_w as double) / n_ch > 0.25 then 2 else 0 end as score
            from w join cc on w.course = cc.course)
select sc.course as course_id, n.n_name as title, cast(sum(score) as bigint) as score
from sc join nation n on n.n_nationkey = sc.course
group by 1, 2""")
def q_course_popularity(spark, sf):
    t = Tables(spark, sf)
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id"))
    views = (t.lineitem.select("l_orderkey", F.col("l_suppkey").alias("chapter_id"))
             .join(o, "l_orderkey"))
    chapters = t.supplier.select(F.col("s_suppkey").alias("chapter_id"),
                                 F.col("s_nationkey").alias("course_id"))
    titles = t.nation.select(F.col("n_nationkey").alias("course_id"), F.col("n_name").alias("title"))
    return jobs.course_popularity(views, chapters, titles)


@register("log_level_by_month", """
select o_orderpriority as level, monthname(o_orderdate) as month, count(*) as total
from orders group by 1, 2""")
def q_log_level_by_month(spark, sf):
    o = Tables(spark, sf).orders.select(F.col("o_orderpriority").alias("level"),
                                        F.col("o_orderdate").alias("datetime"))
    return jobs.log_level_by_month(o)


@register("exam_stats_pivot", f"""
select c.c_mktsegment as subject,
  {_year_pivot_sql()}
from orders o join customer c on o.o_custkey = c.c_custkey
group by c.c_mktsegment""")
def q_exam_stats_pivot(spark, sf):
    t = Tables(spark, sf)
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("subject"))
    results = (t.orders.select("o_custkey", F.year("o_orderdate").alias("year"),
                               F.col("o_totalprice").alias("score"))
               .join(c, "o_custkey"))
    return jobs.exam_stats_pivot(results)


@register("price_correlation_report", f"""
select 'l_quantity' as feature, {half_up("corr(l_extendedprice, l_quantity)", 6)} as corr
from lineitem
union all select 'l_discount', {half_up("corr(l_extendedprice, l_discount)", 6)} from lineitem
union all select 'l_tax', {half_up("corr(l_extendedprice, l_tax)", 6)} from lineitem""")
def q_price_correlation_report(spark, sf):
    li = Tables(spark, sf).lineitem
    return jobs.price_correlation_report(
        li, "l_extendedprice", drop=("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                     "l_shipdate"), digits=6)



# ---- forms for large inputs -------------------------------------------------------------

@register("bucketed_join", """
select o.o_orderkey, c.c_name, o.o_totalprice
from orders o join customer c on o.o_custkey = c.c_custkey""")
def q_bucketed_join(spark, sf):
    """Both sides stored in buckets of the join key: the join itself moves no rows."""
    t = Tables(spark, sf)
    n, tag = max(1, spark.sparkContext.defaultParallelism), uuid.uuid4().hex[:12]
    o = R.store_bucketed(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), ["o_custkey"], n, f"orders_{tag}")
    c = R.store_bucketed(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name"), ["o_custkey"], n,
                         f"customers_{tag}")
    return R.inner_join(o, c.hint("merge"), "o_custkey").select("o_orderkey", "c_name", "o_totalprice")


@register("sparse_user_items", """
with c as (select user_id, event_type, cast(round(cast(sum(value) as decimal(38, 10)), 2) * 100 as bigint) as cents
           from events group by 1, 2)
select user_id, count(*) as n_items, string_agg(coalesce(event_type, '') || '=' || coalesce(cast(cents as varchar), ''), ',' order by event_type) as items
from c group by 1""")
def q_sparse_user_items(spark, sf):
    """The user-item pivot as sparse rows: a user's items and sums in one sorted list."""
    cells = sparse_pivot(Tables(spark, sf).events, "user_id", "event_type", F.sum("value"))
    text = F.transform("cells", lambda c: F.concat(F.coalesce(c["item"], F.lit("")), F.lit("="), F.coalesce(
        F.round(F.round(c["value"], 2) * 100).cast("long").cast("string"), F.lit(""))))
    return cells.select("user_id", F.size("cells").cast("long").alias("n_items"), F.array_join(text, ",").alias("items"))
