"""Visit facts, the record grid, event windows and pivots."""

from __future__ import annotations

from pyspark.sql import functions as F

from queryset.registry import ITEMS, Tables, query
from vitalgrid.functions.scalars import f_to_c, flag, guard
from vitalgrid.functions.timing import age_anchor, age_birth, as_time, los_days, micros
from vitalgrid.operators.events import (
    events_union, expand_onehot, max_converted, pivot_flags, pivot_items, select_items, sum_of_max,
)
from vitalgrid.operators.visits import gap_days, join_admissions, readmission, visit_ordinal

W = ["patient", "visit", "record"]


@query("fn_los_days", "select visit, round((epoch_us(discharge) - epoch_us(admit)) / 86400000000.0, 2) as los from fx_admissions", "fx_admissions")
def _(t: Tables):
    return t.admissions().select("visit", los_days(F.col("admit"), F.col("discharge")).alias("los"))


@query(
    "fn_age_birth",
    """select visit, cast(case when year(admit) - dob_year >= 300 then 90 else year(admit) - dob_year end as bigint) as age
       from (select *, year(admit) - 20 - patient % 60 - case when patient % 10 = 0 then 300 else 0 end as dob_year from fx_admissions)""",
    "fx_admissions",
)
def _(t: Tables):
    p = F.col("patient")
    year = F.year("admit") - 20 - p % 60 - F.when(p % 10 == 0, 300).otherwise(0)
    dob = F.make_date(year.cast("int"), F.lit(7), F.lit(1))
    return t.admissions().select("visit", age_birth(F.col("admit"), dob).cast("long").alias("age"))


@query(
    "fn_age_anchor",
    """select visit, cast(anchor_age + year(admit) - anchor_year as bigint) as age
       from (select *, case when patient % 11 = 0 then null else 20 + patient % 60 end as anchor_age,
                    case when patient % 13 = 0 then null else 1990 + patient % 5 end as anchor_year from fx_admissions)""",
    "fx_admissions",
)
def _(t: Tables):
    p = F.col("patient")
    age = F.when(p % 11 != 0, 20 + p % 60)
    year = F.when(p % 13 != 0, 1990 + p % 5)
    return t.admissions().select("visit", age_anchor(F.col("admit"), age, year).cast("long").alias("age"))


@query(
    "fn_f_to_c",
    "select eid, round((num - 32.0) * 5.0 / 9.0, 2) as celsius from fx_events",
    "fx_events",
)
def _(t: Tables):
    return t.events().select("eid", f_to_c(F.col("num")).alias("celsius"))


@query(
    "fn_date_parse",
    "select o_orderkey as visit, epoch_us(cast(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as timestamp)) as us from orders",
)
def _(t: Tables):
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return t.read("orders").select(F.col("o_orderkey").alias("visit"), micros(as_time(text)).alias("us"))


@query(
    "fn_time_grid",
    "select patient, visit, record, epoch_us(w0) as start_us from fx_grid",
    "fx_grid",
)
def _(t: Tables):
    return t.grid().select(*W, micros(F.col("record_start")).alias("start_us"))


@query(
    "win_row_number",
    "select patient, visit, row_number() over (partition by patient, visit order by w0) as record, epoch_us(w0) as start_us from fx_grid",
    "fx_grid",
)
def _(t: Tables):
    from vitalgrid.operators.ordered import ordinal

    starts = t.grid().drop("record")
    ranked = ordinal(starts, ["patient", "visit"], ["record_start"], out="record")
    return ranked.select(*W, micros(F.col("record_start")).alias("start_us"))


@query(
    "jn_window_range",
    "select patient, visit, record, item, num, txt from fx_hits",
    "fx_hits",
)
def _(t: Tables):
    return t.hits().select(*W, "item", "num", "txt")


@query(
    "agg_pivot_max",
    "select patient, visit, record, view, click, purchase, error, signup from fx_wide",
    "fx_wide",
)
def _(t: Tables):
    return t.wide().select(*W, *ITEMS)


@query(
    "agg_pivot_onehot",
    """select patient, visit, record,
              cast(max(case when item='view' and num > 100 then 1 else 0 end) as bigint) as high_view,
              cast(max(case when item='error' and lower(txt) like '%9}' then 1 else 0 end) as bigint) as error_nine,
              cast(max(case when item in ('click','signup') then 1 else 0 end) as bigint) as touched
       from fx_hits group by 1,2,3""",
    "fx_hits",
)
def _(t: Tables):
    item = F.col("item")
    spec = {
        "high_view": (item == "view") & (F.col("num") > 100),
        "error_nine": (item == "error") & F.lower("txt").endswith("9}"),
        "touched": item.isin("click", "signup"),
    }
    seen = pivot_flags(t.placed(), W, spec)
    return t.grid().select(*W).join(seen, W, "left").select(*W, *[flag(F.col(c) == 1).cast("long").alias(c) for c in spec])


@query(
    "agg_unit_convert_max",
    """select patient, visit, record,
              max(case when item in ('view','click') and num between 30 and 45 then round(num, 2)
                       when item in ('error','signup') and (num - 32) * 5.0 / 9.0 between 30 and 45
                       then round((num - 32) * 5.0 / 9.0, 2) end) as guarded,
              max(case when item in ('view','click') then num
                       when item in ('error','signup') then round((num - 32) * 5.0 / 9.0, 2) end) as plain
       from fx_hits group by 1,2,3""",
    "fx_hits",
)
def _(t: Tables):
    spec = {
        "guarded": max_converted("item", "num", ["view", "click"], ["error", "signup"], (30.0, 45.0)),
        "plain": max_converted("item", "num", ["view", "click"], ["error", "signup"]),
    }
    return t.grid().select(*W).join(pivot_items(t.placed(), W, spec), W, "left")


@query(
    "agg_sum_of_max",
    """select patient, visit, record, total,
              cast(case when total = 3 then 1 else 0 end as bigint) as total_3, cast(case when total = 7 then 1 else 0 end as bigint) as total_7,
              cast(case when total = 15 then 1 else 0 end as bigint) as total_15
       from (select patient, visit, record,
                    max(case when item='view' then floor(num) % 4 + 1 end) + max(case when item='click' then floor(num) % 5 + 1 end)
                    + max(case when item='error' then floor(num) % 6 + 1 end) as total
             from fx_hits group by 1,2,3)""",
    "fx_hits",
)
def _(t: Tables):
    levels = F.create_map(F.lit("view"), F.lit(4), F.lit("click"), F.lit(5), F.lit("error"), F.lit(6))
    coded = t.placed().withColumn("num", (F.floor("num") % F.try_element_at(levels, F.col("item")) + 1).cast("double"))
    total = pivot_items(coded, W, {"total": sum_of_max("item", "num", ["view", "click", "error"])})
    wide = t.grid().select(*W).join(total, W, "left")
    onehot = {k: c.cast("long") for k, c in expand_onehot(F.col("total"), [3, 7, 15], "total_").items()}
    return wide.withColumns(onehot)


@query(
    "flt_in_list_not_null",
    "select eid, item, num from fx_events where item in ('view','error') and (num is not null or txt is not null)",
    "fx_events",
)
def _(t: Tables):
    return select_items(t.events(), "item", ["view", "error"], ["num", "txt"]).select("eid", "item", "num")


@query(
    "flt_range_guard",
    "select eid, case when num between 30 and 45 then num end as num from fx_events",
    "fx_events",
)
def _(t: Tables):
    return t.events().select("eid", guard(F.col("num"), 30, 45).alias("num"))


@query(
    "set_union_all",
    """select eid, item, num, txt from fx_events where item in ('view','click','signup')
       union all select eid, item, num, null from fx_events where item in ('error','purchase')""",
    "fx_events",
)
def _(t: Tables):
    chart = t.events().where(F.col("item").isin("view", "click", "signup")).select("eid", "item", "num", "txt")
    labs = t.events().where(F.col("item").isin("error", "purchase")).select("eid", "item", "num")
    return events_union(chart, labs)


@query(
    "win_lead_readmit",
    """select visit, cast(case when lead(admit) over (partition by patient order by admit, visit) <= discharge + interval '30' day
                          then 1 else 0 end as bigint) as readmission from fx_admissions""",
    "fx_admissions",
)
def _(t: Tables):
    out = readmission(t.admissions(), "patient", "visit", "admit", "discharge")
    return out.select("visit", F.col("readmission").cast("long").alias("readmission"))


@query(
    "win_lag_gap",
    """select visit, cast(floor((epoch_us(admit) - epoch_us(lag(discharge) over (partition by patient order by admit, visit)))
                          / 86400000000.0) as bigint) as gap_days from fx_admissions""",
    "fx_admissions",
)
def _(t: Tables):
    return gap_days(t.admissions(), "patient", "visit", "admit", "discharge").select("visit", "gap_days")


@query(
    "win_dense_rank",
    "select visit, dense_rank() over (partition by patient order by admit) as visit_id from fx_admissions",
    "fx_admissions",
)
def _(t: Tables):
    from vitalgrid.operators.ordered import ordinal

    return ordinal(t.admissions(), ["patient"], ["admit"], "dense_rank", "visit_id").select("visit", "visit_id")


def _hot(rows) -> int:
    """A bound that makes every kind of event a large group, at any size of the table."""
    return max(2, rows.count() // 8)


@query("win_dense_rank_hot", "select eid, dense_rank() over (partition by item order by ts) as place from fx_events", "fx_events")
def _(t: Tables):
    from vitalgrid.operators.ordered import ordinal

    rows = t.events().select("item", "ts", "eid")
    return ordinal(rows, ["item"], ["ts"], "dense_rank", "place", hot_rows=_hot(rows)).select("eid", "place")


@query("win_lag_hot", "select eid, lag(num) over (partition by item order by ts, eid) as before from fx_events", "fx_events")
def _(t: Tables):
    from vitalgrid.operators.ordered import neighbour

    rows = t.events().select("item", "ts", "eid", "num")
    return neighbour(rows, ["item"], ["ts", "eid"], {"before": "num"}, "lag", hot_rows=_hot(rows)).select("eid", "before")


@query(
    "win_running_sum_hot",
    """select eid, coalesce(sum(eid) over (partition by item order by ts, eid rows between unbounded preceding and 1 preceding), 0)::bigint as before,
              (sum(eid) over (partition by item))::bigint as total from fx_events""",
    "fx_events",
)
def _(t: Tables):
    from vitalgrid.operators.ordered import prefix_sums

    rows = t.events().select("item", "ts", "eid")
    out = prefix_sums(rows, ["item"], ["ts", "eid"], {"s": F.col("eid")}, totals=["s"], hot_rows=_hot(rows))
    return out.select("eid", F.col("s").alias("before"), F.col("s_total").alias("total"))


@query(
    "win_nocb_hot",
    """select eid, coalesce(last_value(v ignore nulls) over (partition by item order by ts, eid rows between unbounded preceding and current row),
                            first_value(v ignore nulls) over (partition by item order by ts, eid rows between current row and unbounded following)) as v
       from (select *, case when eid % 5 = 3 then num end as v from fx_events)""",
    "fx_events",
)
def _(t: Tables):
    from vitalgrid.operators.ordered import impute

    rows = t.events().select("item", "ts", "eid", F.when(F.col("eid") % 5 == 3, F.col("num")).alias("v"))
    return impute(rows, ["item"], ["ts", "eid"], ["v"], hot_rows=_hot(rows)).select("eid", "v")


@query(
    "did_visit_ordinal",
    """select a.visit, count(distinct b.admit) as visit_id from fx_admissions a
       join fx_admissions b on a.patient = b.patient and b.admit <= a.admit group by a.visit""",
    "fx_admissions",
)
def _(t: Tables):
    return visit_ordinal(t.admissions(), "patient", "admit").select("visit", "visit_id")


@query(
    "jn_inner",
    """select a.visit, a.patient, c.label from fx_admissions a join fx_cohort c on a.patient = c.patient""",
    "fx_admissions fx_cohort",
)
def _(t: Tables):
    return join_admissions(t.cohort(), t.admissions(), "patient").select("visit", "patient", "label")
