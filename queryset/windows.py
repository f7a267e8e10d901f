"""Ordered operators: ranks, edges, imputation, blocks, truncation."""

from __future__ import annotations

from pyspark.sql import functions as F

from queryset.registry import ITEMS, Tables, query
from vitalgrid.operators.ordered import (
    block_means, first_row, head_n, impute, last_row, last_visit_first_row, ordinal, position01, truncate_after_last,
)

PV = ["patient", "visit"]


@query(
    "win_head_n",
    "select eid, patient, visit from (select *, row_number() over (partition by patient, visit order by ts, eid) as r from fx_events) where r <= 4",
    "fx_events",
)
def _(t: Tables):
    return head_n(t.events(), PV, ["ts", "eid"], 4).select("eid", *PV)


@query(
    "win_first_row",
    "select patient, visit, outcome from (select *, row_number() over (partition by patient order by admit, visit) as r from fx_admissions) where r = 1",
    "fx_admissions",
)
def _(t: Tables):
    return first_row(t.admissions(), ["patient"], ["admit", "visit"]).select("patient", "visit", "outcome")


@query(
    "win_last_row",
    "select patient, visit, outcome from (select *, row_number() over (partition by patient order by admit desc, visit desc) as r from fx_admissions) where r = 1",
    "fx_admissions",
)
def _(t: Tables):
    return last_row(t.admissions(), ["patient"], ["admit", "visit"]).select("patient", "visit", "outcome")


@query(
    "win_last_visit_first_row",
    """select patient, visit, eid from (select *, row_number() over (partition by patient order by ts, eid) as r from fx_events e
         where visit = (select max(visit) from fx_events m where m.patient = e.patient)) where r = 1""",
    "fx_events",
)
def _(t: Tables):
    rows = t.events().select("patient", "visit", "ts", "eid")
    return last_visit_first_row(rows, "patient", "visit", ["ts", "eid"]).select("patient", "visit", "eid")


@query(
    "win_cum_rank",
    "select visit, row_number() over (partition by patient order by visit) as visit_rank from fx_admissions",
    "fx_admissions",
)
def _(t: Tables):
    return ordinal(t.admissions(), ["patient"], ["visit"], out="visit_rank").select("visit", "visit_rank")


@query(
    "win_position_visit",
    """select patient, visit, round(case when n = 1 then 1.0 else (r - 1) / (n - 1)::double end, 6) as visit_pos from
         (select patient, visit, row_number() over (partition by patient order by visit) as r, count(*) over (partition by patient) as n
          from (select case when visit % 3 = 0 then patient * 1000 + visit else patient end as patient, visit from fx_visits))""",
    "fx_visits",
)
def _(t: Tables):
    # Every third visit is a patient of its own, so that patients with a single visit occur.
    alone = F.when(F.col("visit") % 3 == 0, F.col("patient") * 1000 + F.col("visit")).otherwise(F.col("patient"))
    visits = t.visits().select(alone.alias("patient"), "visit")
    out = position01(visits, ["patient"], ["visit"], "visit_pos")
    return out.select(*PV, F.round("visit_pos", 6).alias("visit_pos"))


@query(
    "win_position_record",
    "select eid, round(case when n_rec = 1 then 1.0 else (record - 1) / (n_rec - 1)::double end, 6) as record_pos from fx_records",
    "fx_records",
)
def _(t: Tables):
    out = position01(t.events(), PV, ["ts", "eid"], "record_pos")
    return out.select("eid", F.round("record_pos", 6).alias("record_pos"))


def _fills(kind: str) -> str:
    up = "over (partition by patient, visit order by record rows between unbounded preceding and current row)"
    all_ = "over (partition by patient, visit order by record rows between current row and unbounded following)"
    cols = []
    for c in ITEMS:
        locf = f"last_value({c} ignore nulls) {up}"
        cols.append(f"{locf} as {c}" if kind == "locf" else f"coalesce({locf}, first_value({c} ignore nulls) {all_}) as {c}")
    return "select patient, visit, record, " + ", ".join(cols) + " from fx_wide"


@query("win_locf", _fills("locf"), "fx_wide")
def _(t: Tables):
    wide = t.wide().drop("outcome")
    return impute(wide, PV, ["record"], ITEMS, backward=False)


@query("win_nocb", _fills("both"), "fx_wide")
def _(t: Tables):
    return impute(t.wide().drop("outcome"), PV, ["record"], ITEMS)


@query("win_nocb_bounded", _fills("both"), "fx_wide")
def _(t: Tables):
    # A visit lies in five days, so it has eleven 12-hour records at most.
    return impute(t.wide().drop("outcome"), PV, ["record"], ITEMS, bound=11)


@query(
    "win_block_mean",
    """select patient, visit, record, round(m, 6) as mean_num from (
         select *, avg(num) over (partition by patient, visit order by record rows between current row and 2 following) as m from fx_records)
       where record + 2 <= n_rec""",
    "fx_records",
)
def _(t: Tables):
    out = block_means(t.records(), PV, "record", ["num"], 3)
    return out.select(*PV, "record", F.round("mean_num", 6).alias("mean_num"))


@query(
    "win_truncate_after_last",
    """select a.patient, a.visit, a.outcome from fx_admissions a
       left join (select patient, max(visit) as last from fx_admissions where outcome = 1 group by 1) l on a.patient = l.patient
       where l.last is null or a.visit <= l.last""",
    "fx_admissions",
)
def _(t: Tables):
    return truncate_after_last(t.admissions(), "patient", "visit", "outcome").select("patient", "visit", "outcome")
