"""Projections, filters, joins, aggregations, lists and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from queryset.registry import ITEMS, Tables, query
from vitalgrid.functions.scalars import flag
from vitalgrid.operators import joins as J
from vitalgrid.operators.encode import min_max
from vitalgrid.operators.lists import list_parts, top_items, top_pairs, visit_lists
from vitalgrid.operators.metrics import pos_weight, regression_metrics
from vitalgrid.operators.narrative import drop_leaks, limit_tokens
from vitalgrid.operators.ordered import first_values
from vitalgrid.operators.profile import cohort_profile, deceased, distinct_counts, nested_means, task_balance
from vitalgrid.operators.sampling import split_by_entity
from vitalgrid.session import shared_folder
from vitalgrid.sources.tables import save_table

PV = ["patient", "visit"]

# SQL for the joined lists of the code fixture, in line order.
LISTS = """fx_lists as (
    select patient, visit, string_agg(code, ';' order by seq, code, title) as codes, string_agg(title, ';' order by seq, code, title) as titles
    from fx_items group by 1,2)"""


def lists(t: Tables):
    return visit_lists(t.items(), PV, {"codes": "code", "titles": "title"}, ["seq", "code", "title"])


@query(
    "prj_select_rename",
    """select patient as "PatientID", visit as "VisitID", record as "RecordTime", view as "Heart Rate", click as "PH" from fx_wide""",
    "fx_wide",
)
def _(t: Tables):
    names = {"patient": "PatientID", "visit": "VisitID", "record": "RecordTime", "view": "Heart Rate", "click": "PH"}
    return J.to_wide_names(t.wide(), names)


@query("prj_drop", "select patient, visit, ts, num, eid from fx_events", "fx_events")
def _(t: Tables):
    return J.drop_if_present(t.events(), ["txt", "item", "not_there"])


@query(
    "prj_ablate",
    "select vec_id as visit, " + ", ".join(f'round(embedding[{i + 1}]::double, 6) as "D{i}"' for i in range(48, 64)) + " from embeddings",
)
def _(t: Tables):
    # The first 48 columns are the family to drop, 16 stay.
    kept = J.drop_features(J.expand(t.series(), "series", "D", 64), "D", 48)
    return kept.select("visit", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in kept.columns[1:]])


@query(
    "prj_case_flag",
    """select c_custkey, cast(case when lower(c_mktsegment) = 'building' then 1 else 0 end as bigint) as is_building,
              cast(case when nullif(c_nationkey, 3) is not null then 1 else 0 end as bigint) as has_nation from customer""",
)
def _(t: Tables):
    building = flag(F.lower("c_mktsegment") == "building").cast("long")
    nation = flag(F.nullif("c_nationkey", F.lit(3)).isNotNull()).cast("long")
    return t.read("customer").select("c_custkey", building.alias("is_building"), nation.alias("has_nation"))


@query(
    "prj_first_record_only",
    """select patient, visit, record, case when record = 1 then txt end as txt
       from (select g.patient, g.visit, g.record, t.txt from fx_grid g
             join (select patient, visit, max(txt) as txt from fx_events group by 1,2) t
               on g.patient = t.patient and g.visit = t.visit)""",
    "fx_grid fx_events",
)
def _(t: Tables):
    texts = t.events().groupBy(*PV).agg(F.max("txt").alias("txt"))
    rows = J.attach(t.grid().select(*PV, "record"), texts, PV)
    return J.only_first_record(rows, "record", ["txt"])


@query(
    "flt_group_size",
    "select eid, patient, visit from (select *, count(*) over (partition by patient, visit) as n from fx_events) where n >= 12",
    "fx_events",
)
def _(t: Tables):
    return J.filter_group_size(t.events(), PV, 12).select("eid", *PV)


@query(
    "flt_text_leak",
    """select patient, length(answer) as n from fx_answers
       where answer is not null and regexp_matches(answer, '\\S') and not (lower(answer) like '%is 1%' or lower(answer) like '%is 0%')""",
    "fx_answers",
)
def _(t: Tables):
    kept, _ = drop_leaks(t.answers(), "answer")
    return kept.select("patient", F.char_length("answer").cast("long").alias("n"))


@query(
    "flt_text_leak_counts",
    """select count(*) filter (where not leak) as kept, count(*) filter (where leak) as dropped
       from (select lower(answer) like '%is 1%' or lower(answer) like '%is 0%' as leak from fx_answers)""",
    "fx_answers",
)
def _(t: Tables):
    # The filter's own counts, filled by the run that writes the kept texts.
    kept, seen = drop_leaks(t.answers(), "answer")
    save_table(kept, shared_folder(t.spark))
    return t.spark.createDataFrame([(seen.get["kept"], seen.get["dropped"])], "kept long, dropped long")


@query(
    "flt_code_version",
    """select i.patient, i.visit, i.seq, i.code, p.p_type from fx_items i
       join part p on i.code = p.p_brand and i.title = p.p_name and i.version = p.p_size
       where i.version = 9 and p.p_size = 9""",
    "fx_items",
)
def _(t: Tables):
    codes = J.code_version(t.items(), "version", 9)
    names = J.code_version(
        t.read("part").select(
            F.col("p_brand").alias("code"), F.col("p_name").alias("title"), F.col("p_size").alias("version"), "p_type"
        ), "version", 9,
    )
    return J.join_dictionary(codes, names, ["code", "title", "version"]).select(*PV, "seq", "code", "p_type")


@query(
    "flt_length_budget",
    """select doc_id, 'drop' as mode, md5(text) as kept from documents
       where len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) <= 120
       union all
       select doc_id, 'tail', md5(case when len(w) > 120 then array_to_string(w[-120:], '') else text end)
       from (select doc_id, text, regexp_extract_all(text, '\\S+\\s*') as w from documents)""",
)
def _(t: Tables):
    docs = t.read("documents").select("doc_id", "text")
    parts = []
    for mode in ("drop", "tail"):
        out = limit_tokens(docs, "text", 120, mode)
        parts.append(out.select("doc_id", F.lit(mode).alias("mode"), F.md5(F.col("text")).alias("kept")))
    return J.union_parts(*parts)


@query(
    "jn_left_multi",
    """select a.patient, a.visit, l.codes, m.best, n.worst from fx_admissions a
       left join fx_lists l on a.patient = l.patient and a.visit = l.visit
       left join (select patient, visit, max(title) as best from fx_items where version < 20 group by 1,2) m
         on a.patient = m.patient and a.visit = m.visit
       left join (select patient, visit, min(title) as worst from fx_items where version > 30 group by 1,2) n
         on a.patient = n.patient and a.visit = n.visit""",
    "fx_admissions fx_items",
    LISTS,
)
def _(t: Tables):
    items = t.items()
    best = items.where("version < 20").groupBy(*PV).agg(F.max("title").alias("best"))
    worst = items.where("version > 30").groupBy(*PV).agg(F.min("title").alias("worst"))
    out = J.assemble(t.admissions().select(*PV), lists(t).drop("titles"), best, worst, keys=PV)
    return out.select(*PV, "codes", "best", "worst")


@query(
    "jn_left_features",
    """select e.eid, v.n_events, v.outcome from fx_events e left join fx_visits v
       on e.patient = v.patient and e.visit = v.visit and v.n_events > 10""",
    "fx_events fx_visits",
)
def _(t: Tables):
    # Every visit stays; those with few events get a key that no event has.
    visit = F.when(F.col("n_events") > 10, F.col("visit")).otherwise(-1 - F.col("visit"))
    feats = t.visits().withColumn("visit", visit).select(*PV, "n_events", "outcome")
    return J.attach(t.events().select("eid", *PV), feats, PV).select("eid", "n_events", "outcome")


@query(
    "jn_rank_align",
    """select l.patient, l.visit, l.r as visit_rank, r.total from
         (select patient, visit, row_number() over (partition by patient order by admit, visit) as r from fx_admissions) l
         left join (select o_custkey as patient, o_totalprice as total,
                           row_number() over (partition by o_custkey, o_orderstatus = 'F' order by o_orderkey) as r,
                           o_orderstatus = 'F' as off from orders) r
         on l.patient = r.patient and l.r = r.r and not r.off""",
    "fx_admissions",
)
def _(t: Tables):
    left = t.admissions().select("patient", "visit", "admit")
    # Orders of one status belong to patients that nothing meets.
    owner = F.when(F.col("o_orderstatus") == "F", -1 - F.col("o_custkey")).otherwise(F.col("o_custkey"))
    right = t.read("orders").select(
        owner.alias("patient"), F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("total")
    )
    out = J.rank_align(left, right, "patient", ["admit", "visit"], ["k"])
    return out.select("patient", "visit", "visit_rank", "total")


@query(
    "jn_semi",
    "select visit, patient from fx_admissions where patient in (select patient from fx_cohort where label = 1)",
    "fx_admissions fx_cohort",
)
def _(t: Tables):
    return J.keep_ids(t.admissions(), t.cohort().where("label = 1"), "patient").select("visit", "patient")


@query(
    "jn_resume",
    "select patient, turn, role from fx_chat where patient not in (select doc_id from documents where lang <> 'en')",
    "fx_chat",
)
def _(t: Tables):
    done = t.read("documents").where("lang <> 'en'").select(F.col("doc_id").alias("patient"))
    return J.not_done(t.chat(), done, "patient").select("patient", "turn", "role")


@query(
    "jn_complement",
    """select patient from (select patient, row_number() over (order by md5(concat('42-', cast(patient as varchar))), patient) as r,
                                   count(*) over () as n from fx_cohort)
       where r > floor(n * 0.7::double) + floor(n * 0.1::double)""",
    "fx_cohort",
)
def _(t: Tables):
    return J.split_frames(split_by_entity(t.cohort(), "patient", (0.7, 0.1), 42), "split")["test"].select("patient")


@query(
    "jn_answers",
    """select c.patient, c.turns, md5(a.answer) as answer from
         (select patient, count(*) as turns from fx_chat group by 1) c
         join (select patient, answer from fx_answers union all select doc_id, 'again' from labels where quality = 1) a
           on c.patient = a.patient""",
    "fx_chat fx_answers",
)
def _(t: Tables):
    context = t.chat().groupBy("patient").agg(F.count(F.lit(1)).alias("turns"))
    answers = t.answers()
    again = t.read("labels").where("quality = 1").select(F.col("doc_id").alias("patient"), F.lit("again").alias("answer"))
    out = J.join_answers(context, answers.union(again), "patient")
    return out.select("patient", "turns", F.md5(F.col("answer")).alias("answer"))


@query(
    "jn_scores",
    "select patient, round(p1, 6) as p1, p2 from fx_scores",
    "fx_scores",
)
def _(t: Tables):
    a, b = t.scores().select("patient", "p1"), t.scores().select("patient", "p2")
    return J.pair_scores(a, b, "patient").select("patient", F.round("p1", 6).alias("p1"), "p2")


@query(
    "agg_string_list",
    "select patient, visit, codes, titles from fx_lists",
    "fx_items",
    LISTS,
)
def _(t: Tables):
    return lists(t)


@query(
    "agg_string_list_parts",
    """select patient, visit, (seq_no - 1) // 3 as part, string_agg(code, ';' order by seq_no) as codes
       from (select *, row_number() over (partition by patient, visit order by seq, code, title) as seq_no from fx_items) group by 1,2,3""",
    "fx_items",
)
def _(t: Tables):
    return list_parts(t.items(), PV, {"codes": "code"}, ["seq", "code", "title"], part_size=3)


@query(
    "agg_patient_label",
    "select visit, max(outcome) over (partition by patient) as outcome from fx_admissions",
    "fx_admissions",
)
def _(t: Tables):
    return J.patient_label(t.admissions(), "patient", "outcome").select("visit", "outcome")


@query(
    "agg_visit_label",
    "select patient, visit, max(outcome) as outcome, round(avg(num), 6) as num from fx_hits group by 1,2",
    "fx_hits",
)
def _(t: Tables):
    rows = t.hits()
    out = J.visit_label(rows, PV, {"outcome": "max", "num": "avg"})
    return out.select(*PV, "outcome", F.round("num", 6).alias("num"))


@query(
    "agg_first_non_null",
    """select patient, visit, """
    + ", ".join(f"arg_min({c}, record) filter (where {c} is not null) as {c}" for c in ITEMS)
    + " from fx_wide group by 1,2",
    "fx_wide",
)
def _(t: Tables):
    return first_values(t.wide(), PV, ["record"], ITEMS)


@query(
    "agg_distinct_count",
    """select count(*) as n_rows, count(distinct patient) as patients, count(distinct patient * 100 + visit) as visits,
              round(count(distinct patient * 100 + visit) / count(distinct patient)::double, 6) as visits_per_patient from fx_events""",
    "fx_events",
)
def _(t: Tables):
    out = distinct_counts(t.events(), "patient", "visit")
    return out.withColumn("visits_per_patient", F.round("visits_per_patient", 6))


@query(
    "agg_nested_mean",
    """select round(avg(view), 6) as mean_view, round(avg(purchase), 6) as mean_purchase, round(avg(rpv), 6) as records_per_visit from
         (select patient, avg(view) as view, avg(purchase) as purchase, sum(n)::double / count(*) as rpv from
            (select patient, visit, arg_min(view, record) filter (where view is not null) as view,
                    arg_min(purchase, record) filter (where purchase is not null) as purchase, count(*) as n from fx_wide group by 1,2)
          group by 1)""",
    "fx_wide",
)
def _(t: Tables):
    out = nested_means(t.wide(), "patient", "visit", ["record"], ["view", "purchase"])
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query(
    "agg_min_max_profile",
    "select min(view) as min_view, max(view) as max_view, min(error) as min_error, max(error) as max_error, "
    "cast(null as double) as min_absent, cast(null as double) as max_absent from fx_wide",
    "fx_wide",
)
def _(t: Tables):
    return min_max(t.wide(), ["view", "error", "absent"])


BALANCE = """fx_split as (
    select e.*, v.outcome, case when v.n_events >= 12 then 1 else 0 end as busy,
           case when r <= floor(n * 0.7::double) then 'train' when r <= floor(n * 0.7::double) + floor(n * 0.1::double) then 'val' else 'test' end as split
    from fx_events e join fx_visits v on e.patient = v.patient and e.visit = v.visit
    join (select patient, row_number() over (order by md5(concat('42-', cast(patient as varchar))), patient) as r, count(*) over () as n
          from (select distinct patient from fx_events)) s on s.patient = e.patient)"""


@query(
    "agg_task_balance",
    """select v.split, v.task, n_rows, patients, round(visits / patients::double, 6) as visits_per_patient, visit_pos, visit_neg,
              round(visit_pos / (visit_pos + visit_neg)::double, 6) as visit_share, patient_pos, patient_neg,
              round(patient_pos / (patient_pos + patient_neg)::double, 6) as patient_share
       from (select split, task, cast(sum(n) as bigint) as n_rows, count(*) as visits, count(*) filter (where y > 0) as visit_pos, count(*) filter (where y = 0) as visit_neg
             from (select split, 'outcome' as task, patient, visit, max(outcome) as y, count(*) as n from fx_split group by all
                   union all select split, 'busy', patient, visit, max(busy), count(*) from fx_split group by all) group by 1,2) v
       join (select split, task, count(*) as patients, count(*) filter (where y > 0) as patient_pos, count(*) filter (where y = 0) as patient_neg
             from (select split, 'outcome' as task, patient, max(outcome) as y from fx_split group by all
                   union all select split, 'busy', patient, max(busy) from fx_split group by all) group by 1,2) p
         on v.split = p.split and v.task = p.task""",
    "fx_events fx_visits",
    BALANCE,
)
def _(t: Tables):
    facts = t.visits().select(*PV, "outcome", flag(F.col("n_events") >= 12).cast("long").alias("busy"))
    rows = split_by_entity(J.attach(t.events(), facts, PV), "patient", (0.7, 0.1), 42)
    out = task_balance(rows, "split", "patient", "visit", ["outcome", "busy"])
    shares = ["visits_per_patient", "visit_share", "patient_share"]
    return out.withColumns({c: F.round(c, 6) for c in shares})


@query(
    "agg_cohort_profile",
    """select count(*) as patients, cast(sum(o) as bigint) as dead, cast(count(*) - sum(o) as bigint) as alive, round(sum(o) / count(*)::double, 6) as mortality,
              round(avg(nv), 6) as visits_per_patient, round(avg(nr / nv::double), 6) as records_per_visit,
              round(avg(los), 6) as mean_los, round(avg(re), 6) as mean_readmission
       from (select patient, max(outcome) as o, count(*) as nv, sum(n) as nr, avg(los) as los, avg(re) as re from
               (select patient, visit, max(outcome) as outcome, count(*) as n, arg_min(view, record) filter (where view is not null) as los,
                       arg_min(click, record) filter (where click is not null) as re from fx_wide group by 1,2) group by 1)""",
    "fx_wide",
)
def _(t: Tables):
    out = cohort_profile(t.wide(), "patient", "visit", ["record"], "outcome", "view", "click")
    rounded = ["mortality", "visits_per_patient", "records_per_visit", "mean_los", "mean_readmission"]
    return out.withColumns({c: F.round(c, 6) for c in rounded})


@query(
    "agg_class_weight",
    "select round(1 / avg(y) - 1, 6) as weight_y, round(1 / avg(case when p2 > 0.5 then 1 else 0 end) - 1, 6) as weight_z from fx_scores",
    "fx_scores",
)
def _(t: Tables):
    rows = t.scores().withColumn("z", flag(F.col("p2") > 0.5))
    out = pos_weight(rows, ["y", "z"])
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query(
    "agg_regression_metrics",
    """select round(avg(abs(l_quantity - l_discount)), 6) as mae, round(sqrt(avg((l_quantity - l_discount) * (l_quantity - l_discount))), 6) as rmse,
              round(avg(case when abs(l_quantity - l_discount) <= 5.25 then 1 else 0 end), 6) as within from lineitem""",
)
def _(t: Tables):
    out = regression_metrics(t.read("lineitem"), "l_quantity", "l_discount", 5.25)
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("set_distinct", "select distinct patient, visit from fx_events", "fx_events")
def _(t: Tables):
    return J.distinct_keys(t.events(), PV)


@query(
    "set_concat",
    "select patient, label from fx_cohort where label = 1 union all select patient, label from fx_cohort where label = 0",
    "fx_cohort",
)
def _(t: Tables):
    return J.union_parts(t.cohort().where("label = 1"), t.cohort().where("label = 0"))


@query(
    "topk_pairs",
    "select title, code, count(*) as n from fx_items group by 1,2 order by n desc, title, code limit 10",
    "fx_items",
)
def _(t: Tables):
    return top_pairs(lists(t), "titles", "codes", 10)


@query("topk_items", "select title as item, count(*) as n from fx_items group by 1 order by n desc, item limit 10", "fx_items")
def _(t: Tables):
    return top_items(lists(t), "titles", 10)


@query(
    "topk_deceased",
    """select title, code, count(*) as n from fx_items
       where patient in (select patient from fx_admissions where outcome = 1) group by 1,2 order by n desc, title, code limit 10""",
    "fx_items fx_admissions",
)
def _(t: Tables):
    dead = deceased(t.admissions(), "patient", "outcome")
    return top_pairs(J.keep_ids(lists(t), dead, "patient"), "titles", "codes", 10)


@query(
    "srt_within_group",
    "select patient, visit, string_agg(cast(eid as varchar), ',' order by ts, eid) as ids from fx_events group by 1,2",
    "fx_events",
)
def _(t: Tables):
    rows = t.events().withColumn("id", F.col("eid").cast("string"))
    return visit_lists(rows, PV, {"ids": "id"}, ["ts", "eid"], sep=",")
