"""Sampling, splitting, pseudonyms."""

from __future__ import annotations

from pyspark.sql import functions as F

from queryset.registry import Tables, query
from vitalgrid.operators.sampling import extend_pseudonyms, pseudonymize, sample_exact, split_by_entity, stratified_sample
from vitalgrid.session import shared_folder

RANKED = """fx_ranked as (
    select patient, label, row_number() over (partition by label order by md5(concat('42-', cast(patient as varchar))), patient) as r,
           row_number() over (order by md5(concat('42-', cast(patient as varchar))), patient) as r_all,
           sum(label) over () as pos, sum(1 - label) over () as neg, count(*) over () as n
    from fx_cohort)"""


@query(
    "smp_stratified",
    "select patient, label from fx_ranked where r <= case when label = 1 then 26 else 174 end",
    "fx_cohort",
    RANKED,
)
def _(t: Tables):
    return stratified_sample(t.cohort(), "patient", "label", 200, 0.13, 42)


@query(
    "smp_backfill",
    """select patient, label from fx_ranked where r <= case when label = 1
         then least(pos, least(500, pos) + greatest(500 - neg, 0)) else least(neg, least(500, neg) + greatest(500 - pos, 0)) end""",
    "fx_cohort",
    RANKED,
)
def _(t: Tables):
    return stratified_sample(t.cohort(), "patient", "label", 1000, 0.5, 42, backfill=True)


@query("smp_exact_n", "select patient from fx_ranked where r_all <= 100", "fx_cohort", RANKED)
def _(t: Tables):
    return sample_exact(t.cohort(), "patient", 100, 42)


@query(
    "sp_split",
    """select visit, a.patient, case when r_all <= floor(n * 0.7::double) then 'train'
              when r_all <= floor(n * 0.7::double) + floor(n * 0.1::double) then 'val' else 'test' end as split
       from fx_admissions a join (select patient, row_number() over (order by md5(concat('42-', cast(patient as varchar))), patient) as r_all, count(*) over () as n
                                  from (select distinct patient from fx_admissions)) using (patient)""",
    "fx_admissions",
)
def _(t: Tables):
    return split_by_entity(t.admissions().select("visit", "patient"), "patient", (0.7, 0.1), 42)


@query(
    "did_pseudonymize",
    """select a.visit, 10000 + m.r as patient from fx_admissions a join
         (select patient, row_number() over (order by md5(concat('42-', cast(patient as varchar))), patient) as r
          from (select distinct patient from fx_admissions)) m on a.patient = m.patient""",
    "fx_admissions",
)
def _(t: Tables):
    return pseudonymize(t.admissions().select("visit", "patient"), "patient", 42).select("visit", F.col("patient"))


@query(
    "did_pseudonym_map",
    """select patient, 10000 + case when old then r else n_old + r end as new_id from (
         select *, row_number() over (partition by old order by md5(concat('42-', cast(patient as varchar))), patient) as r,
                count(*) filter (where old) over () as n_old
         from (select patient, patient in (select patient from fx_admissions) as old from fx_cohort))""",
    "fx_admissions fx_cohort",
)
def _(t: Tables):
    # A second load brings all customers: patients of the first load keep their numbers.
    path = shared_folder(t.spark)
    first = t.admissions().join(t.cohort().select("patient"), "patient", "left_semi")
    extend_pseudonyms(t.spark, path, first, "patient", 42)
    return extend_pseudonyms(t.spark, path, t.cohort(), "patient", 42)
