"""Abnormality scores, scaling and model sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from queryset.registry import Tables, query
from queryset.scalars import BANDS, BANDS_SQL
from vitalgrid.functions.scalars import band_score, row_mean
from vitalgrid.operators.encode import label_for_task, min_max, minmax_apply, pad_mask, sequence_segments, sequences
from vitalgrid.operators.joins import split_frames
from vitalgrid.operators.ordered import block_means
from vitalgrid.operators.sampling import split_by_entity
from vitalgrid.operators.scoring import multi_scale_scores, pooled_scores

PV = ["patient", "visit"]
SCALES = (3, 5, "full")

FEATS = f"""fx_feats as (
    select patient, visit, record, n_rec, {BANDS_SQL} as f1,
           case when eid % 4 <> 0 then cast(eid % 3 as double) end as f2,
           case when eid % 5 <> 0 then cast(3 + eid % 13 as double) end as gcs
    from fx_records)"""
SERIES = FEATS + """,
fx_blocks as (
    select r.patient, r.visit, s.scale_no, r.record as start, coalesce(s.len, r.n_rec) as len
    from fx_records r, (values (0, 3), (1, 5), (2, null)) s(scale_no, len)
    where r.record + coalesce(s.len, r.n_rec) - 1 <= r.n_rec),
fx_tas as (
    select *, row_number() over (partition by patient, visit order by scale_no, start) - 1 as pos,
           count(*) over (partition by patient, visit) as n_scores
    from (select b.patient, b.visit, b.scale_no, b.start,
                 (coalesce(avg(gcs), 0) * 4 / 15 + coalesce(list_avg([avg(f1), avg(f2)]), 0)) / 8 as score
          from fx_blocks b join fx_feats f
            on b.patient = f.patient and b.visit = f.visit and f.record between b.start and b.start + b.len - 1
          group by all))"""


def feats(t: Tables):
    eid = F.col("eid")
    return t.records().select(
        *PV, "record", "n_rec",
        band_score(F.col("num"), BANDS).alias("f1"),
        F.when(eid % 4 != 0, (eid % 3).cast("double")).alias("f2"),
        F.when(eid % 5 != 0, (3 + eid % 13).cast("double")).alias("gcs"),
    )


@query(
    "tas_visit_scores",
    "select patient, visit, cast(scale_no as bigint) as scale_no, start, pos, n_scores, round(score, 10) as score from fx_tas",
    "fx_records",
    SERIES,
)
def _(t: Tables):
    out = multi_scale_scores(feats(t), PV, "record", "n_rec", ["f1", "f2"], "gcs", SCALES)
    return out.withColumns({"score": F.round("score", 10), "scale_no": F.col("scale_no").cast("long")})


@query(
    "tas_feature_mean",
    """select patient, visit, record, round(coalesce(list_avg([a, b]), 0), 10) as mean from (
         select patient, visit, record, n_rec, avg(f1) over w as a, avg(f2) over w as b from fx_feats
         window w as (partition by patient, visit order by record rows between current row and 4 following)) where record + 4 <= n_rec""",
    "fx_records",
    FEATS,
)
def _(t: Tables):
    means = block_means(feats(t), PV, "record", ["f1", "f2"], 5)
    mean = row_mean([F.col("mean_f1"), F.col("mean_f2")])
    return means.select(*PV, "record", F.round(mean, 10).alias("mean"))


POINTS = [f"D{i}" for i in range(12)]


@query(
    "tas_pooled",
    """select patient, visit, """
    + ", ".join(f'round(max(case when i = {i} then v end), 10) as "D{i}"' for i in range(12))
    + """ from (
         select patient, visit, i, s[lo + 1] * (1 - (x - lo)) + s[least(lo + 1, n - 1) + 1] * (x - lo) as v from (
           select *, floor(x)::bigint as lo from (
             select patient, visit, s, len(s) as n, i, i * (len(s) - 1) / 11.0::double as x from
               (select patient, visit, list(score order by pos) as s from fx_tas group by 1,2), range(12) r(i)))) group by 1,2""",
    "fx_records",
    SERIES,
)
def _(t: Tables):
    out = pooled_scores(feats(t), PV, "record", "n_rec", ["f1", "f2"], "gcs", SCALES, 12)
    return out.select(*PV, *[F.round(c, 10).alias(c) for c in POINTS])


FIT = """fx_fit as (
    select min(least(greatest(view, 15), 60)) as v0, max(least(greatest(view, 15), 60)) as v1,
           min(least(greatest(error, 15), 60)) as e0, max(least(greatest(error, 15), 60)) as e1
    from fx_wide where patient in (
        select patient from (select patient, row_number() over (order by md5(concat('42-', cast(patient as varchar))), patient) as r, count(*) over () as n
                             from (select distinct patient from fx_wide)) where r <= floor(n * 0.7::double)))"""


def fitted(t: Tables):
    train = split_frames(split_by_entity(t.wide(), "patient", (0.7, 0.1), 42), "split")["train"].withColumn("flat", F.lit(4.0))
    return min_max(train, ["view", "error", "flat"], (15, 60))


@query(
    "nrm_fit",
    "select v0 as min_view, v1 as max_view, e0 as min_error, e1 as max_error, 15.0::double as min_flat, 15.0::double as max_flat from fx_fit",
    "fx_wide",
    FIT,
)
def _(t: Tables):
    return fitted(t)


@query(
    "nrm_apply",
    """select patient, visit, record, round(case when view is null then 0 when view < 15 or view > 60 then 1 else (view - v0) / (v1 - v0) end, 6) as view,
              round(case when error is null then 0 when error < 15 or error > 60 then 1 else (error - e0) / (e1 - e0) end, 6) as error,
              1.0::double as flat from fx_wide, fx_fit""",
    "fx_wide",
    FIT,
)
def _(t: Tables):
    rows = t.wide().withColumn("flat", F.lit(4.0))
    out = minmax_apply(rows, fitted(t), ["view", "error", "flat"], (15, 60))
    return out.select(*PV, "record", *[F.round(c, 6).alias(c) for c in ("view", "error", "flat")])


def _shown(steps: str):
    return F.transform(
        steps,
        lambda x: F.concat_ws(":", F.round(x[0] * 100).cast("long").cast("string"), x[1].cast("long").cast("string")),
    )


@query(
    "seq_build",
    """select patient, count(*) as length,
              string_agg(concat(cast(round(num * 100) as bigint), ':', eid % 7), ',' order by ts, eid) as steps
       from fx_events group by 1""",
    "fx_events",
)
def _(t: Tables):
    # The feature columns are named so that sorted order is (a, b).
    rows = t.events().select("patient", "ts", "eid", F.col("num").alias("a"), (F.col("eid") % 7).alias("b"))
    out = sequences(rows, "patient", ["ts", "eid"], ["b", "a"])
    return out.select("patient", F.col("length").cast("long").alias("length"), F.array_join(_shown("steps"), ",").alias("steps"))


@query(
    "seq_segments",
    """select patient, (r - 1) // 16 as segment, count(*) as length, max(n) as total_length,
              string_agg(concat(cast(round(num * 100) as bigint), ':', eid % 7), ',' order by r) as steps
       from (select *, row_number() over (partition by patient order by ts, eid) as r, count(*) over (partition by patient) as n from fx_events)
       group by 1, 2""",
    "fx_events",
)
def _(t: Tables):
    rows = t.events().select("patient", "ts", "eid", F.col("num").alias("a"), (F.col("eid") % 7).alias("b"))
    out = sequence_segments(rows, "patient", ["ts", "eid"], ["b", "a"], segment=16)
    return out.select(
        "patient", "segment", F.col("length").cast("long").alias("length"), "total_length",
        F.array_join(_shown("steps"), ",").alias("steps"),
    )


@query(
    "seq_pad_mask",
    """select patient, visit, n as n_true, max(n) over () - n as n_pad, total from
         (select patient, visit, count(*) as n, cast(sum(round(num * 100)) as bigint) as total from fx_events group by 1,2)""",
    "fx_events",
)
def _(t: Tables):
    rows = t.events().withColumn("pv", F.col("patient") * 100 + F.col("visit"))
    seq = sequences(rows, "pv", ["ts", "eid"], ["num"])
    out = pad_mask(seq, "steps", 1)
    empty = F.filter(F.arrays_zip("steps", "mask"), lambda z: ~z["mask"] & (z["steps"][0] == 0))
    total = F.aggregate("steps", F.lit(0).cast("long"), lambda a, x: a + F.round(x[0].cast("double") * 100).cast("long"))
    return out.select(
        F.floor(F.col("pv") / 100).alias("patient"), (F.col("pv") % 100).alias("visit"),
        F.size(F.filter("mask", lambda m: m)).cast("long").alias("n_true"),
        F.size(empty).cast("long").alias("n_pad"), total.alias("total"),
    )


@query(
    "seq_pad_batch",
    """select patient, visit, n as n_true, max(n) over (partition by patient) - n as n_pad, total from
         (select patient, visit, count(*) as n, cast(sum(round(num * 100)) as bigint) as total from fx_events group by 1,2)""",
    "fx_events",
)
def _(t: Tables):
    rows = t.events().withColumn("pv", F.col("patient") * 100 + F.col("visit"))
    seq = sequences(rows, "pv", ["ts", "eid"], ["num"])
    out = pad_mask(seq.withColumn("batch", F.floor(F.col("pv") / 100)), "steps", 1, batch="batch")
    empty = F.filter(F.arrays_zip("steps", "mask"), lambda z: ~z["mask"] & (z["steps"][0] == 0))
    total = F.aggregate("steps", F.lit(0).cast("long"), lambda a, x: a + F.round(x[0].cast("double") * 100).cast("long"))
    return out.select(
        F.floor(F.col("pv") / 100).alias("patient"), (F.col("pv") % 100).alias("visit"),
        F.size(F.filter("mask", lambda m: m)).cast("long").alias("n_true"),
        F.size(empty).cast("long").alias("n_pad"), total.alias("total"),
    )


@query(
    "lbl_for_task",
    """select patient, arg_min(outcome, k) as first_outcome, arg_max(readmission, k) as last_readmission, arg_min(los, k) as first_los
       from (select patient, visit as k, cast(outcome as double) as outcome, cast(visit % 2 as double) as readmission, cast(visit % 9 as double) as los from fx_admissions)
       group by 1""",
    "fx_admissions",
)
def _(t: Tables):
    rows = t.admissions().withColumns({"readmission": F.col("visit") % 2, "los": F.col("visit") % 9})
    names = {"outcome": "outcome", "readmission": "readmission", "los": "los"}
    out = label_for_task(rows, "outcome", "patient", ["visit"], names).withColumnRenamed("outcome", "first_outcome")
    re = label_for_task(rows, "readmission", "patient", ["visit"], names).withColumnRenamed("readmission", "last_readmission")
    both = label_for_task(rows, "multitask", "patient", ["visit"], names).select("patient", F.col("los").alias("first_los"))
    return out.join(re, "patient").join(both, "patient")
