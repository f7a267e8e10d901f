"""Flows that end in published files: split tables, visit texts, reasoning texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from queryset.evaluation import AP, AUC
from queryset.flows import BLEND, FX, features_sql, raw_sql, raw_tables
from queryset.narrative import TEXT, TEXTS, block, texts
from queryset.registry import Tables, query
from vitalgrid import params as P
from vitalgrid.operators.inference import score_batches
from vitalgrid.operators.joins import split_frames
from vitalgrid.operators.narrative import PromptText, limit_tokens, patient_context, prompt
from vitalgrid.operators.sampling import split_by_entity, split_labels
from vitalgrid.plans import evaluation, features, reasoning
from vitalgrid.plans.report import report
from vitalgrid.plans.wide import wide_table
from vitalgrid.session import shared_folder
from vitalgrid.sources.jsonlines import append_new
from vitalgrid.sources.tables import read_csv, save_table

SPLITS = ("train", "val", "test")


def _stored(t: Tables, df: DataFrame) -> DataFrame:
    path = shared_folder(t.spark)
    save_table(df, path)
    return t.spark.read.parquet(path)


_done: dict[tuple[str, str], tuple[str, list[str]]] = {}


def _published(t: Tables) -> tuple[str, list[str]]:
    """The folder of all published tables of variant III, and the columns of the features; written once per session and input."""
    at = t.spark.sparkContext.applicationId, t.folder
    if at not in _done:
        _done[at] = _publish(t)
    return _done[at]


def _publish(t: Tables) -> tuple[str, list[str]]:
    records = _stored(t, features.cohort(_stored(t, wide_table(raw_tables(t, P.III), P.III)), P.III, "outcome"))
    series = _stored(t, features.time_series(records, bound=P.III.outcome_rows))
    rows = features.scaled_splits(_stored(t, features.encoded(series, P.III)), P.III)
    splits = split_labels(series, "patient", (0.7, 0.1), 42)
    folder = shared_folder(t.spark)
    rows = _stored(t, rows)
    # Three files are written from the texts, so they are put together once; their visits are counted on stored rows.
    texts = _stored(t, features.visit_texts(records))
    features.write_splits(rows, P.III, folder, _stored(t, features.split_texts(texts, splits)))
    return folder, features.published(rows, P.III)[0].drop("split").columns


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@query(
    "flow_split_texts",
    """select w.patient, w.visit, cast(gap as double) as gap_days, condition_titles, medications, procedure_titles, split from (
         select *, floor((epoch_us(admit) - epoch_us(lag(discharge) over (partition by patient order by admit, visit))) / 86400000000.0) as gap
         from rf_rows where record = 1) w join rf_split s on w.patient = s.patient""",
    FX,
    raw_sql(P.III) + ",\n" + features_sql(P.III, 200),
)
def _(t: Tables):
    folder, _columns = _published(t)
    schema = "PatientID long, VisitID long, GapTime double, Conditions_Long string, Medications string, Procedures_Long string"
    parts = [read_csv(t.spark, f"{folder}/{s}_cmps", schema).withColumn("split", F.lit(s)) for s in SPLITS]
    names = {published: own for own, published in features.TEXT_NAMES.items()}
    return _union(parts).withColumnsRenamed(names)


@query(
    "flow_published_iii",
    """select patient, record, split, round(case when hi_visit_pos <= lo_visit_pos then 1 else (visit_pos - lo_visit_pos) / (hi_visit_pos - lo_visit_pos) end, 4) as visit_pos,
              outcome::bigint as outcome, round(los::double, 4) as los, readmission::bigint as readmission,
              round(case when hi_D0 <= lo_D0 then 1 else (D0 - lo_D0) / (hi_D0 - lo_D0) end, 4) as d0,
              round(case when hi_D23 <= lo_D23 then 1 else (D23 - lo_D23) / (hi_D23 - lo_D23) end, 4) as d23
       from (select patient, split, visit_pos, outcome, los, readmission, D0, D23,
                    row_number() over (partition by patient, split order by visit, record) as record from rf_all), rf_fit""",
    FX,
    raw_sql(P.III) + ",\n" + features_sql(P.III, 200),
)
def _(t: Tables):
    folder, columns = _published(t)
    schema = ", ".join(f"`{c}` {'long' if c == 'PatientID' else 'double'}" for c in columns)
    labels = "PatientID long, VisitID double, Outcome long, LOS double, Readmission long"
    found = []
    for s in SPLITS:
        # Both files have a row per record; rows of one visit meet by their values' order.
        x = read_csv(t.spark, f"{folder}/{s}_features", schema).select("PatientID", "VisitID", "RecordTime", "D0", "D23")
        y = read_csv(t.spark, f"{folder}/{s}_labels", labels)
        y = y.groupBy("PatientID", "VisitID").agg(*[F.first(c).alias(c) for c in ("Outcome", "LOS", "Readmission")])
        found.append(x.join(y, ["PatientID", "VisitID"]).withColumn("split", F.lit(s)))
    rows = _union(found)
    from vitalgrid.operators.ordered import ordinal

    rows = ordinal(rows, ["PatientID", "split"], ["VisitID", "RecordTime"], out="record")
    r = lambda c: F.round(c, 4)
    return rows.select(
        F.col("PatientID").alias("patient"), "record", "split", r("VisitID").alias("visit_pos"), F.col("Outcome").alias("outcome"),
        r("LOS").alias("los"), F.col("Readmission").alias("readmission"), r("D0").alias("d0"), r("D23").alias("d23"),
    )


ASK = PromptText(system="You read records.", user="# Task #\n{task}\n\n# Context #\n{context}\n\n# Truth #\n{truth}", tasks={"Outcome": "Explain death."})
BUDGET = 250


@query(
    "flow_reasoning",
    f"""select p.patient, 'Outcome' as task, concat(length(prompt), ' steps') as answer from (
          select c.patient, concat('[SYSTEM]', chr(10), 'You read records.', chr(10), chr(10), '[USER]', chr(10), '# Task #', chr(10), 'Explain death.', chr(10), chr(10),
                                   '# Context #', chr(10), context, chr(10), chr(10), '# Truth #', chr(10), truth, chr(10)) as prompt
          from fx_context c join (select patient, string_agg(concat('Visit ', visit, ': ', outcome), chr(10) order by visit) as truth
                                  from fx_texts group by 1) l on c.patient = l.patient) p
        where len(regexp_extract_all(prompt, '\\S+')) <= {BUDGET} and p.patient % 7 <> 0""",
    "fx_admissions fx_items",
    TEXTS,
)
def _(t: Tables):
    def load():
        def answer(frame):
            tail = frame["patient"].map(lambda p: " so the outcome IS 1" if p % 7 == 0 else "")
            return frame[["patient"]].assign(answer=frame["prompt"].str.len().astype(str) + " steps" + tail)

        return answer

    rows = texts(t)
    labels = rows.select("patient", "visit", F.explode(F.array(F.lit(1), F.lit(2))).alias("record"), "outcome")
    # Two runs read the prompts.
    prompts = _stored(t, reasoning.reasoning_prompts(rows, labels, block(), ASK, "Outcome", "outcome", BUDGET))
    path = shared_folder(t.spark)
    # A first run that got to every third patient, then the rest.
    reasoning.reasoning(prompts.where("patient % 3 = 0"), "Outcome", load, path, 10)
    kept, _seen = reasoning.reasoning(prompts, "Outcome", load, path, 10, slices=2)
    return kept.select("patient", "task", "answer")


def _top_sql(who: str, kind: str) -> str:
    dead = "" if who == "all" else " and patient in (select patient from rf_rows where outcome = 1)"
    if kind == "medication":
        source = f"select trim(unnest(string_split(medications, ';'))) as name from rf_rows where record = 1 and medications is not null{dead}"
    else:
        source = f"""select concat(trim(title), ' / ', trim(code)) as name from (
            select unnest(string_split({kind}_titles, ';')) as title, unnest(string_split({kind}_codes, ';')) as code
            from rf_rows where record = 1 and {kind}_titles is not null{dead})"""
    return f"""select '{who}' as who, '{kind}' as kind, row_number() over (order by n desc, name) as place, name, n::double as value
        from (select name, count(*) as n from ({source}) group by 1 order by n desc, name limit 10)"""


PROFILE = """select 'all' as who, 'profile' as kind, place, name, round(value, 6) as value from (
    select count(*)::double as v1, sum(o)::double as v2, (count(*) - sum(o))::double as v3, sum(o) / count(*)::double as v4,
           avg(nv) as v5, avg(nr / nv::double) as v6, avg(los) as v7, avg(re) as v8
    from (select patient, max(o) as o, count(*) as nv, sum(n) as nr, avg(los) as los, avg(re) as re from
            (select patient, visit, max(outcome) as o, count(*) as n, arg_min(los, record) as los, arg_min(readmission, record) as re
             from rf_rows group by 1, 2) group by 1)) m,
    lateral (values (1, 'patients', v1), (2, 'dead', v2), (3, 'alive', v3), (4, 'mortality', v4), (5, 'visits_per_patient', v5),
                    (6, 'records_per_visit', v6), (7, 'mean_los', v7), (8, 'mean_readmission', v8)) x(place, name, value)"""


@query(
    "flow_report",
    f"{PROFILE} union all "
    + " union all ".join(f"select * from ({_top_sql(w, k)})" for w in ("all", "dead") for k in ("condition", "medication", "procedure")),
    FX,
    raw_sql(P.III) + ",\n" + features_sql(P.III, 200),
)
def _(t: Tables):
    records = features.cohort(_stored(t, wide_table(raw_tables(t, P.III), P.III)), P.III, "outcome")
    return report(_stored(t, records)).withColumn("value", F.round("value", 6))


ANSWERS = """fx_asked as (
    select patient, regexp_extract_all(concat('[SYSTEM]', chr(10), 'You read records.', chr(10), chr(10), '[USER]', chr(10), '# Task #', chr(10),
           'Predict death.', chr(10), chr(10), '# Context #', chr(10), context, chr(10), chr(10), 'Answer:', chr(10)), '\\S+\\s*') as w from fx_context),
fx_scores as (
    select a.patient, c.label as y, ((a.patient * 37) % 101) / 100.0::double as p1,
           case when a.patient % 5 = 0 then 0 else length(array_to_string(case when len(w) > 60 then w[-60:] else w end, '')) % 2 end::double as p2
    from fx_asked a join fx_cohort c on a.patient = c.patient)"""


@query(
    "flow_answers_blended",
    f"""select x.auroc, y.auprc, z.min_ps, round(b.alpha, 6) as alpha, round(b.t, 6) as t
        from ({AUC.format(t='fx_tb', p='p')}) x, ({AP.format(t='fx_tb', p='p')}) y, fx_best b,
        (select round(least(tp / (tp + fp + 1e-12::double), tp / (np + 1e-12::double)), 6) as min_ps from (
           select count(*) filter (where p >= t and y = 1) as tp, count(*) filter (where p >= t and y = 0) as fp, sum(y) as np from fx_tb)) z""",
    "fx_admissions fx_items fx_cohort",
    TEXTS + ",\n" + ANSWERS + ",\n" + BLEND,
)
def _(t: Tables):
    def load():
        def answer(frame):
            result = "\n\n# Prediction Result #\n\n " + (frame["prompt"].str.len() % 2).astype(str)
            return frame[["patient"]].assign(answer="# Reasoning #" + result.where(frame["patient"] % 5 != 0, ""))

        return answer

    def score(df: DataFrame) -> DataFrame:
        return score_batches(df, load, "patient long, answer string", 8, tasks=t.spark.sparkContext.defaultParallelism)

    context = patient_context(texts(t), "patient", ["visit"], block())
    # Two runs read the prompts.
    asked = _stored(t, limit_tokens(prompt(context, TEXT, "Outcome"), "prompt", 60, "tail").select("patient", "prompt"))
    path = shared_folder(t.spark)
    columns = ["patient", "answer"]
    append_new(asked.where("patient % 4 = 1"), path, "patient", columns, transform=score)
    answers = append_new(asked, path, "patient", columns, transform=score, slices=2)
    labels = t.cohort().select("patient", F.col("label").alias("y"))
    sequence = t.cohort().select("patient", (((F.col("patient") * 37) % 101) / F.lit(100.0)).alias("p1"))
    rows = _stored(t, evaluation.scored_labels(labels, sequence, answers))
    parts = split_frames(split_by_entity(rows, "patient", (0.5, 0.25), 42), "split")
    out = evaluation.blended_test(parts["train"].unionByName(parts["val"]), parts["test"])
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])
