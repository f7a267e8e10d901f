"""Narratives, prompts, chat records, and scoring with a caller's function."""

from __future__ import annotations

from pyspark.sql import functions as F

from queryset.registry import Tables, query
from vitalgrid.operators.inference import score_batches
from vitalgrid.operators.joins import attach
from vitalgrid.operators.lists import visit_lists
from vitalgrid.operators.narrative import (
    PromptText, chat_record, context_within, finetune_set, limit_tokens, patient_context, prompt, truth_block, visit_block,
)
from vitalgrid.operators.sizes import group_sizes
from vitalgrid.operators.visits import gap_days

PV = ["patient", "visit"]

TEXTS = """fx_texts as (
    select a.patient, a.visit, a.outcome,
           cast(floor((epoch_us(admit) - epoch_us(lag(discharge) over (partition by a.patient order by admit, a.visit))) / 86400000000.0) as bigint) as gap_days,
           c.conditions, m.medications, p.procedures
    from fx_admissions a
    left join (select patient, visit, string_agg(title, ';' order by seq, code, title) as conditions from fx_items where version < 35 group by 1,2) c on a.patient = c.patient and a.visit = c.visit
    left join (select patient, visit, string_agg(code, ';' order by seq, code, title) as medications from fx_items where version < 20 group by 1,2) m on a.patient = m.patient and a.visit = m.visit
    left join (select patient, visit, string_agg(title, ';' order by seq, code, title) as procedures from fx_items where version > 30 group by 1,2) p on a.patient = p.patient and a.visit = p.visit),
fx_blocks as (
    select patient, visit, outcome,
           concat('Visit ', visit, case when gap_days is not null then concat(' (', gap_days, ' days after last Visit):') else ':' end, chr(10),
                  'Conditions:  ', coalesce(conditions, 'None'), chr(10), 'Medications: ', coalesce(medications, 'None'), chr(10),
                  'Procedures:  ', coalesce(procedures, 'None'), chr(10)) as plain,
           concat('Visit ', visit, case when gap_days is not null then concat(' ("', gap_days, '" days after last Visit):') else ':' end, chr(10),
                  'Conditions:  ', coalesce(conditions, 'None'), chr(10), 'Medications: ', coalesce(medications, 'None'), chr(10),
                  'Procedures:  ', coalesce(procedures, 'None'), chr(10)) as quoted,
           concat('Visit ', visit, ':', chr(10),
                  'Conditions:  ', coalesce(conditions, 'None'), chr(10), 'Medications: ', coalesce(medications, 'None'), chr(10),
                  'Procedures:  ', coalesce(procedures, 'None'), chr(10)) as none
    from fx_texts),
fx_context as (
    select patient, regexp_replace(string_agg(plain, chr(10) order by visit), '\\s+$', '') as context from fx_blocks group by 1)"""

TEXT = PromptText(
    system="You read records.",
    user="# Task #\n{task}\n\n# Context #\n{context}\n\nAnswer:",
    tasks={"Outcome": "Predict death.", "Readmission": "Predict return.", "LOS": "Predict days."},
)


def texts(t: Tables):
    rows = gap_days(t.admissions(), "patient", "visit", "admit", "discharge")
    # Joined once for three lists, whose groups are no larger than those of all items; and the texts are read by every
    # step that counts, limits or joins them.
    items = t.stored(t.items())
    sizes = group_sizes(items, PV, ["title", "code"])
    for name, col, cond in (
        ("conditions", "title", "version < 35"), ("medications", "code", "version < 20"), ("procedures", "title", "version > 30"),
    ):
        rows = attach(rows, visit_lists(items.where(cond), PV, {name: col}, ["seq", "code", "title"], sizes=sizes), PV)
    return t.stored(rows)


def block(style: str = "plain"):
    lists = {c: F.col(c) for c in ("conditions", "medications", "procedures")}
    return visit_block(F.col("visit"), F.col("gap_days"), lists, style)


@query(
    "txt_visit_block",
    "select patient, visit, md5(plain) as plain, md5(quoted) as quoted, none from fx_blocks",
    "fx_admissions fx_items",
    TEXTS,
)
def _(t: Tables):
    return texts(t).select(
        *PV, F.md5(block()).alias("plain"), F.md5(block("quoted")).alias("quoted"), block("none").alias("none")
    )


@query("txt_patient_context", "select patient, context from fx_context", "fx_admissions fx_items", TEXTS)
def _(t: Tables):
    return patient_context(texts(t), "patient", ["visit"], block())


@query(
    "txt_context_budget",
    """select patient, md5(regexp_replace(string_agg(plain, chr(10) order by visit), '\\s+$', '')) as context from (
         select *, sum(w) over (partition by patient order by visit rows between 1 following and unbounded following) as after from (
           select *, len(list_filter(regexp_split_to_array(plain, '\\s+'), lambda w: w <> '')) as w from fx_blocks))
       where coalesce(after, 0) <= 60 group by 1""",
    "fx_admissions fx_items",
    TEXTS,
)
def _(t: Tables):
    kept = context_within(texts(t), "patient", ["visit"], block(), 60, "tail")
    return patient_context(kept, "patient", ["visit"], block()).select("patient", F.md5("context").alias("context"))


@query(
    "txt_truth_block",
    """select patient, string_agg(concat('Visit ', visit, ': ', case when y is null then 'NA' else cast(y as varchar) end), chr(10) order by visit) as truth
       from (select patient, visit, arg_min(case when eid % 4 = 0 then -1 else eid % 2 end, eid) as y0,
                    case when arg_min(case when eid % 4 = 0 then -1 else eid % 2 end, eid) = -1 then null
                         else arg_min(case when eid % 4 = 0 then -1 else eid % 2 end, eid) end as y from fx_events group by 1,2) group by 1""",
    "fx_events",
)
def _(t: Tables):
    rows = t.events().withColumn("y", F.when(F.col("eid") % 4 != 0, F.col("eid") % 2))
    return truth_block(rows, "patient", "visit", ["eid"], "y")


@query(
    "txt_prompt",
    """select patient, md5(concat('[SYSTEM]', chr(10), 'You read records.', chr(10), chr(10), '[USER]', chr(10), '# Task #', chr(10), 'Predict return.', chr(10), chr(10),
              '# Context #', chr(10), context, chr(10), chr(10), 'Answer:', chr(10))) as prompt from fx_context""",
    "fx_admissions fx_items",
    TEXTS,
)
def _(t: Tables):
    context = patient_context(texts(t), "patient", ["visit"], block())
    return prompt(context, TEXT, "Readmission").select("patient", F.md5("prompt").alias("prompt"))


@query(
    "txt_chat_record",
    """select patient, 'system' as r1, content as c1, 'user' as r2, cast(turns as varchar) as c2, 'assistant' as r3,
              concat(a, chr(10), chr(10), '# Prediction Result #', chr(10), chr(10), ' ', patient % 2) as c3 from (
         select patient, count(*) as turns, arg_min(role, turn) as content,
                regexp_replace(regexp_replace(arg_max(content, turn), '^\\s+', ''), '\\s+$', '') as a from fx_chat group by 1)""",
    "fx_chat",
)
def _(t: Tables):
    at = F.col("turn")
    talks = t.chat().groupBy("patient").agg(
        F.count(F.lit(1)).alias("turns"), F.min_by("role", at).alias("opening"), F.max_by("content", at).alias("closing")
    )
    out = chat_record(
        talks, F.col("opening"), F.col("turns").cast("string"), F.col("closing"), F.col("patient") % 2
    )
    cols = [F.col("messages")[i][f].alias(f"{f[0]}{i + 1}") for i in range(3) for f in ("role", "content")]
    return out.select("patient", *cols)


@query(
    "txt_finetune_set",
    """select c.patient, l.label, md5(concat('# Task #', chr(10), 'Predict death.', chr(10), chr(10), '# Context #', chr(10), context, chr(10), chr(10), 'Answer:')) as asked,
              md5(concat(a.text, chr(10), chr(10), '# Prediction Result #', chr(10), chr(10), ' ', l.label)) as answered
       from (select patient, row_number() over (order by md5(concat('42-', cast(patient as varchar))), patient) as r
             from (select distinct patient from fx_admissions where patient in (select doc_id from documents))) s
       join fx_context c on c.patient = s.patient
       join (select patient, arg_max(outcome, visit) as label from fx_admissions group by 1) l on l.patient = s.patient
       join (select doc_id as patient, regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', '') as text from documents) a on a.patient = s.patient
       where s.r <= 50""",
    "fx_admissions fx_items",
    TEXTS,
)
def _(t: Tables):
    rows = texts(t)
    # Labels come one row per record, named by the visit's position in the patient.
    labels = rows.select("patient", F.col("visit").alias("visit_pos"), F.col("outcome").alias("Outcome"))
    labels = labels.withColumn("record", F.explode(F.array(F.lit(1), F.lit(2))))
    answers = t.read("documents").select(F.col("doc_id").alias("patient"), F.col("text").alias("answer"))
    out = finetune_set(rows.drop("outcome", "admit", "discharge"), labels, answers, "Outcome", 50, 42, TEXT)
    return out.select(
        "patient", F.col("label").cast("long").alias("label"),
        F.md5(F.col("messages")[1]["content"]).alias("asked"), F.md5(F.col("messages")[2]["content"]).alias("answered"),
    )


@query(
    "inf_batch",
    "select doc_id, length(text) as n_chars, length(text) % 2 as guess from documents where doc_id not in (select doc_id from labels where quality = 1)",
)
def _(t: Tables):
    import pandas as pd

    def load():
        def score(batch: pd.DataFrame) -> pd.DataFrame:
            n = batch["text"].str.len().astype("int64")
            return pd.DataFrame({"doc_id": batch["doc_id"], "n_chars": n, "guess": n % 2})

        return score

    done = t.read("labels").where("quality = 1")
    docs = t.read("documents").select("doc_id", "text")
    return score_batches(docs, load, "doc_id long, n_chars long, guess long", 8, "doc_id", done)


@query(
    "inf_prompt_tail",
    """select patient, md5(case when len(w) > 40 then array_to_string(w[-40:], '') else context end) as context
       from (select patient, context, regexp_extract_all(context, '\\S+\\s*') as w from fx_context)""",
    "fx_admissions fx_items",
    TEXTS,
)
def _(t: Tables):
    # Visits that the budget cannot reach are left out before any text is built.
    rows = context_within(texts(t), "patient", ["visit"], block(), 40, "tail")
    context = patient_context(rows, "patient", ["visit"], block())
    return limit_tokens(context, "context", 40, "tail").select("patient", F.md5("context").alias("context"))
