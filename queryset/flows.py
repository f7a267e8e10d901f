"""Whole flows on hospital-shaped tables derived from the given ones.

``raw_tables`` maps the given tables to the nine source tables: event users are
patients, five-day blocks are stays, events become chart and lab items, order
lines become codes and drugs.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from queryset.evaluation import AP, AUC, BEST, ENS
from queryset.registry import Tables, query
from vitalgrid import params as P
from vitalgrid.functions.timing import micros
from vitalgrid.operators.joins import split_frames
from vitalgrid.operators.sampling import split_by_entity
from vitalgrid.plans import evaluation, features
from vitalgrid.plans.wide import RawTables, deidentify, display, wide_table
from vitalgrid.session import shared_folder
from vitalgrid.sources.tables import save_table


def item_list(spec: P.Variant) -> list[int]:
    return sorted(spec.chart_items)


def raw_tables(t: Tables, spec: P.Variant) -> RawTables:
    visits, events = t.visits(), t.events()
    user, hadm = F.col("patient").alias("subject_id"), (F.col("patient") * 100 + F.col("visit")).alias("hadm_id")
    p = F.col("patient")
    years = 2004 - p % 60 - F.when(p % 10 == 0, 300).otherwise(0)
    patients = events.select("patient").distinct().select(
        user,
        F.when(p % 3 == 0, "M").when(p % 3 == 1, "m").otherwise("F").alias("gender"),
        F.make_date(years.cast("int"), F.lit(7), F.lit(1)).alias("dob"),
        F.when(p % 8 == 0, F.lit("2024-02-01")).cast("timestamp_ntz").alias("dod_hosp"),
        F.when(p % 11 != 0, 20 + p % 60).alias("anchor_age"),
        F.lit(2020).alias("anchor_year"),
    )
    admissions = visits.select(
        user, hadm, F.col("admit").alias("admittime"), F.col("discharge").alias("dischtime"),
        F.when(F.col("outcome") == 1, F.col("discharge")).alias("deathtime"),
    )
    ids = item_list(spec)
    eid, num = F.col("eid"), F.col("num")
    item = F.element_at(F.array(*[F.lit(i) for i in ids]), (eid % len(ids) + 1).cast("int"))
    coma = {P.EYE_ITEM: (4, 1), P.VERBAL_ITEM: (5, 1), P.MOTOR_ITEM: (6, 1), 198: (13, 3)}
    value = F.when(F.lit(False), F.lit(0.0))
    for i, (n, first) in coma.items():
        value = value.when(F.col("itemid") == i, (F.floor(num) % n + first).cast("double"))
    text = F.when(eid % 3 == 0, P.CAPILLARY_TEXT[0]).when(eid % 3 == 1, P.CAPILLARY_TEXT[1]).otherwise(P.CAPILLARY_TEXT[0].lower())
    chart = events.where("item <> 'error'").withColumn("itemid", item).select(
        user, hadm, F.col("ts").alias("charttime"), "itemid", value.otherwise(num).alias("valuenum"),
        F.when(F.col("itemid").isin(list(P.CAPILLARY_ITEMS)), text).alias("value"),
    )
    labs = list(P.LAB_ITEMS.values())
    lab = events.where("item = 'error'").select(
        user, hadm, F.col("ts").alias("charttime"),
        F.element_at(F.array(*[F.lit(i) for i in labs]), (eid % 3 + 1).cast("int")).alias("itemid"), num.alias("valuenum"),
    )
    # Joined once: codes, procedures and drugs are counted and listed from it.
    lines = t.stored(t.items()).withColumn("visit", F.col("visit") % 6).select(user, hadm, "seq", "code", "title", "version")
    version = F.when(F.col("version") % 2 == 0, 9).otherwise(10).alias("icd_version")
    code = spec.code_column
    codes = lines.select("subject_id", "hadm_id", "seq", F.col("code").alias(code), version)
    names = t.read("part").select(F.col("p_brand").alias(code)).distinct().where(f"{code} <> 'Brand#5'")
    title = F.concat(F.lit("Name of "), F.col(code)).alias("long_title")
    if spec.code_version is None:
        names = names.select(code, title)
    else:
        names = names.select(code, F.explode(F.array(F.lit(9), F.lit(10))).alias("icd_version"), title)
    drugs = lines.select("subject_id", "hadm_id", F.when(F.col("seq") != 2, F.col("title")).alias("drug"))
    return RawTables(
        patients, admissions, chart, lab, codes.where("seq <= 3"), names, codes.where("seq > 3"), names, drugs
    )


def _one(prefix: str, number: int, names) -> list[str]:
    return [f"max(case when itemid = {number} and valuenum = {k} then 1 else 0 end) as {prefix}{k}" for k in names]


def _many(ids) -> str:
    return ", ".join(str(i) for i in ids)


def _max(ids, name: str) -> str:
    return f"max(case when itemid in ({_many(ids)}) then valuenum end) as {name}"


def raw_sql(spec: P.Variant) -> str:
    """The wide table in plain SQL: a range join on the window bounds, then one aggregation."""
    ids = item_list(spec)
    txt = "value" if spec.text_case_sensitive else "lower(value)"
    normal, slow = P.CAPILLARY_TEXT if spec.text_case_sensitive else [c.lower() for c in P.CAPILLARY_TEXT]
    age = (
        "case when year(admit) - dob_year >= 300 then 90 else year(admit) - dob_year end"
        if spec.age_rule == "birth" else "anchor_age + year(admit) - 2020"
    )
    death = "case when v.patient % 8 = 0 then 1 else 0 end" if spec.death_table == "patients" else "v.outcome"
    f = "(valuenum - 32) * 5.0::double / 9.0::double"
    if spec.temperature_range:
        temp = f"""max(case when itemid in ({_many(P.CELSIUS_ITEMS)}) and valuenum between 30 and 45 then round(valuenum, 2)
            when itemid in ({_many(P.FAHRENHEIT_ITEMS)}) and {f} between 30 and 45 then round({f}, 2) end) as temperature"""
    else:
        temp = f"""max(case when itemid in ({_many(P.CELSIUS_ITEMS)}) then valuenum
            when itemid in ({_many(P.FAHRENHEIT_ITEMS)}) then round({f}, 2) end) as temperature"""
    cols = [
        _max(P.WEIGHT_ITEMS, "weight"), _max(P.HEIGHT_ITEMS, "height"),
        f"max(case when itemid in ({_many(P.CAPILLARY_ITEMS)}) and {txt} = '{normal}' then 1 else 0 end) as capillary_normal",
        f"max(case when itemid in ({_many(P.CAPILLARY_ITEMS)}) and {txt} = '{slow}' then 1 else 0 end) as capillary_slow",
        *_one("gcs_eye_", P.EYE_ITEM, P.EYE), *_one("gcs_verbal_", P.VERBAL_ITEM, P.VERBAL), *_one("gcs_motor_", P.MOTOR_ITEM, P.MOTOR),
    ]
    if spec.gcs_total_item:
        cols += _one("gcs_total_", spec.gcs_total_item, P.TOTALS)
    else:
        total = " + ".join(f"max(case when itemid = {i} then valuenum end)" for i in (P.EYE_ITEM, P.VERBAL_ITEM, P.MOTOR_ITEM))
        cols += [f"case when {total} = {k} then 1 else 0 end as gcs_total_{k}" for k in P.TOTALS]
    cols += [
        _max([P.DIASTOLIC_ITEM], "diastolic_bp"), _max([P.SYSTOLIC_ITEM], "systolic_bp"), _max([P.MEAN_ITEM], "mean_bp"),
        _max([P.HEART_ITEM], "heart_rate"), _max([spec.respiration_item], "respiratory_rate"), temp,
        _max([P.LAB_ITEMS["oxygen_saturation"]], "oxygen_saturation"), _max(spec.fio2_items, "fio2"),
        _max([P.LAB_ITEMS["glucose"]], "glucose"), _max([P.LAB_ITEMS["ph"]], "ph"),
    ]
    chosen = "and version % 2 = 0" if spec.code_version else ""
    facts = [c for c in P.IDS if c not in ("weight", "height")]
    return f"""rw_base as (
    select v.patient, v.patient * 100 + v.visit as visit, v.admit, v.discharge, {death} as outcome,
           round((epoch_us(discharge) - epoch_us(admit)) / 86400000000.0, 2) as los,
           case when lead(admit) over (partition by v.patient order by admit) <= discharge + interval '30' day then 1 else 0 end as readmission,
           case when v.patient % 3 < 2 then 1 else 0 end as sex,
           2004 - v.patient % 60 - case when v.patient % 10 = 0 then 300 else 0 end as dob_year,
           case when v.patient % 11 <> 0 then 20 + v.patient % 60 end as anchor_age
    from fx_visits v),
rw_facts as (select patient, visit, admit, discharge, outcome, los, readmission, sex, {age} as age from rw_base),
rw_grid as (
    select f.*, g.record, g.w0 as record_start from rw_facts f join fx_grid g on f.patient = g.patient and f.visit = g.patient * 100 + g.visit),
rw_chart as (
    select eid, patient, patient * 100 + visit as visit, ts, num, [{_many(ids)}][eid % {len(ids)} + 1] as itemid,
           case eid % 3 when 0 then '{P.CAPILLARY_TEXT[0]}' when 1 then '{P.CAPILLARY_TEXT[1]}' else '{P.CAPILLARY_TEXT[0].lower()}' end as text
    from fx_events where item <> 'error'),
rw_events as (
    select patient, visit, ts, itemid,
           case itemid when {P.EYE_ITEM} then floor(num) % 4 + 1 when {P.VERBAL_ITEM} then floor(num) % 5 + 1
                when {P.MOTOR_ITEM} then floor(num) % 6 + 1 when 198 then floor(num) % 13 + 3 else num end as valuenum,
           case when itemid in ({_many(P.CAPILLARY_ITEMS)}) then text end as value from rw_chart
    union all
    select patient, patient * 100 + visit, ts, [{_many(P.LAB_ITEMS.values())}][eid % 3 + 1], num, null from fx_events where item = 'error'),
rw_pivot as (
    select {', '.join('g.' + c for c in facts)}, {', '.join(cols)}
    from rw_grid g left join rw_events e on e.patient = g.patient and e.visit = g.visit
      and e.ts >= g.record_start and e.ts < g.record_start + interval '12' hour
    group by all),
rw_lines as (select patient, patient * 100 + visit % 6 as visit, seq, code, title, version from fx_items),
rw_cond as (select patient, visit, string_agg(code, ';' order by code) as codes, string_agg('Name of ' || code, ';' order by code) as titles
            from rw_lines where code <> 'Brand#5' and seq <= 3 {chosen} group by 1, 2),
rw_proc as (select patient, visit, string_agg(code, ';' order by code) as codes, string_agg('Name of ' || code, ';' order by code) as titles
            from rw_lines where code <> 'Brand#5' and seq > 3 {chosen} group by 1, 2),
rw_drug as (select patient, visit, string_agg(title, ';' order by title) as drugs from rw_lines where seq <> 2 group by 1, 2),
rw_wide as (
    select p.*, case when record = 1 then c.codes end as condition_codes, case when record = 1 then c.titles end as condition_titles,
           case when record = 1 then m.drugs end as medications, case when record = 1 then o.codes end as procedure_codes,
           case when record = 1 then o.titles end as procedure_titles
    from rw_pivot p left join rw_cond c on p.patient = c.patient and p.visit = c.visit
    left join rw_drug m on p.patient = m.patient and p.visit = m.visit
    left join rw_proc o on p.patient = o.patient and p.visit = o.visit)"""


COUNTED = ["outcome", "readmission", "sex", "age"] + [c for c in P.WIDE_NAMES if c.startswith(("capillary_", "gcs_"))]
TIMES = ["record_start", "admit", "discharge"]


def shown(df: DataFrame) -> DataFrame:
    """Whole numbers as long, times as microseconds, other numbers rounded."""
    cols = []
    for c, kind in df.dtypes:
        name = f"`{c}`"
        if c in TIMES:
            cols.append(micros(F.col(name)).alias(c))
        elif kind in ("int", "bigint"):
            cols.append(F.col(name).cast("long").alias(c))
        elif kind in ("double", "float"):
            cols.append(F.round(F.col(name).cast("double"), 6).alias(c))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


def shown_sql(cols, table: str, rename=None) -> str:
    parts = []
    for c in cols:
        out = f'"{(rename or {}).get(c, c)}"'
        if c in TIMES:
            parts.append(f"epoch_us({c}) as {out}")
        elif c in COUNTED:
            parts.append(f"cast({c} as bigint) as {out}")
        elif c in P.VITALS or c in ("weight", "height", "los"):
            parts.append(f"round({c}::double, 6) as {out}")
        else:
            parts.append(f"{c} as {out}")
    return f"select {', '.join(parts)} from {table}"


FX = "fx_events fx_visits fx_grid fx_items"


@query("flow_wide_iii", shown_sql(P.WIDE_NAMES, "rw_wide"), FX, raw_sql(P.III))
def _(t: Tables):
    return shown(wide_table(raw_tables(t, P.III), P.III))


@query("flow_wide_iv", shown_sql(P.WIDE_NAMES, "rw_wide"), FX, raw_sql(P.IV))
def _(t: Tables):
    return shown(wide_table(raw_tables(t, P.IV), P.IV))


NEW_IDS = """rw_map as (
    select patient, 10000 + row_number() over (order by md5(concat('42-', cast(patient as varchar))), patient) as new_patient
    from (select distinct patient from rw_wide)),
rw_new as (
    select m.new_patient as patient, dense_rank() over (partition by w.patient order by admit) as visit, w.* exclude (patient, visit)
    from rw_wide w join rw_map m on w.patient = m.patient)"""


@query(
    "flow_deidentified_iii",
    shown_sql(P.WIDE_NAMES, "rw_new", {**P.WIDE_NAMES, **{c: c for c in TIMES}}),
    FX,
    raw_sql(P.III) + ",\n" + NEW_IDS,
)
def _(t: Tables):
    out = display(deidentify(wide_table(raw_tables(t, P.III), P.III)))
    return shown(out.withColumnsRenamed({P.WIDE_NAMES[c]: c for c in TIMES}))


# --- features: cohort, imputation, scores, positions, split, scaling ---------

def _band_sql(c: str, bands) -> str:
    tests = []
    for lo, hi, score in bands:
        edges = [f"{c} >= {lo}::double"] * (lo is not None) + [f"{c} <= {hi}::double"] * (hi is not None)
        tests.append(f"when {' and '.join(edges)} then {score}.0::double")
    return f"case when {c} is null then null {' '.join(tests)} end"


def features_sql(spec: P.Variant, rows_limit: int) -> str:
    """Cohort to scaled features in plain SQL, block by block."""
    want_pos = int(spec.cohort_outcome * spec.outcome_share)
    want_neg = spec.cohort_outcome - want_pos
    if spec.backfill_outcome:
        take_pos = f"least(pos, least({want_pos}, pos) + greatest({want_neg} - neg, 0))"
        take_neg = f"least(neg, least({want_neg}, neg) + greatest({want_pos} - pos, 0))"
    else:
        take_pos, take_neg = str(want_pos), str(want_neg)
    measured = ["age", "weight", "height", *P.VITALS]
    up = "over (partition by patient, visit order by record rows between unbounded preceding and current row)"
    down = "over (partition by patient, visit order by record rows between current row and unbounded following)"
    fills = [f"coalesce(last_value({c} ignore nulls) {up}, first_value({c} ignore nulls) {down})::double as {c}" for c in measured]
    other = [c for c in P.WIDE_NAMES if c not in (*measured, *P.TEXT_LISTS)]
    scores = {f"s_{c}": _band_sql(c, b) for c, b in P.BANDS.items()}
    scores["s_cap"] = "case when capillary_normal = 1 then 0.0::double when capillary_slow = 1 then 2.0::double end"
    coma = "list_avg([" + ", ".join(f"case when gcs_total_{k} = 1 then {k} end" for k in P.TOTALS) + "])"
    scales = ", ".join(f"({i}, {'null' if s == 'full' else s})" for i, s in enumerate(spec.scales))
    n = spec.pool_size
    points = [f"D{i}" for i in range(n)]
    pooled = ", ".join(f"max(case when i = {i} then v end) as D{i}" for i in range(n))
    scaled = ["visit_pos", "record_pos", *measured, *points]
    fit = ", ".join(
        f"min(least(greatest({c}, -250), 250)) filter (where {c} is not null) as lo_{c}, "
        f"max(least(greatest({c}, -250), 250)) filter (where {c} is not null) as hi_{c}" for c in scaled
    )
    return f"""rf_label as (
    select *, row_number() over (partition by label order by md5(concat('42-', cast(patient as varchar))), patient) as k,
           sum(label) over () as pos, sum(1 - label) over () as neg
    from (select patient, max(outcome) as label from rw_wide group by 1)),
rf_rows as (
    select w.*, l.label from rw_wide w join rf_label l on w.patient = l.patient
    where w.record <= {rows_limit} and l.k <= case when label = 1 then {take_pos} else {take_neg} end),
rf_series as (
    select {', '.join(c for c in other if c != 'outcome')}, label as outcome, {', '.join(fills)},
           count(*) over (partition by patient, visit) as n_rec
    from rf_rows),
rf_scores as (select patient, visit, record, n_rec, {coma} as gcs, {', '.join(f'{v} as {k}' for k, v in scores.items())} from rf_series),
rf_blocks as (
    select r.patient, r.visit, s.scale_no, r.record as start, coalesce(s.len, r.n_rec) as len
    from rf_scores r, (values {scales}) s(scale_no, len) where r.record + coalesce(s.len, r.n_rec) - 1 <= r.n_rec),
rf_tas as (
    select b.patient, b.visit, b.scale_no, b.start,
           (coalesce(avg(gcs), 0) * 4 / 15 + coalesce(list_avg([{', '.join(f'avg({k})' for k in scores)}]), 0)) / 8 as score
    from rf_blocks b join rf_scores f on b.patient = f.patient and b.visit = f.visit and f.record between b.start and b.start + b.len - 1
    group by all),
rf_pool as (
    select patient, visit, {pooled} from (
      select patient, visit, i, s[lo + 1] * (1 - (x - lo)) + s[least(lo + 1, m - 1) + 1] * (x - lo) as v from (
        select *, floor(x)::bigint as lo from (
          select patient, visit, s, len(s) as m, i, i * (len(s) - 1) / {n - 1}.0::double as x
          from (select patient, visit, list(score order by scale_no, start) as s from rf_tas group by 1, 2), range({n}) r(i)))) group by 1, 2),
rf_pos as (
    select patient, visit, case when n = 1 then 1.0::double else (r - 1) / (n - 1)::double end as visit_pos
    from (select patient, visit, row_number() over (partition by patient order by visit) as r, count(*) over (partition by patient) as n
          from (select distinct patient, visit from rf_series))),
rf_split as (
    select patient, case when r <= floor(n * 0.7::double) then 'train' when r <= floor(n * 0.7::double) + floor(n * 0.1::double) then 'val' else 'test' end as split
    from (select patient, row_number() over (order by md5(concat('42-', cast(patient as varchar))), patient) as r, count(*) over () as n
          from (select distinct patient from rf_series))),
rf_all as (
    select f.*, p.* exclude (patient, visit), v.visit_pos, s.split,
           case when n_rec = 1 then 1.0::double else (record - 1) / (n_rec - 1)::double end as record_pos
    from rf_series f join rf_pool p on f.patient = p.patient and f.visit = p.visit
    join rf_pos v on f.patient = v.patient and f.visit = v.visit join rf_split s on s.patient = f.patient),
rf_fit as (select {fit} from rf_all where split = 'train')"""


def features_out(spec: P.Variant) -> str:
    measured = ["age", "weight", "height", *P.VITALS]
    scaled = ["visit_pos", "record_pos", *measured, *[f"D{i}" for i in range(spec.pool_size)]]
    plain = [c for c in P.WIDE_NAMES if c not in (*measured, *P.TEXT_LISTS, *TIMES)]
    rule = (
        "case when lo_{c} is null or hi_{c} <= lo_{c} then 1 when {c} is null then 0 "
        'when {c} < -250 or {c} > 250 then 1 else ({c} - lo_{c}) / (hi_{c} - lo_{c}) end'
    )
    out = [f"round(({rule.format(c=c)})::double, 5) as \"{c}\"" for c in scaled]
    out += [f"cast({c} as bigint) as {c}" if c in COUNTED else f"round({c}::double, 5) as {c}" if c == "los" else c for c in plain]
    return f"select {', '.join(out)}, split from rf_all, rf_fit"


def feature_rows(t: Tables, spec: P.Variant) -> DataFrame:
    wide = wide_table(raw_tables(t, spec), spec)
    # The wide table is a stored result in this flow, as it is in a real run.
    path = shared_folder(t.spark)
    save_table(wide, path)
    records = features.cohort(t.spark.read.parquet(path), spec, "outcome")
    series = features.time_series(records, bound=spec.outcome_rows)
    stored = shared_folder(t.spark)
    save_table(series, stored)
    return features.scaled_splits(t.stored(features.encoded(t.spark.read.parquet(stored), spec)), spec)


def features_shown(df: DataFrame) -> DataFrame:
    cols = []
    for c, kind in df.dtypes:
        if kind in ("int", "bigint") and c != "age":
            cols.append(F.col(c).cast("long").alias(c))
        elif kind == "string":
            cols.append(F.col(c))
        else:
            cols.append(F.round(F.col(c).cast("double"), 5).alias(c))
    return df.select(*cols)


@query(
    "flow_features_iii", features_out(P.III), FX, raw_sql(P.III) + ",\n" + features_sql(P.III, 200)
)
def _(t: Tables):
    return features_shown(feature_rows(t, P.III))


@query("flow_features_iv", features_out(P.IV), FX, raw_sql(P.IV) + ",\n" + features_sql(P.IV, 4))
def _(t: Tables):
    return features_shown(feature_rows(t, P.IV))


@query(
    "flow_cohort_readmission_iv",
    """select patient, visit, record from rc_kept join (
         select *, row_number() over (partition by label order by md5(concat('42-', cast(patient as varchar))), patient) as k,
                sum(label) over () as pos, sum(1 - label) over () as neg
         from (select patient, max(readmission) as label from rc_kept group by 1)) using (patient)
       where record <= 200 and k <= case when label = 1 then least(pos, least(3400, pos) + greatest(16600 - neg, 0))
                                         else least(neg, least(16600, neg) + greatest(3400 - pos, 0)) end""",
    FX,
    raw_sql(P.IV)
    + """,
rc_big as (select * from rw_wide where patient in (select patient from rw_wide group by 1 having count(*) >= 8)),
rc_kept as (
    select b.* from rc_big b left join (select patient, max(visit) as last from rc_big where readmission = 1 group by 1) l on b.patient = l.patient
    where visit <= coalesce(last, visit))""",
)
def _(t: Tables):
    path = shared_folder(t.spark)
    save_table(wide_table(raw_tables(t, P.IV), P.IV), path)
    return features.cohort(t.spark.read.parquet(path), P.IV, "readmission").select("patient", "visit", "record")


BLEND = (
    """fx_all as (
    select s.*, case when r <= floor(n * 0.5::double) then 'train' when r <= floor(n * 0.5::double) + floor(n * 0.25::double) then 'val' else 'test' end as split
    from fx_scores s join (select patient, row_number() over (order by md5(concat('42-', cast(patient as varchar))), patient) as r, count(*) over () as n
                           from (select distinct patient from fx_scores)) using (patient)),
fx_val as (select * from fx_all where split <> 'test'),
"""
    + ENS.replace("fx_scores", "fx_val")
    + f""",
fx_best as ({BEST}),
fx_tb as (select y, b.alpha * p1 + (1.0::double - b.alpha) * p2 as p, b.alpha, b.t from fx_all, fx_best where split = 'test')"""
)


@query(
    "flow_blended_test",
    f"""select x.auroc, y.auprc, z.min_ps, round(b.alpha, 6) as alpha, round(b.t, 6) as t
        from ({AUC.format(t='fx_tb', p='p')}) x, ({AP.format(t='fx_tb', p='p')}) y, fx_best,
        (select round(least(tp / (tp + fp + 1e-12::double), tp / (np + 1e-12::double)), 6) as min_ps from (
           select count(*) filter (where p >= t and y = 1) as tp, count(*) filter (where p >= t and y = 0) as fp, sum(y) as np from fx_tb)) z""",
    "fx_scores",
    BLEND,
)
def _(t: Tables):
    parts = split_frames(split_by_entity(t.scores(), "patient", (0.5, 0.25), 42), "split")
    out = evaluation.blended_test(parts["train"].unionByName(parts["val"]), parts["test"])
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])
