"""Scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from queryset.registry import Tables, query
from vitalgrid.functions import scalars as S
from vitalgrid.functions.series import resample
from vitalgrid.functions.texts import answer_label, fill, truncate_answer, zip_lists
from vitalgrid.operators.joins import expand
from vitalgrid.operators.lists import visit_lists

PV = ["patient", "visit"]
# Test bands over event values, with gaps and open ends.
BANDS = [(20, 40, 0), (10, 19.5, 1), (41, 60, 1), (None, 9, 2), (61, 120, 2), (130, None, 3)]
BANDS_SQL = """case when num between 20 and 40 then 0.0::double when num between 10 and 19.5 then 1.0::double when num between 41 and 60 then 1.0::double
               when num <= 9 then 2.0::double when num between 61 and 120 then 2.0::double when num >= 130 then 3.0::double end"""


@query("fn_band_score", f"select eid, {BANDS_SQL} as score from fx_events", "fx_events")
def _(t: Tables):
    return t.events().select("eid", S.band_score(F.col("num"), BANDS).alias("score"))


@query(
    "fn_flag_score",
    """select patient, visit, record, case when view > 20 then 0.0::double when click > 30 then 2.0::double end as score from fx_wide""",
    "fx_wide",
)
def _(t: Tables):
    score = S.flag_score(S.flag(F.col("view") > 20), S.flag(F.col("click") > 30))
    return t.wide().select(*PV, "record", score.alias("score"))


@query(
    "fn_onehot_mean",
    """select patient, visit, record, round(avg(k), 6) as mean_k from (
         select patient, visit, record, unnest([case when view > 20 then 3 end, case when click > 20 then 7 end,
                case when purchase > 20 then 11 end, case when error > 20 then 15 end]) as k from fx_wide) group by 1,2,3""",
    "fx_wide",
)
def _(t: Tables):
    flags = {3: "view", 7: "click", 11: "purchase", 15: "error"}
    mean = S.onehot_mean({k: S.flag(F.col(c) > 20) for k, c in flags.items()})
    return t.wide().select(*PV, "record", F.round(mean, 6).alias("mean_k"))


@query(
    "fn_row_mean",
    """select patient, visit, record, round(coalesce(list_avg([view, click, purchase, error, signup]), 0), 6) as mean from fx_wide""",
    "fx_wide",
)
def _(t: Tables):
    mean = S.row_mean([F.col(c) for c in ("view", "click", "purchase", "error", "signup")])
    return t.wide().select(*PV, "record", F.round(mean, 6).alias("mean"))


@query(
    "fn_block_score",
    "select patient, visit, record, round((coalesce(view, 0) * 4 / 15 + coalesce(click, 0)) / 8, 6) as score from fx_wide",
    "fx_wide",
)
def _(t: Tables):
    return t.wide().select(*PV, "record", F.round(S.block_score(F.col("view"), F.col("click")), 6).alias("score"))


@query(
    "fn_clip",
    "select patient, visit, record, case when view is not null then least(greatest(view, 15), 60) end as view from fx_wide",
    "fx_wide",
)
def _(t: Tables):
    return t.wide().select(*PV, "record", S.clip(F.col("view"), 15, 60).alias("view"))


@query(
    "fn_interp_pool",
    """select visit, string_agg(cast(cast(round(v * 1000000) as bigint) as varchar), ',' order by i) as points from (
         select visit, i, series[lo + 1]::double * (1 - (x - lo)) + series[least(lo + 1, n - 1) + 1]::double * (x - lo) as v from (
           select *, floor(x)::bigint as lo from (
             select visit, series, len(series) as n, i, i * (len(series) - 1) / 23.0::double as x from fx_series, range(24) r(i))))
       group by 1""",
    "fx_series",
)
def _(t: Tables):
    points = F.transform(resample(F.col("series"), 24), lambda v: F.round(v * 1000000).cast("long").cast("string"))
    return t.series().select("visit", F.array_join(points, ",").alias("points"))


@query(
    "fn_expand_columns",
    "select vec_id as visit, " + ", ".join(f'round(embedding[{i + 1}]::double, 6) as "D{i}"' for i in range(64)) + " from embeddings",
)
def _(t: Tables):
    wide = expand(t.series(), "series", "D", 64)
    return wide.select("visit", *[F.round(F.col(f"D{i}").cast("double"), 6).alias(f"D{i}") for i in range(64)])


@query("fn_sigmoid", "select patient, round(1 / (1 + exp(-(p1 * 8 - 4))), 6) as p from fx_scores", "fx_scores")
def _(t: Tables):
    return t.scores().select("patient", F.round(S.sigmoid(F.col("p1") * 8 - 4), 6).alias("p"))


@query(
    "fn_split_zip_trim",
    "select patient, visit, title as a, code as b, count(*) as n from fx_items group by 1,2,3,4",
    "fx_items",
)
def _(t: Tables):
    # Lists are joined with stray white space and taken apart again.
    rows = t.items().withColumns(
        {"title": F.concat(F.lit(" "), "title", F.lit("\t")), "code": F.concat("code", F.lit("  "))}
    )
    lists = visit_lists(rows, PV, {"codes": "code", "titles": "title"}, ["seq", "code", "title"])
    pairs = lists.select(*PV, F.explode(zip_lists(F.col("titles"), F.col("codes"))).alias("p"))
    return pairs.groupBy(*PV, F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "fn_regex_label",
    """select patient, cast(case when patient % 5 = 0 then 0 else patient % 2 end as bigint) as strict,
              cast(case when patient % 5 = 0 then 0 else patient % 2 end as bigint) as loose,
              cast(0 as bigint) as one_line_strict,
              cast(case when patient % 5 = 0 then 0 else patient % 2 end as bigint) as one_line_loose from fx_answers""",
    "fx_answers",
)
def _(t: Tables):
    one_line = F.regexp_replace("answer", r"[\r\n]+", " ")
    return t.answers().select(
        "patient",
        answer_label(F.col("answer")).cast("long").alias("strict"),
        answer_label(F.lower("answer"), strict=False).cast("long").alias("loose"),
        answer_label(one_line).cast("long").alias("one_line_strict"),
        answer_label(one_line, strict=False).cast("long").alias("one_line_loose"),
    )


@query(
    "fn_truncate_after",
    r"""select patient, md5(case when regexp_matches(answer, '(?i)#\s*prediction\s+result\s*#\s*[\r\n]+\s*[01]')
                            then regexp_extract(answer, '(?is)^(.*?#\s*prediction\s+result\s*#\s*[\r\n]+\s*[01][ \t\r\n]*)', 1)
                            else regexp_replace(regexp_replace(answer, '^\s+', ''), '\s+$', '') end) as answer from fx_answers""",
    "fx_answers",
)
def _(t: Tables):
    return t.answers().select("patient", F.md5(truncate_answer(F.col("answer"))).alias("answer"))


@query(
    "fn_template",
    "select doc_id, md5(concat('Lang ', lang, ' from ', source, ': ', text, ' {unknown}')) as filled from documents",
)
def _(t: Tables):
    text = fill("Lang {lang} from {source}: {text} {unknown}", {c: F.col(c) for c in ("lang", "source", "text")})
    return t.read("documents").select("doc_id", F.md5(text).alias("filled"))


@query(
    "fn_cast",
    """select o_orderkey as visit, cast(round(o_totalprice::float::double, 2) as double) as price,
              try_cast(o_orderpriority as bigint) as bad, cast(left(o_orderpriority, 1) as bigint) as priority from orders""",
)
def _(t: Tables):
    return t.read("orders").select(
        F.col("o_orderkey").alias("visit"),
        F.round(S.as_type(F.col("o_totalprice"), "float").cast("double"), 2).alias("price"),
        S.as_type(F.col("o_orderpriority"), "bigint", strict=False).alias("bad"),
        S.as_type(F.left("o_orderpriority", F.lit(1)), "bigint").alias("priority"),
    )
