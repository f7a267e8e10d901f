"""Ranking metrics, thresholds, blending and the baseline model."""

from __future__ import annotations

from pyspark.sql import functions as F

from queryset.registry import Tables, query
from vitalgrid.functions.scalars import blend
from vitalgrid.operators import metrics as M
from vitalgrid.operators.ensemble import evaluate, grid_search, grid_table
from vitalgrid.operators.inference import fit_baseline, score_baseline
from vitalgrid.operators.joins import split_frames
from vitalgrid.operators.sampling import split_by_entity


def rounded(df, *cols: str):
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


AP = """select round(sum((r - prev) * precision), 6) as auprc from (
    select tp / (select sum(y) from {t})::double as r, coalesce(lag(tp) over (order by p desc), 0) / (select sum(y) from {t})::double as prev, tp / (tp + fp)::double as precision
    from (select p, sum(pos) over (order by p desc) as tp, sum(neg) over (order by p desc) as fp
          from (select {p} as p, sum(y) as pos, sum(1 - y) as neg from {t} group by 1)))"""
AUC = """select round(avg(case when a.p > b.p then 1.0::double when a.p = b.p then 0.5::double else 0.0::double end), 6) as auroc
    from (select {p} as p from {t} where y = 1) a, (select {p} as p from {t} where y = 0) b"""


@query("met_auroc", AUC.format(t="fx_scores", p="p1"), "fx_scores")
def _(t: Tables):
    return rounded(M.auroc(t.scores(), "y", "p1"), "auroc")


@query("met_auprc", AP.format(t="fx_scores", p="p1"), "fx_scores")
def _(t: Tables):
    return rounded(M.auprc(t.scores(), "y", "p1"), "auprc")


@query(
    "met_auroc_by_group",
    """select p2 as g, round(sum(case when p = 1 then 1.0::double when p = 0 then 0.5::double else 0 end) / count(*), 6) as auroc
       from (select a.p2, case when a.p1 > b.p1 then 1 when a.p1 = b.p1 then 0 else -1 end as p
             from fx_scores a join fx_scores b on a.p2 = b.p2 and a.y = 1 and b.y = 0) group by 1""",
    "fx_scores",
)
def _(t: Tables):
    return rounded(M.auroc(t.scores().withColumnRenamed("p2", "g"), "y", "p1", ["g"]), "auroc")


CONFUSION = """fx_conf as (
    select count(*) filter (where p1 >= 0.4 and y = 1) as tp, count(*) filter (where p1 >= 0.4 and y = 0) as fp,
           count(*) filter (where p1 < 0.4 and y = 1) as fn, count(*) filter (where p1 < 0.4 and y = 0) as tn from fx_scores)"""


@query(
    "met_confusion",
    """select tp, fp, fn, tn, round(tp / (tp + fp)::double, 6) as precision, round(tp / (tp + fn)::double, 6) as recall,
              round(least(tp / (tp + fp)::double, tp / (tp + fn)::double), 6) as min_ps from fx_conf""",
    "fx_scores",
    CONFUSION,
)
def _(t: Tables):
    return rounded(M.confusion(t.scores(), "y", "p1", 0.4), "precision", "recall", "min_ps")


@query(
    "met_confusion_eps",
    """select tp, fp, fn, tn, round(tp / (tp + fp + 1e-12::double), 6) as precision, round(tp / (tp + fn + 1e-12::double), 6) as recall,
              round(least(tp / (tp + fp + 1e-12::double), tp / (tp + fn + 1e-12::double)), 6) as min_ps from fx_conf""",
    "fx_scores",
    CONFUSION,
)
def _(t: Tables):
    return rounded(M.confusion(t.scores(), "y", "p1", 0.4, M.EPSILON), "precision", "recall", "min_ps")


@query(
    "met_f1",
    """select round(2 * pr * rc / (pr + rc), 6) as f1, round(rc, 6) as recall from (
         select count(*) filter (where p1 >= 0.5 and y = 1) / nullif(count(*) filter (where p1 >= 0.5), 0)::double as pr,
                count(*) filter (where p1 >= 0.5 and y = 1) / count(*) filter (where y = 1)::double as rc from fx_scores)""",
    "fx_scores",
)
def _(t: Tables):
    return rounded(M.f1(t.scores(), "y", "p1"), "f1", "recall")


@query(
    "met_logloss",
    """select round(avg(case when y = 1 then -ln(q) else -ln(1 - q) end), 6) as logloss
       from (select y, least(greatest(p1, 0.0000001::double), 1 - 0.0000001::double) as q from fx_scores)""",
    "fx_scores",
)
def _(t: Tables):
    return rounded(M.logloss(t.scores(), "y", "p1"), "logloss")


def _grid(first: str, last: str, n: int) -> str:
    return f"""fx_grid_t as (
        select t, round(case when tp + fp = 0 then 0 else tp / (tp + fp)::double end, 9) as precision, round(tp / np::double, 9) as recall,
               round(least(case when tp + fp = 0 then 0 else tp / (tp + fp)::double end, tp / np::double), 9) as min_ps
        from (select t, count(*) filter (where p1 >= t and y = 1) as tp, count(*) filter (where p1 >= t and y = 0) as fp,
                     count(*) filter (where y = 1) as np
              from fx_scores, (select case when i = {n - 1} then {last}::double
                                      else {first}::double + i * (({last}::double - {first}::double) / {n - 1}) end as t from range({n}) r(i)) group by 1))"""


def table19(t: Tables, first: float, last: float):
    return M.threshold_table(M.score_counts(t.scores(), "y", "p1"), first, last, 19)


@query(
    "thr_minps_max",
    "select round(max(min_ps), 6) as value from fx_grid_t",
    "fx_scores",
    _grid("0.01", "0.99", 19),
)
def _(t: Tables):
    best = M.best_threshold(table19(t, 0.01, 0.99), "min_ps")
    return rounded(best.select("value"), "value")


@query(
    "thr_minps_argmax",
    "select round(t, 6) as t, round(min_ps, 6) as value from fx_grid_t order by fx_grid_t.min_ps desc, fx_grid_t.t limit 1",
    "fx_scores",
    _grid("0.05", "0.95", 19),
)
def _(t: Tables):
    return rounded(M.best_threshold(table19(t, 0.05, 0.95), "min_ps"), "t", "value")


@query(
    "thr_best_recall",
    "select round(t, 6) as t, round(recall, 6) as value from fx_grid_t order by fx_grid_t.recall desc, fx_grid_t.t limit 1",
    "fx_scores",
    _grid("0.01", "0.99", 19),
)
def _(t: Tables):
    return rounded(M.best_threshold(table19(t, 0.01, 0.99), "recall"), "t", "value")


@query("ens_blend", "select patient, round(0.3 * p1 + 0.7 * p2, 6) as p from fx_scores", "fx_scores")
def _(t: Tables):
    return t.scores().select("patient", F.round(blend(F.col("p1"), F.col("p2"), 0.3), 6).alias("p"))


# The whole grid in SQL. Scores and thresholds are spread as they are; the best
# point is found by comparing rounded measures in order.
ENS = """fx_alpha as (select i as a_no, case when i = 100 then 1.0::double else i * (1.0::double / 100) end as alpha from range(101) r(i)),
fx_mix as (select a_no, alpha, alpha * p1 + (1.0::double - alpha) * p2 as p, sum(y) as pos, sum(1 - y) as neg from fx_scores, fx_alpha group by all),
fx_run as (select *, sum(pos) over (partition by a_no order by p desc) as tp, sum(neg) over (partition by a_no order by p desc) as fp,
                  sum(pos) over (partition by a_no) as np, sum(neg) over (partition by a_no) as nn from fx_mix),
fx_rank as (select a_no, alpha, sum(neg * ((tp - pos) + pos / 2.0::double)) / max(np * nn) as auroc, sum(pos / np::double * tp / (tp + fp)) as auprc
            from fx_run group by 1,2),
fx_t as (select i as t_no, case when i = 180 then 0.99::double else 0.01::double + i * ((0.99::double - 0.01::double) / 180) end as t from range(181) r(i)),
fx_cells as (select m.a_no, t_no, t, sum(case when p >= t then pos else 0 end) as tp, sum(case when p >= t then neg else 0 end) as fp, sum(pos) as np
             from fx_mix m, fx_t group by all),
fx_points as (select r.a_no, r.alpha, c.t_no, c.t, r.auroc, r.auprc, least(tp / (tp + fp + 1e-12::double), tp / (np + 1e-12::double)) as min_ps
              from fx_rank r join fx_cells c on r.a_no = c.a_no)"""

BEST = """select list_reduce(list({'alpha': alpha, 't': t, 'auroc': auroc, 'auprc': auprc, 'min_ps': min_ps} order by a_no, t_no),
    lambda x, y: case when y.auroc > x.auroc
        or (abs(y.auroc - x.auroc) <= 1e-8::double + 1e-5::double * abs(x.auroc) and y.auprc > x.auprc)
        or (abs(y.auroc - x.auroc) <= 1e-8::double + 1e-5::double * abs(x.auroc)
            and abs(y.auprc - x.auprc) <= 1e-8::double + 1e-5::double * abs(x.auprc) and y.min_ps > x.min_ps) then y else x end) as b
    from fx_points"""


@query(
    "ens_grid",
    """select a_no, t_no, round(alpha, 6) as alpha, round(t, 6) as t, round(auroc, 6) as auroc, round(auprc, 6) as auprc, round(min_ps, 6) as min_ps
       from fx_points""",
    "fx_scores",
    ENS,
)
def _(t: Tables):
    out = grid_table(t.scores(), "y", "p1", "p2")
    out = rounded(out, "alpha", "t", "auroc", "auprc", "min_ps")
    return out.withColumns({"a_no": F.col("a_no").cast("long"), "t_no": F.col("t_no").cast("long")})


@query(
    "ens_grid_best",
    f"""select round(b.alpha, 6) as alpha, round(b.t, 6) as t, round(b.auroc, 6) as auroc, round(b.auprc, 6) as auprc, round(b.min_ps, 6) as min_ps
        from ({BEST})""",
    "fx_scores",
    ENS,
)
def _(t: Tables):
    out = grid_search(t.scores(), "y", "p1", "p2")
    return rounded(out, *out.columns)


@query(
    "ens_apply",
    f"""select x.auroc, y.auprc, z.min_ps from ({AUC.format(t='fx_blend', p='p')}) x, ({AP.format(t='fx_blend', p='p')}) y,
        (select round(least(tp / (tp + fp + 1e-12::double), tp / (np + 1e-12::double)), 6) as min_ps from (
           select count(*) filter (where p >= 0.35 and y = 1) as tp, count(*) filter (where p >= 0.35 and y = 0) as fp, sum(y) as np from fx_blend)) z""",
    "fx_scores",
    "fx_blend as (select y, 0.6::double * p1 + (1.0::double - 0.6::double) * p2 as p from fx_scores)",
)
def _(t: Tables):
    return rounded(evaluate(t.scores(), "y", "p1", "p2", 0.6, 0.35), "auroc", "auprc", "min_ps")


@query(
    "mdl_baseline",
    """with e as (
         select vec_id, label % 2 as y, case when embedding[1] > 0 then 1 else 0 end as x,
                row_number() over (order by md5(concat('42-', cast(vec_id as varchar))), vec_id) as r, count(*) over () as n from embeddings),
       m as (select 1.0::double / avg(y) - 1 as w from e where r <= floor(n * 0.7::double)),
       f as (select x, sum(y) * max(w) / (sum(y) * max(w) + sum(1 - y)) as p from e, m where r <= floor(n * 0.7::double) group by x)
       select vec_id, round(p, 4) as p from e join f on e.x = f.x""",
)
def _(t: Tables):
    # One binary feature and no penalty: the fit is the weighted two by two table.
    rows = t.read("embeddings").select(
        "vec_id", (F.col("label") % 2).cast("double").alias("y"), (F.col("embedding")[0] > 0).cast("double").alias("x")
    )
    parts = split_frames(split_by_entity(rows, "vec_id", (0.7, 0.1), 42), "split")
    grid = [{"regParam": 0.0, "tol": 1e-9}, {"regParam": 1.0}]
    model = fit_baseline(parts["train"], parts["val"], ["x"], "y", grid)
    return score_baseline(model, rows, "vec_id").withColumn("p", F.round("p", 4))
