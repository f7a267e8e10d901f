"""Readers and writers: every query writes to a fresh shared folder and reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from queryset.registry import Tables, query
from vitalgrid.functions.timing import micros
from vitalgrid.operators.sampling import split_by_entity
from vitalgrid.session import shared_folder
from vitalgrid.sources import jsonlines as JL, tables as TB

ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
CHAT = "patient long, turn long, role string, content string"


@query(
    "src_table",
    "select o_orderkey, o_custkey, round(o_totalprice, 2) as o_totalprice, epoch_us(o_orderdate) as us from orders where o_totalprice > 150000",
)
def _(t: Tables):
    orders = TB.read_table(t.spark, f"{t.folder}/orders.parquet", ORDERS)
    return orders.where("o_totalprice > 150000").select(
        "o_orderkey", "o_custkey", F.round("o_totalprice", 2).alias("o_totalprice"), micros(F.col("o_orderdate")).alias("us")
    )


# Quotes, commas, line breaks, empty text and NULL by turns.
ODD_TEXT = """case o_orderkey % 5 when 0 then 'say "' || o_orderpriority || '", twice ""' when 1 then 'a,b;' || o_orderpriority
              when 2 then 'line' || chr(10) || o_orderpriority || chr(10) when 3 then '' end"""


def _odd_text():
    p, k = F.col("o_orderpriority"), F.col("o_orderkey") % 5
    return (
        F.when(k == 0, F.concat(F.lit('say "'), p, F.lit('", twice ""'))).when(k == 1, F.concat(F.lit("a,b;"), p))
        .when(k == 2, F.concat(F.lit("line\n"), p, F.lit("\n"))).when(k == 3, "")
    )


@query(
    "src_csv",
    f"select o_orderkey, o_orderpriority, o_totalprice, {ODD_TEXT} as note, cast(4 as bigint) as n_header from orders",
)
def _(t: Tables):
    path = shared_folder(t.spark)
    rows = t.read("orders").select("o_orderkey", _odd_text().alias("note"), "o_totalprice", "o_orderpriority")
    TB.write_csv(rows, path, float_fmt="%.2f")
    schema = "o_orderkey long, note string, o_totalprice double, o_orderpriority string"
    out = TB.read_csv(t.spark, path, schema, ["o_orderkey", "o_orderpriority", "o_totalprice", "note"], multiline=True)
    return out.withColumn("n_header", F.lit(len(TB.csv_header(t.spark, path))).cast("long"))


@query(
    "snk_csv",
    f"select o_orderkey, printf('%.6f', o_totalprice) as price, {ODD_TEXT} as note, strftime(o_orderdate, '%Y-%m-%d') as day from orders",
)
def _(t: Tables):
    path = shared_folder(t.spark)
    rows = t.read("orders").select(
        "o_orderkey", F.col("o_totalprice").alias("price"), _odd_text().alias("note"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
    )
    TB.write_csv(rows, path)
    return TB.read_csv(t.spark, path, "o_orderkey long, price string, note string, day string", multiline=True)


@query("snk_jsonl", "select patient, turn, role, md5(content) as content from fx_chat", "fx_chat")
def _(t: Tables):
    path = shared_folder(t.spark)
    JL.write_jsonl(t.chat(), path)
    return JL.read_jsonl(t.spark, path, CHAT).withColumn("content", F.md5("content"))


@query("src_jsonl_strict", "select patient, turn, role, length(content) as n from fx_chat", "fx_chat")
def _(t: Tables):
    path = shared_folder(t.spark)
    JL.write_jsonl(t.chat(), path)
    return JL.read_jsonl(t.spark, path, CHAT).select("patient", "turn", "role", F.char_length("content").cast("long").alias("n"))


@query(
    "src_jsonl_tolerant",
    """select patient, turn, md5(content) as content, cast(n_bad as bigint) as skipped from
         (select *, row_number() over (partition by patient order by turn desc) as r from fx_chat),
         (select count(*) as n_bad from fx_chat where turn = 0) where r = 1""",
    "fx_chat",
)
def _(t: Tables):
    # Good lines in turn order, a blank line and a broken line per conversation.
    path = shared_folder(t.spark)
    good = t.chat().select("patient", "turn", F.to_json(F.struct("patient", "turn", "role", "content")).alias("value"))
    first = t.chat().where("turn = 0").select("patient", F.lit(-1).cast("long").alias("turn"))
    bad = first.withColumn("value", F.lit('{"patient": 1, "content": "cut'))
    blank = first.withColumn("value", F.lit("   "))
    lines = good.unionByName(bad).unionByName(blank)
    # Whole conversations stay in one file, in turn order: "last wins" means the last turn.
    lines.repartition("patient").sortWithinPartitions("patient", "turn").select("value").write.text(path)
    records, seen = JL.read_jsonl_tolerant(t.spark, path, CHAT, "patient")
    cleaned = shared_folder(t.spark)
    JL.write_jsonl(records, cleaned)
    out = JL.read_jsonl(t.spark, cleaned, CHAT)
    return out.select("patient", "turn", F.md5("content").alias("content"), F.lit(seen.get["skipped"]).cast("long").alias("skipped"))


@query("snk_append_resume", "select doc_id, length(text) as n, cast(1 as bigint) as copies from documents")
def _(t: Tables):
    path = shared_folder(t.spark)
    docs = t.read("documents").select("doc_id", "lang", F.char_length("text").cast("long").alias("n"))
    JL.append_new(docs.where("lang = 'en'"), path, "doc_id", ["doc_id", "n"])
    docs = docs.drop("lang")
    # Every key comes twice, in slices; a second run adds nothing.
    JL.append_new(docs.union(docs), path, "doc_id", slices=3)
    JL.append_new(docs, path, "doc_id")
    stored = JL.read_appended(t.spark, path, "doc_id long, n long")
    return stored.groupBy("doc_id").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("copies"))


@query(
    "snk_params",
    "select patient, cast(case when p1 >= m then 1 else 0 end as bigint) as hit, 0.5::double as fallback from fx_scores, (select round(avg(p1), 4) as m from fx_scores)",
    "fx_scores",
)
def _(t: Tables):
    path = shared_folder(t.spark)
    fitted = t.scores().agg(F.round(F.avg("p1"), 4).alias("value")).select(F.lit("threshold").alias("name"), "value")
    TB.save_params(fitted, path)
    thr = TB.load_param(t.spark, path, "threshold", 0.5)
    other = TB.load_param(t.spark, path + "-absent", "threshold", 0.5)
    return t.scores().select(
        "patient", F.when(F.col("p1") >= thr, 1).otherwise(0).cast("long").alias("hit"), F.lit(other).alias("fallback")
    )


@query("snk_ctas", "select patient, visit, n_events from fx_visits", "fx_visits")
def _(t: Tables):
    path = shared_folder(t.spark)
    table = t.visits().select("patient", "visit", "n_events")
    TB.save_table(table.where("visit = 0"), path)
    TB.save_table(table, path)
    return t.spark.read.parquet(path)


@query(
    "snk_partitioned",
    """select patient, label, case when r <= floor(n * 0.7::double) then 'train'
              when r <= floor(n * 0.7::double) + floor(n * 0.1::double) then 'val' else 'test' end as split
       from (select *, row_number() over (order by md5(concat('42-', cast(patient as varchar))), patient) as r, count(*) over () as n from fx_cohort)""",
    "fx_cohort",
)
def _(t: Tables):
    path = shared_folder(t.spark)
    TB.save_table(split_by_entity(t.cohort(), "patient", (0.7, 0.1), 42), path, ["split"])
    return t.spark.read.parquet(path).select("patient", "label", "split")


@query("srt_global", "select patient, visit, record from fx_grid order by patient, visit, record", "fx_grid")
def _(t: Tables):
    return TB.sorted_export(t.grid().select("patient", "visit", "record"), ["patient", "visit", "record"])
