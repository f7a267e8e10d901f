"""The queries of the dealt operators over their whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalgrid.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401
from vitalgrid.llm.ann import nearest
from vitalgrid.llm.bpe import digests
from vitalgrid.llm.class_lm import HELD_FOLD, fold_of, scores
from vitalgrid.llm.collocations import collocations
from vitalgrid.llm.line_dedup import dedup_lines
from vitalgrid.llm import main_text
from vitalgrid.llm.near_dedup import near_groups
from vitalgrid.llm.packing import pack_documents
from vitalgrid.llm.periodic import collapse_runs
from vitalgrid.llm.quality import judge, train
from vitalgrid.llm.sharding import kd_shards
from vitalgrid.llm.surrogates import replace_entities
from vitalgrid.llm.warc import round_trip

VOCABULARY = "byte_bpe_50k.json"
SURROGATE_KEY = "registered query"  # a caller's secret elsewhere
SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def vocabulary(name: str = VOCABULARY) -> str:
    """The text of a public tokenizer's file."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


@query(
    "op1_line_dedup",
    f"""
    with lines as (
      select doc_id, unnest(ls) as line, unnest(range(1, len(ls) + 1)) as pos
      from (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents)
    ), keyed as (select *, translate(trim(line, {SPACE}), {AZ}) as key from lines),
    many as (
      select key, max(doc_id) as keeper from keyed where length(key) >= 40
      group by key having count(distinct doc_id) >= 5
    )
    select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
           sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not dropped), '')) as kept_sha256
    from (select k.*, m.key is not null and k.doc_id <> m.keeper as dropped from keyed k left join many m on k.key = m.key)
    group by doc_id
    """,
)
def _(spark, folder):
    kept = dedup_lines(table(spark, folder, "documents").select("doc_id", "text"), n_lines="n_lines", n_dropped="n_dropped")
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op4_best_fit_packing")
def _(spark, folder):
    return pack_documents(table(spark, folder, "documents"), vocabulary())


@query("op9_bpe")
def _(spark, folder):
    return digests(table(spark, folder, "documents"), vocabulary())


@query(
    "op3_warc",
    """
    with p as (
      select page_id, coalesce(html, '') as html, sha256(coalesce(html, '')) as digest, strlen(coalesce(html, '')) as n from pages
    ), f as (select digest, min(page_id) as first_id from p where n >= 100 group by digest)
    select page_id, n as payload_bytes, p.digest as payload_digest,
           case when page_id > first_id then 'revisit' else 'response' end as record_type,
           case when page_id > first_id then first_id end as refers_to
    from p left join f on p.digest = f.digest
    """,
)
def _(spark, folder):
    return round_trip(table(spark, folder, "pages"))


@query("op8_kd_sharding")
def _(spark, folder):
    placed = kd_shards(table(spark, folder, "documents"), ["lang", "source", "n_chars"])
    return placed.select(
        "doc_id", F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op7_crf_quality")
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    # The text isn't needed behind the judgement.
    return judge(docs, train(docs, table(spark, folder, "labels"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_words"
    )


@query("op10_minhash_near_dedup")
def _(spark, folder):
    found = near_groups(table(spark, folder, "documents"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "class_id")


@query("op2_pruned_graph")
def _(spark, folder):
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return nearest(rows, rows.where("vec_id % 20 = 0"))


@query("op6_pii_surrogates")
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return replace_entities(docs, SURROGATE_KEY, n_entities="n_entities")


@query("op5_class_lm")
def _(spark, folder):
    return scores(table(spark, folder, "documents"), fold_of(F.col("doc_id")) == HELD_FOLD)


@query(
    "op11_tiled_collocations",
    rf"""
    with texts as (
      select row_number() over () as rid, coalesce(lang, 'und') as lang, translate(coalesce(text, ''), {AZ}) as t from documents
    ), pieces as (
      select rid, lang, unnest(ps) as piece, unnest(range(len(ps))) as pno
      from (select *, regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]') as ps from texts)
    ), words as (
      select rid, lang, pno, unnest(ws) as w, unnest(range(len(ws))) as pos
      from (select *, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces)
    ), totals as (select lang, count(*) as n from words group by lang),
    runs as (
      select lang, w as w1, ws[2] as w2, ws[3] as w3, ws[4] as w4, ws[5] as w5
      from (select lang, w, array_agg(w) over (partition by rid, pno order by pos rows between current row and 4 following) as ws from words)
    ), f as (
      select lang, k, phrase, count(*) as c from (
        select lang, 1 as k, w1 as phrase from runs
        union all select lang, 2, w1 || ' ' || w2 from runs
        union all select lang, 3, w1 || ' ' || w2 || ' ' || w3 from runs
        union all select lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 from runs
        union all select lang, 5, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 from runs
      ) where phrase is not null group by all having count(*) >= 100
    ), cuts as (
      select lang, k, phrase, c, cut, array_to_string(ws[:cut], ' ') as head, array_to_string(ws[cut + 1:], ' ') as tail
      from (select *, string_split(phrase, ' ') as ws, unnest(range(1, k)) as cut from f where k > 1)
    ), scored as (
      select x.lang, x.k, x.phrase, x.c as a, h.c as l, t.c as r, n, x.cut, (1000::hugeint * x.c * n) // (h.c::hugeint * t.c) as score
      from cuts x join f h on h.lang = x.lang and h.phrase = x.head and h.k = x.cut
      join f t on t.lang = x.lang and t.phrase = x.tail and t.k = x.k - x.cut join totals on totals.lang = x.lang
    ), low as (
      select * from scored qualify row_number() over (partition by lang, phrase, k order by score, cut) = 1
    ), kept as (
      select * from low where not exists (
        select 1 from f g where g.lang = low.lang and g.c = low.a and g.k > low.k
          and contains(' ' || g.phrase || ' ', ' ' || low.phrase || ' '))
    )
    select * from (
      select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase,
             a, l, r, n, score::bigint as score from kept)
    where rank <= 2000
    """,
)
def _(spark, folder):
    return collocations(table(spark, folder, "documents"))


@query("op12_tree_main_text")
def _(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return main_text.main_texts(pages, main_text.train(pages))


def with_planted_runs(docs):
    """Every tenth document, by its id's checksum, repeats a part of its own words to its end."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    check = F.crc32(F.col("doc_id").cast("string"))
    n = F.size("_words").cast("long")
    d = docs.withColumn("_check", check).withColumn("_g", F.expr("_check div 10"))
    d = d.withColumn("_words", F.when(F.col("_check") % 10 == 0, words))
    d = d.withColumn("_a", F.when(n > 0, F.col("_g") % n))
    d = d.withColumn("_p", 1 + F.expr("(size(_words) - _a) div (3 + _g % 8)"))
    start, period = F.col("_a").cast("int"), F.col("_p").cast("int")
    times = F.expr("(size(_words) - _a + _p - 1) div _p").cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("_words", start + 1, period), times)), F.lit(1), n.cast("int") - start)
    planted = F.array_join(F.concat(F.slice("_words", F.lit(1), start), tail), " ")
    return d.select("doc_id", F.when(F.col("_a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def _(spark, folder):
    found = collapse_runs(with_planted_runs(table(spark, folder, "documents").select("doc_id", "text")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    ahead = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r["start"].alias("at"), r["period"].alias("by"))))
    longest = found.withColumn("_top", ahead)
    length, period = F.col("_top.length"), F.col("_top.by")
    return longest.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_top.at").alias("start"), length.alias("length"), period.alias("period"),
        F.expr("1000 * _top.length div _top.by").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
