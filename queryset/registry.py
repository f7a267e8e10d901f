"""Query registry, and the fixture views in both dialects.

A view is written once as SQL for the oracle and once with the DataFrame API.
An oracle names the views it uses; their text goes in front of it.
"""

from __future__ import annotations

from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitalgrid.functions.scalars import flag
from vitalgrid.session import shared_folder, tune
from vitalgrid.sources.tables import save_table

Query = Callable[["Tables"], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

VIEWS = {
    "fx_visits": """
        select user_id as patient, cast(floor((day(ts)-1)/5) as bigint) as visit,
               min(ts) as admit, max(ts) as discharge,
               cast(max(case when event_type='error' and value>200 then 1 else 0 end) as bigint) as outcome,
               count(*) as n_events
        from events group by 1,2""",
    "fx_events": """
        select event_id as eid, user_id as patient, cast(floor((day(ts)-1)/5) as bigint) as visit, ts,
               event_type as item, value as num, props as txt
        from events""",
    "fx_admissions": """
        select o_custkey as patient, o_orderkey as visit, o_orderdate as admit,
               o_orderdate + (o_orderkey % 9) * interval '1' day + (o_orderkey % 24) * interval '1' hour as discharge,
               cast(case when o_orderstatus='F' and o_orderkey % 20 = 0 then 1 else 0 end as bigint) as outcome
        from orders""",
    "fx_items": """
        select o_custkey as patient, o_orderkey as visit, l_linenumber as seq,
               p_brand as code, p_name as title, p_size as version
        from orders join lineitem on o_orderkey=l_orderkey join part on l_partkey=p_partkey""",
    "fx_cohort": """
        select c_custkey as patient, cast(case when c_mktsegment='BUILDING' then 1 else 0 end as bigint) as label
        from customer""",
    "fx_answers": """
        select doc_id as patient,
               concat('# Reasoning #', chr(10), text,
                      case when doc_id % 7 = 0 then ' so the outcome IS 1' else '' end,
                      case when doc_id % 5 = 0 then ''
                           else concat(chr(10), chr(10), '# Prediction Result #', chr(10), chr(10), ' ',
                                       cast(doc_id % 2 as varchar), chr(10), 'tail') end) as answer
        from documents""",
    "fx_scores": """
        select l.doc_id as patient, cast(l.toxic as bigint) as y,
               cast(d.n_chars % 100 as double) / 100 as p1,
               case when l.quality=0 then cast(1 as double) else cast(0 as double) end as p2
        from labels l join documents d on l.doc_id=d.doc_id""",
    "fx_series": "select vec_id as visit, embedding as series from embeddings",
    "fx_chat": "select conv_id as patient, turn, role, text as content from conversations",
    # 12-hour windows of the event visits, and their events.
    "fx_grid": """
        select patient, visit, outcome, admit, discharge, k + 1 as record, admit + k * interval '12' hour as w0
        from (select *, unnest(range(0, cast(floor((epoch_us(discharge) - epoch_us(admit) - 1000000)
                     / 43200000000) + 1 as bigint))) as k
              from fx_visits where epoch_us(discharge) - epoch_us(admit) >= 1000000) g""",
    "fx_hits": """
        select g.patient, g.visit, g.record, g.outcome, e.item, e.num, e.txt
        from fx_grid g left join fx_events e
          on e.patient = g.patient and e.visit = g.visit and e.ts >= g.w0 and e.ts < g.w0 + interval '12' hour""",
    # Window records with one column per item kind, NULL where nothing was measured.
    "fx_wide": """
        select patient, visit, record, max(outcome) as outcome,
               max(case when item='view' then num end) as view,
               max(case when item='click' then num end) as click,
               max(case when item='purchase' then num end) as purchase,
               max(case when item='error' then num end) as error,
               max(case when item='signup' then num end) as signup
        from fx_hits group by 1,2,3""",
    # Events numbered inside their visit: a record series without gaps.
    "fx_records": """
        select *, row_number() over (partition by patient, visit order by ts, eid) as record,
               count(*) over (partition by patient, visit) as n_rec
        from fx_events""",
}
NEEDS = {
    "fx_grid": ["fx_visits"],
    "fx_hits": ["fx_visits", "fx_events", "fx_grid"],
    "fx_wide": ["fx_visits", "fx_events", "fx_grid", "fx_hits"],
    "fx_records": ["fx_events"],
}


def query(name: str, sql: str | None = None, views: str = "", extra: str = ""):
    """Register a query; ``views`` are the fixture views its SQL uses, ``extra`` more common tables."""

    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            wanted: list[str] = []
            for v in views.split():
                wanted += [n for n in [*NEEDS.get(v, []), v] if n not in wanted]
            tables = [f"{v} as ({dedent(VIEWS[v]).strip()})" for v in wanted]
            if extra:
                tables.append(dedent(extra).strip())
            head = "with " + ",\n".join(tables) + "\n" if tables else ""
            ORACLES[name] = head + dedent(sql).strip()
        return fn

    return keep


class Tables:
    """The given tables and the fixture views as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def stored(self, df: DataFrame) -> DataFrame:
        """Write an intermediate table to the shared folder and read it back: computed once, whoever reads it."""
        path = shared_folder(self.spark)
        save_table(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def visits(self) -> DataFrame:
        return (
            self.read("events")
            .groupBy(F.col("user_id").alias("patient"), _visit().alias("visit"))
            .agg(
                F.min("ts").alias("admit"),
                F.max("ts").alias("discharge"),
                F.max(flag((F.col("event_type") == "error") & (F.col("value") > 200))).cast("long").alias("outcome"),
                F.count(F.lit(1)).alias("n_events"),
            )
        )

    def events(self) -> DataFrame:
        return self.read("events").select(
            F.col("event_id").alias("eid"), F.col("user_id").alias("patient"), _visit().alias("visit"), "ts",
            F.col("event_type").alias("item"), F.col("value").alias("num"), F.col("props").alias("txt"),
        )

    def admissions(self) -> DataFrame:
        key, date = F.col("o_orderkey"), F.col("o_orderdate")
        stay = F.make_dt_interval(days=(key % 9).cast("int"), hours=(key % 24).cast("int"))
        return self.read("orders").select(
            F.col("o_custkey").alias("patient"), key.alias("visit"), date.alias("admit"),
            (date + stay).alias("discharge"),
            flag((F.col("o_orderstatus") == "F") & (key % 20 == 0)).cast("long").alias("outcome"),
        )

    def items(self) -> DataFrame:
        orders = self.read("orders").select("o_orderkey", "o_custkey")
        lines = self.read("lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
        part = self.read("part").select("p_partkey", "p_brand", "p_name", "p_size")
        return (
            lines.join(orders, lines.l_orderkey == orders.o_orderkey)
            .join(part, lines.l_partkey == part.p_partkey)
            .select(
                F.col("o_custkey").alias("patient"), F.col("o_orderkey").alias("visit"),
                F.col("l_linenumber").alias("seq"), F.col("p_brand").alias("code"), F.col("p_name").alias("title"),
                F.col("p_size").alias("version"),
            )
        )

    def cohort(self) -> DataFrame:
        return self.read("customer").select(
            F.col("c_custkey").alias("patient"), flag(F.col("c_mktsegment") == "BUILDING").cast("long").alias("label")
        )

    def answers(self) -> DataFrame:
        doc = F.col("doc_id")
        leak = F.when(doc % 7 == 0, F.lit(" so the outcome IS 1")).otherwise(F.lit(""))
        block = F.concat(F.lit("\n\n# Prediction Result #\n\n "), (doc % 2).cast("string"), F.lit("\ntail"))
        tail = F.when(doc % 5 == 0, F.lit("")).otherwise(block)
        return self.read("documents").select(
            doc.alias("patient"), F.concat(F.lit("# Reasoning #\n"), F.col("text"), leak, tail).alias("answer")
        )

    def scores(self) -> DataFrame:
        docs = self.read("documents").select("doc_id", "n_chars")
        return (
            self.read("labels")
            .join(docs, "doc_id")
            .select(
                F.col("doc_id").alias("patient"), F.col("toxic").cast("long").alias("y"),
                ((F.col("n_chars") % 100).cast("double") / 100).alias("p1"),
                F.when(F.col("quality") == 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias("p2"),
            )
        )

    def series(self) -> DataFrame:
        return self.read("embeddings").select(F.col("vec_id").alias("visit"), F.col("embedding").alias("series"))

    def chat(self) -> DataFrame:
        return self.read("conversations").select(
            F.col("conv_id").alias("patient"), "turn", "role", F.col("text").alias("content")
        )

    def grid(self) -> DataFrame:
        from vitalgrid.operators.visits import time_grid

        return time_grid(self.visits(), "admit", "discharge", 12)

    def placed(self) -> DataFrame:
        from vitalgrid.operators.events import events_in_windows

        return events_in_windows(self.visits(), self.events(), ["patient", "visit"], "admit", "discharge", "ts", 12)

    def hits(self) -> DataFrame:
        from vitalgrid.operators.events import window_join

        grid = self.grid().select("patient", "visit", "outcome", "record", "record_start")
        return window_join(
            grid, self.visits(), self.events(), ["patient", "visit"], "admit", "discharge", "ts", 12,
            values=["item", "num", "txt"], start="record_start",
        ).drop("record_start")

    def wide(self) -> DataFrame:
        from vitalgrid.operators.events import max_of, pivot_items

        keys = ["patient", "visit", "record"]
        grid = self.grid().select(*keys, "outcome")
        spec = {i: max_of("item", [i], "num") for i in ITEMS}
        return grid.join(pivot_items(self.placed(), keys, spec), keys, "left")

    def records(self) -> DataFrame:
        from vitalgrid.operators.ordered import ordinal
        from vitalgrid.functions.timing import US_PER_HOUR

        return ordinal(
            self.events(), ["patient", "visit"], ["ts", "eid"], out="record", size="n_rec", stride=6 * US_PER_HOUR
        )


ITEMS = ["view", "click", "purchase", "error", "signup"]


def _visit():
    return F.floor((F.day("ts") - 1) / F.lit(5)).cast("long")
