"""Cohort report: one long table of measures and most common entries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from vitalgrid.operators.joins import keep_ids
from vitalgrid.operators.lists import top_items, top_pairs
from vitalgrid.operators.profile import cohort_profile, deceased

KEYS = ["patient", "visit"]


def report(records: DataFrame, k: int = 10) -> DataFrame:
    """(who, kind, place, name, value) from a cohort's wide records.

    ``profile`` rows carry the measures of the whole cohort; the lists are given for
    all patients and for the deceased ones.
    """
    measures = cohort_profile(records, "patient", "visit", ["record"], "outcome", "los", "readmission")
    named = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in measures.columns])
    profile = measures.select(F.posexplode(named).alias("at", "x")).select(
        F.lit("all").alias("who"), F.lit("profile").alias("kind"), (F.col("at") + 1).cast("long").alias("place"), "x.name", "x.value"
    )
    lists = records.where("record = 1")
    groups = {"all": lists, "dead": keep_ids(lists, deceased(records, "patient", "outcome"), "patient")}
    parts = [profile]
    for who, rows in groups.items():
        pair = F.concat_ws(" / ", "title", "code").alias("name")
        tops = {
            "condition": top_pairs(rows, "condition_titles", "condition_codes", k).select(pair, "n"),
            "medication": top_items(rows, "medications", k).select(F.col("item").alias("name"), "n"),
            "procedure": top_pairs(rows, "procedure_titles", "procedure_codes", k).select(pair, "n"),
        }
        for kind, top in tops.items():
            marked = top.select(F.lit(who).alias("who"), F.lit(kind).alias("kind"), "name", "n")
            place = F.row_number().over(Window.partitionBy("who", "kind").orderBy(F.desc("n"), "name"))  # k rows
            parts.append(marked.select("who", "kind", place.cast("long").alias("place"), "name", F.col("n").cast("double").alias("value")))
    return reduce(DataFrame.unionByName, parts)
