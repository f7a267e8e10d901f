"""Line dedup: one holder keeps a line that many documents repeat.

Line hashes, never texts, are range-partitioned with documents and positions as
secondary order. The first run of a hash belongs to the largest document id; it
is the keeper. What the others lose comes back as one compressed bitmap per document.

Defined cases: a null or empty text is one empty line, and empty lines have no
key; a document without a doc_id is nobody's copy and stays whole; rows with the
same doc_id count as one document, each with its own bitmap; equal rows get equal
bitmaps; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from vitalgrid.llm.common import BLANKS, LOWER, UPPER, content_key, free_name, stored
from vitalgrid.session import materialize

MIN_CHARS = 40
MIN_DOCS = 5


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """Equal for two lines if and only if they are equal stripped and with A-Z lower-cased.

    ``lower`` folds more letters than A-Z, so a line with other letters than ASCII
    carries these as they stand, with a mark for each run between them. This is
    several times faster than ``translate``, which is left for the two letters
    whose lower case has ASCII in it.
    """
    folded = F.concat(F.lower(line), F.lit("\n"), F.regexp_replace(line, r"[\x00-\x7F]+", "_"))
    return (
        F.when(F.octet_length(line) == F.char_length(line), F.lower(line))
        .when(F.contains(line, F.lit("\u212a")) | F.contains(line, F.lit("\u0130")), F.concat(F.lit("\n\n"), F.translate(line, UPPER, LOWER)))
        .otherwise(folded)
    )


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, content, words): which lines each document keeps.

    ``words`` is a sparse bitmap of 64-line words: only words with a dropped line are
    stored, and a document that loses nothing has no row. ``content`` is
    ``content_key`` of the row's text.
    """
    lines = docs.where("doc_id is not null").select(
        "doc_id", content_key(F.col("text")).alias("content"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line")
    )
    # ~doc_id falls as doc_id grows, for every long: the largest document comes first.
    postings = lines.withColumn("line", F.btrim("line", F.lit(BLANKS))).where(F.char_length("line") >= min_chars).select(
        F.unhex(F.md5(line_key(F.col("line")))).alias("hash"), F.bitwise_not("doc_id").alias("rdoc"), "content", "pos"
    )
    postings = stored(postings)
    order = ["hash", "rdoc", "content", "pos"]
    # The range bounds fall inside a frequent hash, so its run is spread over several tasks.
    runs = postings.repartitionByRange("hash", "rdoc").sortWithinPartitions(*order)
    in_doc = F.row_number().over(W.partitionBy("hash", "rdoc").orderBy("content", "pos"))
    firsts = (
        runs.withColumn("nth", in_doc).where("nth = 1")
        .groupBy("hash").agg(F.min("rdoc").alias("keeper"), F.count(F.lit(1)).alias("n_docs"))
        .where(F.col("n_docs") >= min_docs).select("hash", "keeper")
    )
    # Apart from the join, so that it can split a frequent hash over several tasks.
    firsts = materialize(firsts)
    dropped = postings.join(firsts, "hash").where("rdoc <> keeper")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos").bitwiseAND(63))
    return (
        dropped.groupBy("rdoc", "content", F.shiftright("pos", 6).alias("word"))
        .agg(F.bitwise_not(F.bit_or(bit)).alias("bits"))
        .groupBy("rdoc", "content").agg(F.collect_list(F.struct("word", "bits")).alias("words"))
        .select(F.bitwise_not("rdoc").alias("doc_id"), "content", "words")
    )


def _dense(words: Column) -> Column:
    """All words up to the last stored one; a word that isn't stored is all ones."""
    sparse = F.map_from_entries(words)
    full = F.lit(-1).cast("long")
    return F.transform(
        F.sequence(F.lit(0), F.array_max(F.map_keys(sparse))), lambda w: F.coalesce(F.try_element_at(sparse, w), full)
    )


def _set_lines(lines: Column, dense: Column) -> Column:
    def stays(_: Column, i: Column) -> Column:
        return F.coalesce(F.getbit(F.get(dense, F.shiftright(i, 6)), i.bitwiseAND(63)), F.lit(1)) == 1

    return F.filter(lines, stays)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, n_lines: str | None = None, n_dropped: str | None = None) -> DataFrame:
    """``docs`` with the kept lines as text; optionally the counts of lines and of dropped lines.

    A count replaces a column of its name.
    """
    key, doc, mark, words, dense, kept = (free_name(docs, f"_{n}") for n in ("content", "doc", "mark", "words", "dense", "kept"))
    marks = bitmaps.select(F.col("doc_id").alias(doc), F.col("content").alias(mark), F.col("words").alias(words))
    rows = docs.withColumn(key, content_key(F.col("text")))
    rows = rows.join(marks, (rows["doc_id"] == marks[doc]) & (rows[key] == marks[mark]), "left")
    cut = F.col(words).isNotNull()
    rows = rows.withColumn(dense, F.when(cut, _dense(F.col(words))))
    rows = rows.withColumn(kept, F.when(cut, _set_lines(lines_of(F.col("text")), F.col(dense))))
    # A text is split for counting only where it lost lines; elsewhere its line breaks are counted.
    all_lines = F.coalesce(F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"))), F.lit(0)) + 1
    extra = {}
    if n_lines:
        extra[n_lines] = all_lines
    if n_dropped:
        extra[n_dropped] = F.when(F.col(kept).isNotNull(), all_lines - F.size(kept)).otherwise(0)
    text = F.when(F.col(kept).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text")
    stay = [c for c in docs.columns if c.lower() not in {n.lower() for n in extra}]
    return rows.select(
        *[text if c.lower() == "text" else docs[c] for c in stay], *[x.cast("long").alias(n) for n, x in extra.items()]
    )


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, **counts: str) -> DataFrame:
    return apply_bitmaps(docs, keep_bitmaps(docs, min_chars, min_docs), **counts)
