"""Blending of two probability sources and the search for weight and threshold."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalgrid.functions.scalars import blend
from vitalgrid.operators.metrics import EPSILON, confusion, linspace, ranking_from_counts, score_counts, with_rates
from vitalgrid.session import materialize

ALPHAS = 101
THRESHOLDS = (0.01, 0.99, 181)
#: Score pairs that a task blends at once, scores of one weight that a task puts together, pairs that the cuts are taken from.
BLOCK_PAIRS = 1 << 17
CHUNK_SCORES = 1 << 19
CUT_SAMPLE = 200_000


def score_pairs(df: DataFrame, y: str, p1: str, p2: str) -> DataFrame:
    """Positives and negatives per distinct pair of scores: (a, b, pos, neg). A pair with a NULL is not ranked."""
    return df.where(F.col(p1).isNotNull() & F.col(p2).isNotNull()).groupBy(
        F.col(p1).cast("double").alias("a"), F.col(p2).cast("double").alias("b")
    ).agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))


def _merged(p: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct scores in ascending order with their counts. NaN is no score."""
    order = np.argsort(p, kind="stable")
    order = order[: len(p) - int(np.isnan(p).sum())]  # NaN sorts last
    p, pos, neg = p[order], pos[order], neg[order]
    first = np.flatnonzero(np.append(True, p[1:] != p[:-1])) if len(p) else np.zeros(0, int)
    return (p[first], np.add.reduceat(pos, first), np.add.reduceat(neg, first)) if len(p) else (p, pos, neg)


def _pack(p: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> bytes:
    return p.astype("<f8").tobytes() + pos.astype("<i8").tobytes() + neg.astype("<i8").tobytes()


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(data) // 24
    return np.frombuffer(data, "<f8", n), np.frombuffer(data, "<i8", n, 8 * n), np.frombuffer(data, "<i8", n, 16 * n)


def _score_cuts(pairs: DataFrame, n: int, alphas: list[float]) -> list[np.ndarray]:
    """Per weight, the scores at which its chunks begin; they decide the chunks' sizes, never a result."""
    parts = -(-n // CHUNK_SCORES)
    if parts <= 1:
        return [np.zeros(0)] * len(alphas)
    every = max(1, n // CUT_SAMPLE)
    seen = pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(every)) == 0).select("a", "b").toPandas()  # about CUT_SAMPLE rows
    a, b, places = seen["a"].to_numpy(), seen["b"].to_numpy(), np.arange(1, parts) / parts
    cuts = []
    for w in alphas:
        with np.errstate(invalid="ignore"):
            p = np.sort(w * a + (1.0 - w) * b)
        p = p[~np.isnan(p)]
        cuts.append(np.unique(p[(places * len(p)).astype(int)]) if len(p) else np.zeros(0))
    return cuts


def packed_scores(pairs: DataFrame, alphas: list[float], cuts: list[np.ndarray], ts: list[float]) -> DataFrame:
    """(a_no, chunk, scores): the blended scores of a block of pairs, a row per weight and chunk, merged and in order.

    Chunk -1 holds the block's positives and negatives at or above each threshold.
    """
    at = np.array(ts)

    def block(a, b, pos, neg):
        out = []
        for k, w in enumerate(alphas):
            with np.errstate(invalid="ignore"):
                p, up, down = _merged(w * a + (1.0 - w) * b, pos, neg)
            if not len(p):
                continue
            reach = np.searchsorted(p, at, "left")
            above = [x.sum() - np.append(0, np.cumsum(x))[reach] for x in (up, down)]
            out.append((k, -1, np.concatenate(above).astype("<i8").tobytes()))
            ends = np.append(np.searchsorted(p, cuts[k], "left"), len(p))
            for chunk, (i, j) in enumerate(zip(np.append(0, ends[:-1]), ends)):
                if j > i:
                    out.append((k, chunk, _pack(p[i:j], up[i:j], down[i:j])))
        kinds = (pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], ["a_no", "chunk", "scores"])

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            held.append([np.asarray(batch.column(c)) for c in ("a", "b", "pos", "neg")])
            rows += batch.num_rows
            if rows >= BLOCK_PAIRS:
                yield block(*(np.concatenate(c) for c in zip(*held)))
                held, rows = [], 0
        if held:
            yield block(*(np.concatenate(c) for c in zip(*held)))

    return pairs.mapInArrow(run, "a_no int, chunk int, scores binary")


def _chunk_sums(packed: DataFrame) -> DataFrame:
    """A row per weight and chunk: merged scores, class counts and the pairs won inside; chunk -1 has the counts per threshold."""

    def run(table: pa.Table) -> pa.Table:
        k, chunk = table["a_no"][0].as_py(), table["chunk"][0].as_py()
        parts = table["scores"].to_pylist()
        scores, pos, neg, wins, tp, fp = b"", 0, 0, 0.0, [], []
        if chunk < 0:
            tp, fp = np.sum([np.frombuffer(x, "<i8") for x in parts], 0).reshape(2, -1).tolist()
        else:
            p, up, down = _merged(*(np.concatenate(c) for c in zip(*map(_unpack, parts))))
            pos, neg = int(up.sum()), int(down.sum())
            wins = float((down * (pos - np.cumsum(up) + up / 2.0)).sum())
            scores = _pack(p, up, down)
        row = {"a_no": k, "chunk": chunk, "pos": pos, "neg": neg, "wins": wins, "scores": scores, "tp": tp, "fp": fp}
        return pa.Table.from_pylist([row], schema=kinds)

    whole = pa.list_(pa.int64())
    kinds = pa.schema([
        ("a_no", pa.int32()), ("chunk", pa.int32()), ("pos", pa.int64()), ("neg", pa.int64()), ("wins", pa.float64()),
        ("scores", pa.binary()), ("tp", whole), ("fp", whole),
    ])
    schema = "a_no int, chunk int, pos long, neg long, wins double, scores binary, tp array<long>, fp array<long>"
    return packed.groupBy("a_no", "chunk").applyInArrow(run, schema)


def _precision_sums(batches):
    """Each chunk's part of the average precision, from the counts above it."""
    for batch in batches:
        above = zip(batch.column("pos_above").to_pylist(), batch.column("neg_above").to_pylist(), batch.column("scores").to_pylist())
        out = []
        for pos, neg, scores in above:
            _, up, down = _unpack(scores)
            tp = pos + np.cumsum(up[::-1])[::-1]
            flagged = tp + neg + np.cumsum(down[::-1])[::-1]
            out.append(float((up * tp / np.maximum(flagged, 1)).sum()))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("a_no", "pos", "neg", "pos_above", "wins")), pa.array(out, pa.float64())],
            ["a_no", "pos", "neg", "pos_above", "wins", "ap"],
        )


def grid_table(
    df: DataFrame, y: str, p1: str, p2: str, n_alpha: int = ALPHAS, thresholds: tuple[float, float, int] = THRESHOLDS
) -> DataFrame:
    """Every (weight, threshold) with AUROC, average precision and min(P, Se).

    Rows collapse to distinct score pairs first. A task blends, sorts and merges a block of pairs once per weight and
    hands on packed chunks of scores, so that no row is repeated per weight. The chunks of a weight are put together,
    their class counts are summed from the top, and each adds its part of the measures.
    """
    alphas, ts = linspace(0.0, 1.0, n_alpha), linspace(*thresholds)
    pairs = materialize(score_pairs(df, y, p1, p2))
    n = pairs.count()
    blocks = pairs.repartition(max(1, -(-n // BLOCK_PAIRS)))
    sums = materialize(_chunk_sums(packed_scores(blocks, alphas, _score_cuts(pairs, n, alphas), ts)))
    chunks = sums.where("chunk >= 0")
    # A row per chunk, without its scores.
    higher = Window.partitionBy("a_no").orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    above = {f"{c}_above": F.coalesce(F.sum(c).over(higher), F.lit(0)) for c in ("pos", "neg")}
    facts = chunks.select("a_no", "chunk", "pos", "neg").withColumns(above).drop("pos", "neg")
    parts = chunks.drop("tp", "fp").join(facts.hint("merge"), ["a_no", "chunk"]).mapInArrow(
        _precision_sums, "a_no int, pos long, neg long, pos_above long, wins double, ap double"
    )
    ranking = parts.groupBy("a_no").agg(
        F.sum(F.col("wins") + F.col("neg").cast("double") * F.col("pos_above")).alias("_wins"), F.sum("ap").alias("_ap"),
        F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"),
    ).select(
        "a_no", "_pos", F.try_divide("_wins", F.col("_pos").cast("double") * F.col("_neg")).alias("auroc"),
        F.try_divide("_ap", F.col("_pos").cast("double")).alias("auprc"),
    )
    # A row per weight and threshold.
    cells = sums.where("chunk < 0").select("a_no", F.posexplode(F.arrays_zip("tp", "fp")).alias("t_no", "_c"))
    table = cells.select("a_no", "t_no", "_c.tp", "_c.fp").join(ranking, "a_no").withColumn("fn", F.col("_pos") - F.col("tp"))
    value = lambda values, at: F.get(F.array(*[F.lit(v) for v in values]), F.col(at))
    table = with_rates(table, EPSILON).withColumns({"alpha": value(alphas, "a_no"), "t": value(ts, "t_no")})
    return table.select("a_no", "alpha", "t_no", "t", "auroc", "auprc", "min_ps")


def _close(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= F.lit(1e-8) + F.lit(1e-5) * F.abs(b)


def pick_best(table: DataFrame) -> DataFrame:
    """Best grid point by AUROC, then average precision, then min(P, Se).

    The points are compared in grid order, weight first: a point replaces the
    best so far when it is better, and a tie within the tolerance passes to the
    next measure. The grid size bounds the array that is folded.
    """
    point = F.struct(
        F.col("a_no").alias("a_no"), F.col("t_no").alias("t_no"), F.col("alpha").alias("alpha"), F.col("t").alias("t"),
        F.col("auroc").alias("auroc"), F.col("auprc").alias("auprc"), F.col("min_ps").alias("min_ps"),
    )
    start = F.struct(
        F.lit(-1).alias("a_no"), F.lit(-1).alias("t_no"), F.lit(None).cast("double").alias("alpha"),
        F.lit(None).cast("double").alias("t"), F.lit(-1.0).alias("auroc"), F.lit(-1.0).alias("auprc"),
        F.lit(-1.0).alias("min_ps"),
    )

    def keep(best: Column, new: Column) -> Column:
        same_roc = _close(new["auroc"], best["auroc"])
        same_prc = _close(new["auprc"], best["auprc"])
        better = (
            (new["auroc"] > best["auroc"])
            | (same_roc & (new["auprc"] > best["auprc"]))
            | (same_roc & same_prc & (new["min_ps"] > best["min_ps"]))
        )
        return F.when(better, new).otherwise(best)

    folded = table.agg(F.aggregate(F.sort_array(F.collect_list(point)), start, keep).alias("b"))
    return folded.select("b.alpha", "b.t", "b.auroc", "b.auprc", "b.min_ps")


def grid_search(
    df: DataFrame, y: str, p1: str, p2: str, n_alpha: int = ALPHAS, thresholds: tuple[float, float, int] = THRESHOLDS
) -> DataFrame:
    """One row: the chosen weight and threshold with their measures."""
    return pick_best(grid_table(df, y, p1, p2, n_alpha, thresholds))


def evaluate(df: DataFrame, y: str, p1: str, p2: str, alpha: Column | float, t: Column | float) -> DataFrame:
    """AUROC, average precision and min(P, Se) of the blend at a fixed weight and threshold."""
    blended = df.select(F.col(y).alias("y"), blend(F.col(p1), F.col(p2), alpha).alias("p"))
    ranking = ranking_from_counts(score_counts(blended, "y", "p"))
    at_t = confusion(blended, "y", "p", t, EPSILON).select(F.struct("min_ps").alias("c")).scalar()
    return ranking.withColumn("min_ps", at_t["min_ps"])
