"""Operator 3: quality rules and robust multivariate outliers.

Each text gives a vector of five transformed statistics. For each language and source, a minimum-covariance-determinant
estimate (the mean and covariance of the h rows whose covariance has the least determinant) says how clean texts of that
group look; a text whose squared Mahalanobis distance from it is above a cut-off is rejected.

Every group has its own estimate, whatever its size, and so have each language and all texts. An estimate of n rows is
mixed with that of the level above, with the weights n / (n + k) and k / (n + k): a source's with its language's, a
language's with that of all, and the latter with a wide one that is given. ``own_weight`` says how much is the source's own.

The vectors are small integers (steps of a sixteenth of a floor for each statistic), so all sums are exact and reruns
agree. Equal vectors are counted, so copies are one row. A C-step takes exactly the h rows that are closest: they are
counted and summed by group and by bin of their distance, the bins closest in are taken whole, and of the bin in which h
falls the rows are ranked, the last vector with a part of its copies. The starts take two steps each; the best goes on
until its determinant stops falling. No task or driver holds a group: a group has some ten thousand bins at most, and one
of them is ranked. The floors are added to the covariances as a ridge, as most texts have no symbol or repeated line.

Nulls, ties, empty input: a null text has no words; a text without words fails the base rule; a null language or source
is a value of its own; repeated rows count each; a text of any length is one row; an empty table gives an empty result.
Input columns named like an output column are replaced; other names can't clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop, gathered, keep, small_batches, table

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: The smallest standard deviation that counts for each statistic: log words, log word length, symbols and repeated
#: lines and repeated words as shares.
FLOORS = (0.25, 0.05, 0.01, 0.10, 0.08)
STEPS = 16
P = len(FLOORS)


def text_statistics(text: str) -> tuple[int, int, int, int, int, int]:
    """BASE and the number of lines that hold a word."""
    words = text.encode().split()
    chars = len(text) - sum(map(text.count, SPACE))
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    repeated = 0
    if len(words) > 3:
        known: dict[bytes, int] = {}
        ids = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
        pairs = ids[:-1] * len(known) + ids[1:]
        if len(known) > 2_000_000:  # three factors would not fit 64 bits
            pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        triples = pairs[:-1] * len(known) + ids[2:]
        order = np.argsort(triples, kind="stable")
        same = triples[order][1:] == triples[order][:-1]
        twice = np.zeros(len(triples) + 2, dtype=bool)
        at = np.concatenate([order[1:][same], order[:-1][same]])
        for shift in range(3):
            twice[at + shift] = True
        repeated = int(twice.sum())
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated, len(lines)


NAMES = (*BASE, "_q_lines")
OUTPUT = (*BASE, "base_failed", "distance", "own_weight", "kept")


def measured(docs: DataFrame, carried: list[str]) -> DataFrame:
    """BASE, base_failed and the internal columns of docs; the carried columns as one, `_q_row`."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("struct<" + ", ".join(f"{n}: bigint" for n in NAMES) + ">")
    def statistics(texts: pa.Array) -> pa.Array:
        found = np.array([text_statistics(t or "") for t in texts.to_pylist()], dtype=np.int64).reshape(len(texts), len(NAMES))
        return pa.StructArray.from_arrays([pa.array(found[:, i]) for i in range(len(NAMES))], names=list(NAMES))

    named = [F.when(F.col(c).isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col(c).cast("string"))).alias(f"_q_{c}") for c in ("lang", "source")]
    rows = docs.select(F.struct(*carried, F.lit(0).alias("_q")).alias("_q_row"), *named, statistics("text").alias("_q_s")).select("_q_row", "_q_lang", "_q_source", "_q_s.*")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def vector() -> list[Column]:
    """The transformed statistics in whole steps."""
    n = F.greatest("n_words", F.lit(1)).cast("double")
    values = (
        F.log(n),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        F.col("n_symbols") / F.greatest("word_chars", F.lit(1)),
        F.col("n_dup_lines") / F.greatest("_q_lines", F.lit(1)),
        F.col("n_repeat_words") / n,
    )
    return [F.round(v / f * STEPS).cast("long").alias(f"_q_y{i}") for i, (v, f) in enumerate(zip(values, FLOORS, strict=True))]


def _gamma_share(a: float, x: float) -> float:
    """The regularised lower incomplete gamma function, by its series."""
    term = total = 1 / a
    k = a
    while term > total * 1e-14:
        k += 1
        term *= x / k
        total += term
    return total * math.exp(a * math.log(x) - x - math.lgamma(a))


def chi2_quantile(share: float, p: int) -> float:
    low, high = 1e-9, 400.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if _gamma_share(p / 2, mid / 2) < share else (low, mid)
    return (low + high) / 2


def consistency(share: float, p: int) -> float:
    """Scales the covariance of the closest share of normal rows up to that of all."""
    return share / _gamma_share(p / 2 + 1, chi2_quantile(share, p) / 2)


PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
SUM_NAMES = ["n", *[f"s{i}" for i in range(P)], *[f"c{i}{j}" for i, j in PAIRS]]


Y = [f"_q_y{i}" for i in range(P)]


def sums(weight: Column) -> list[Column]:
    """Count, sums and sums of products: exact, and enough for means and covariances."""
    return [
        F.sum(weight).alias("n"),
        *[F.sum(weight * F.col(Y[i])).alias(f"s{i}") for i in range(P)],
        *[F.sum(weight * F.col(Y[i]) * F.col(Y[j])).alias(f"c{i}{j}") for i, j in PAIRS],
    ]


ESTIMATE = "_q_group string, _q_start int, _q_mean array<double>, _q_inverse array<double>, det double"


def _estimates(summed: DataFrame, factor: float) -> DataFrame:
    """(group, start, mean, inverse covariance, log determinant) of each row of sums()."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.to_dict("records"):
                n = float(r["n"])
                mean = np.array([r[f"s{i}"] / n for i in range(P)])
                cov = np.empty((P, P))
                for i, j in PAIRS:
                    cov[i, j] = cov[j, i] = r[f"c{i}{j}"] / n - mean[i] * mean[j]
                cov = cov * factor + np.eye(P) * STEPS**2
                rows.append((r["_q_group"], r["_q_start"], mean.tolist(), np.linalg.inv(cov).ravel().tolist(), float(np.linalg.slogdet(cov)[1])))
            yield pd.DataFrame(rows, columns=["_q_group", "_q_start", "_q_mean", "_q_inverse", "det"])

    return summed.mapInPandas(run, ESTIMATE)


def distance() -> Column:
    total = F.lit(0.0)
    for i in range(P):
        for j in range(i, P):
            term = F.col("_q_inverse")[i * P + j] * (F.col(Y[i]) - F.col("_q_mean")[i]) * (F.col(Y[j]) - F.col("_q_mean")[j])
            total = total + (term if i == j else 2 * term)
    return total


ALL = "all"


def level(name: str, *columns: str) -> Column:
    return F.concat_ws("\x1f", F.lit(name), *columns)


#: Bins to a doubling of 1 + distance.
BINS = 1024
#: Seeded quarters of the vectors that are starts besides the quartiles and all rows.
SEEDS = (1, 2)
STARTS = 2 + len(SEEDS)
#: Estimates of a task, where they are few.
ESTIMATES = 8


def _starts(rows: DataFrame) -> DataFrame:
    """Estimates to begin with: medians and quartiles of each statistic (exact, from counts of each whole value), all rows,
    and seeded quarters of the vectors."""
    values = rows.select("_q_group", "_q_n", F.posexplode(F.array(*Y)).alias("dim", "value"))
    counts = values.groupBy("_q_group", "dim", "value").agg(F.sum("_q_n").alias("n"))
    per = Window.partitionBy("_q_group", "dim")
    counts = counts.withColumn("_upto", F.sum("n").over(per.orderBy("value"))).withColumn("_all", F.sum("n").over(per))
    marks = counts.groupBy("_q_group", "dim").agg(*[F.min(F.when(F.col("_upto") >= q * F.col("_all"), F.col("value"))).alias(n) for n, q in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75))])
    listed = F.array_sort(F.collect_list(F.struct("dim", "q1", "q2", "q3")))
    quartiles = marks.groupBy("_q_group").agg(listed.alias("q")).select(
        "_q_group",
        F.lit(0).alias("_q_start"),
        F.transform("q", lambda x: x["q2"].cast("double")).alias("_q_mean"),
        F.flatten(F.transform("q", lambda x: F.transform(F.sequence(F.lit(0), F.lit(P - 1)), lambda k: F.when(k == x["dim"], 1 / (F.pow((x["q3"] - x["q1"]) / 1.349, 2) + STEPS**2)).otherwise(0.0)))).alias("_q_inverse"),
        F.lit(0.0).alias("det"),
    )
    tags = F.array(F.lit(1), *[F.when(F.pmod(F.xxhash64(*Y, F.lit(x)), F.lit(4)) == 0, F.lit(1 + x)) for x in SEEDS])
    tagged = rows.withColumn("_q_start", F.explode(F.array_compact(tags)))
    return quartiles.unionByName(_estimates(tagged.groupBy("_q_group", "_q_start").agg(*sums(F.col("_q_n"))), 1.0))


def _step(rows: DataFrame, now: DataFrame, share: float) -> DataFrame:
    """The estimates of the h rows closest to each estimate of now, h being ``share`` of the group's rows, rounded up."""
    far = rows.join(now.drop("det"), "_q_group").withColumn("_d", distance()).withColumn("_bin", F.floor(BINS * F.log2(1 + F.col("_d"))))
    bins = far.groupBy("_q_group", "_q_start", "_bin").agg(*sums(F.col("_q_n")))
    per = Window.partitionBy("_q_group", "_q_start")
    before = F.coalesce(F.sum("n").over(per.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bins = bins.withColumn("_before", before).withColumn("_h", F.ceil(share * F.sum("n").over(per)))
    left = F.col("_h") - F.col("_before")
    inner = bins.where(F.col("n") <= left).select("_q_group", "_q_start", *SUM_NAMES)
    edge = bins.where((left > 0) & (F.col("n") > left)).select("_q_group", "_q_start", "_bin", left.alias("_left"))
    ranked = far.join(edge, ["_q_group", "_q_start", "_bin"])
    upto = F.coalesce(F.sum("_q_n").over(per.orderBy("_d", *Y).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = ranked.withColumn("_w", F.least(F.col("_q_n"), F.col("_left") - upto)).where("_w > 0")
    both = inner.unionByName(part.groupBy("_q_group", "_q_start").agg(*sums(F.col("_w"))))
    return _estimates(both.groupBy("_q_group", "_q_start").agg(*[F.sum(c).alias(c) for c in SUM_NAMES]), consistency(share, P))


def vectors_of(stats: DataFrame) -> DataFrame:
    """(_q_group, vector, _q_n) of the rows of measured() that have a word: the distinct vectors, and how often they are, of
    each language and source, of each language, and of all. Rows are counted before they are told to the upper levels."""
    rows = stats.where("n_words > 0").select("_q_lang", "_q_source", *vector()).groupBy("_q_lang", "_q_source", *Y).agg(F.count(F.lit(1)).alias("_q_n"))
    groups = F.array(F.lit(ALL), level("lang", "_q_lang"), level("source", "_q_lang", "_q_source"))
    return rows.select(F.explode(groups).alias("_q_group"), *Y, "_q_n").groupBy("_q_group", *Y).agg(F.sum("_q_n").alias("_q_n"))


def least_determinant(rows: DataFrame, share: float = 0.75) -> DataFrame:
    """The minimum-covariance-determinant estimate of each group of vectors_of(). A step never raises a determinant, so the
    steps end. The table is kept."""
    groups = rows.select("_q_group").distinct().count()
    now = keep(gathered(_starts(rows), groups * STARTS, ESTIMATES), "quality-start")
    for _ in range(2):
        after = keep(gathered(_step(rows, now, share), groups * STARTS, ESTIMATES), "quality-step")
        drop(now)
        now = after
    best = now.groupBy("_q_group").agg(F.min_by(F.struct("_q_start", "_q_mean", "_q_inverse", "det"), F.struct("det", "_q_start")).alias("b"))
    now = keep(gathered(best.select("_q_group", "b.*"), groups, ESTIMATES), "quality-step")
    while True:
        after = keep(gathered(_step(rows, now, share), groups, ESTIMATES), "quality-step")
        fell = after.alias("x").join(now.alias("y"), "_q_group").where("x.det < y.det - 1e-9").limit(1).count()
        drop(now)
        now = after
        if not fell:
            return now


#: Rows at which an estimate weighs as much as the one above it.
FEW = 100
#: The standard deviations, in floors, of the estimate above that of all texts.
WIDE = 10.0
LEVELS = "_q_lang string, _q_source string, _q_mean array<double>, _q_inverse array<double>, own_weight double"


def mixed(n: float, mean: np.ndarray, cov: np.ndarray, above: tuple[np.ndarray, np.ndarray], few: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of a mixture of an estimate of n rows and the one above, their distance included."""
    w = n / (n + few)
    apart = mean - above[0]
    return w * mean + (1 - w) * above[0], w * cov + (1 - w) * above[1] + w * (1 - w) * np.outer(apart, apart)


def fit(stats: DataFrame, share: float = 0.75, few: float = FEW) -> DataFrame:
    """(_q_lang, _q_source, _q_mean, _q_inverse, own_weight) from all rows of measured() that have a word. The table, a row
    for each language and source, is kept."""
    rows = keep(vectors_of(stats), "quality-vectors")
    best = least_determinant(rows, share)
    # once more, from the rows that the estimate finds normal
    near = rows.join(best, "_q_group").where(distance() <= chi2_quantile(0.975, P))
    final = keep(_estimates(near.groupBy("_q_group", "_q_start").agg(*sums(F.col("_q_n"))), consistency(0.975, P)), "quality-final")
    sizes = rows.groupBy("_q_group").agg(F.sum("_q_n").alias("n"))
    levels = keep(final.join(sizes, "_q_group").select("_q_group", F.struct("n", "_q_mean", "_q_inverse").alias("e")), "quality-levels")
    named = stats.where("n_words > 0").select("_q_lang", "_q_source").distinct()
    for name, key in (("all", F.lit(ALL)), ("lang", level("lang", "_q_lang")), ("source", level("source", "_q_lang", "_q_source"))):
        named = named.withColumn("_key", key).join(levels.select(F.col("_q_group").alias("_key"), F.col("e").alias(name)), "_key").drop("_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                now = np.array(r["all"]["_q_mean"]), np.eye(P) * (STEPS * WIDE) ** 2
                for name in ("all", "lang", "source"):
                    e = r[name]
                    now = mixed(e["n"], np.array(e["_q_mean"]), np.linalg.inv(np.array(e["_q_inverse"]).reshape(P, P)), now, few)
                out.append({"_q_lang": r["_q_lang"], "_q_source": r["_q_source"], "_q_mean": now[0].tolist(), "_q_inverse": np.linalg.inv(now[1]).ravel().tolist(), "own_weight": r["source"]["n"] / (r["source"]["n"] + few)})
            numbers = pa.list_(pa.float64())
            yield pa.RecordBatch.from_pylist(out, pa.schema([("_q_lang", pa.string()), ("_q_source", pa.string()), ("_q_mean", numbers), ("_q_inverse", numbers), ("own_weight", pa.float64())]))

    out = keep(named.mapInArrow(run, LEVELS), "quality-estimates")
    drop(best, rows, final, levels)
    return out


def judged(stats: DataFrame, estimates: DataFrame, cutoff: float) -> DataFrame:
    """The carried columns and OUTPUT. A text whose group has no estimate has no words, so it failed."""
    rows = stats.join(estimates, ["_q_lang", "_q_source"], "left")
    rows = rows.withColumns(dict(zip(Y, vector(), strict=True))).withColumn("distance", distance())
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    names = [f.name for f in stats.schema["_q_row"].dataType if f.name != "_q"]
    return rows.withColumn("kept", kept).select(*[F.col("_q_row")[n].alias(n) for n in names], *OUTPUT)


#: The share of normal texts of a clean group that the cut-off would still keep.
NORMAL_SHARE = 1 - 1e-7


def quality(docs: DataFrame, few: float = FEW, normal_share: float = NORMAL_SHARE) -> DataFrame:
    """docs (doc_id, text, lang, source and any more) with OUTPUT."""
    light = keep(measured(docs, []), "quality-statistics")
    estimates = fit(light, few=few)
    drop(light)
    return judged(measured(docs, [c for c in docs.columns if c not in OUTPUT]), estimates, chi2_quantile(normal_share, P))


def quality_report(docs: DataFrame, few: float = FEW, normal_share: float = NORMAL_SHARE) -> DataFrame:
    """doc_id, lang, source and OUTPUT, without the text: the statistics are computed once."""
    light = keep(measured(docs, ["doc_id", "lang", "source"]), "quality-statistics")
    return judged(light, fit(light, few=few), chi2_quantile(normal_share, P))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_report(table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))
    return rows.select("doc_id", *OUTPUT)
