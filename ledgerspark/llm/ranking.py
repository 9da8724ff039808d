"""Quality by Bradley-Terry pairwise ranking.

A document's strength is a weighted sum of features of its whole text; that a document is preferred to another has
the logistic probability of the difference of their strengths. The weights come from preference pairs (a document
with the higher label and one with the lower) by Newton's method on the logistic loss of feature differences. The
threshold is a quantile of the strengths of *all* documents: their histogram is counted on Spark, and of its quantile
levels the one that parts the labelled documents best is taken.

Features are counted in Arrow batches; strengths, quantiles and scores are column expressions. All labelled documents take
part: their pairs are joined on Spark, and only sums over blocks of them and the histograms come to the driver.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import combinations, islice
from math import log, log1p
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, fold, slices, table

#: Opponents that a document of the larger label meets. Documents in a block that a task sums up at once, and pairs that ask
#: for one copy of a document, about.
OPPONENTS, PART, ASKED = 4, 1 << 14, 4096
#: Different labels at most.
GRADES = 64
#: Weight of the ridge penalty, Newton steps, bins of the histogram of strengths, the seed.
RIDGE, STEPS, BINS, SEED = 1e-3, 30, 4096, 11
#: The marks of prose, and what ends a line or sentence.
MARKS, LINE = ".,;:?!'\"()-", re.compile(r"[\n.]\s*")
#: A document is good from this score on.
GOOD = 0.7


@cache
def classes() -> np.ndarray:
    """The class of every code point: 0 other letters, 1 capitals, 2 digits, 3 white space, 4 the marks of prose, 5 anything else."""
    out = np.full(sys.maxunicode + 1, 5, np.uint8)
    for i in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(i))
        out[i] = 1 if kind == "Lu" else 0 if kind[0] in "LM" else 2 if kind[0] == "N" else 3 if kind[0] == "Z" or 9 <= i <= 13 else 5
    out[[ord(c) for c in MARKS]] = 4
    return out


def features(text: str | None) -> list[float]:
    """The features of a whole text; null counts as empty. All are finite for every text."""
    t = text or ""
    held = np.zeros(6)
    for at in range(0, len(t), 1 << 20):
        held += np.bincount(classes()[np.frombuffer(t[at : at + (1 << 20)].encode("utf-32-le", "surrogatepass"), np.uint32)], minlength=6)
    words, lines = t.split(), [x for x in LINE.split(t) if x]
    n, kinds, again = len(words), len(set(words)), sum(map(eq, words, islice(words, 1, None)))
    share = lambda a, b: float(a / b) if b else 0.0
    odd = share(held[5], len(t))
    return [
        log1p(n), log1p(share(len(t), n)), share(held[0] + held[1], len(t)), share(held[1], held[0] + held[1]), share(held[2], len(t)), odd, log(odd + 0.01), share(held[4], n),
        share(kinds, n), log1p(kinds) - log1p(n), share(again, n), share(len(lines), n), share(len(set(lines)), len(lines)),
    ]


def pairs(labels: np.ndarray, opponents: int = OPPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(preferred, other) row numbers: every document meets ``opponents`` of each lower label, dealt in turn, so
    that those of the smaller side meet about equally many."""
    win, lose = [], []
    kinds = np.unique(labels)
    for a in range(len(kinds)):
        for b in range(a):
            high, low = np.flatnonzero(labels == kinds[a]), np.flatnonzero(labels == kinds[b])
            n = max(len(high), len(low)) * opponents
            win.append(high[np.arange(n) % len(high)])
            lose.append(low[(np.arange(n) + np.arange(n) // max(len(high), len(low))) % len(low)])
    return (np.concatenate(win), np.concatenate(lose)) if win else (np.empty(0, np.int64), np.empty(0, np.int64))


Sums = tuple[float, np.ndarray, np.ndarray]


def summed(d: np.ndarray, w: np.ndarray) -> Sums:
    """Loss, gradient and Hessian of the logistic loss at ``w``, summed over the differences ``d``."""
    loss, grad, hess = 0.0, np.zeros(len(w)), np.zeros((len(w), len(w)))
    for at in range(0, len(d), 1 << 16):
        e = d[at : at + (1 << 16)]
        z = e @ w
        p = 1 / (1 + np.exp(np.clip(z, -500, 500)))  # that the other one would win
        loss += float(np.logaddexp(0, -z).sum())
        grad -= e.T @ p
        hess += (e * (p * (1 - p))[:, None]).T @ e
    return loss, grad, hess


def newton(size: int, sums: Callable[[np.ndarray], Sums], n: int, ridge: float = RIDGE, steps: int = STEPS) -> np.ndarray:
    """The weights that minimise the mean of ``n`` losses, whose sums at any weights ``sums`` gives, plus the ridge penalty."""

    def at(w: np.ndarray) -> Sums:
        loss, grad, hess = sums(w)
        return loss / n + ridge / 2 * float(w @ w), grad / n + ridge * w, hess / n + ridge * np.eye(size)

    w = np.zeros(size)
    now = at(w)
    for _ in range(steps):
        step, share = np.linalg.solve(now[2], now[1]), 1.0
        then = at(w - step)
        while then[0] > now[0] and share > 1e-6:
            share /= 2
            then = at(w - share * step)
        if now[0] - then[0] < 1e-12:
            break
        w, now = w - share * step, then
    return w


def strengths(x: np.ndarray, win: np.ndarray, lose: np.ndarray, ridge: float = RIDGE, steps: int = STEPS) -> np.ndarray:
    """The weights that minimise the mean logistic loss of ``x[win] - x[lose]`` plus the ridge penalty."""
    return newton(x.shape[1], lambda w: summed(x[win] - x[lose], w), len(win), ridge, steps)


@dataclass
class Ranking:
    """Weights of the raw features, and the strength from which a document is good; no weights where nothing
    could be learnt."""

    weights: list[float]
    cut: float = 0.0
    level: float = 0.0

    def strength(self, f: Column) -> Column:
        """Of the array of features; the sum is in the features' order."""
        terms = [f[k] * F.lit(float(w)) for k, w in enumerate(self.weights)]
        return sum(terms[1:], terms[0]) if terms else F.lit(0.0)

    def score(self, f: Column) -> Column:
        """Between 0 and 1, ``GOOD`` at the cut; 0 where nothing was learnt."""
        if not self.weights:
            return F.lit(0.0)
        z = self.strength(f) - F.lit(self.cut) + F.lit(float(np.log(GOOD / (1 - GOOD))))
        return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))


def level(high: np.ndarray, low: np.ndarray, borders: np.ndarray) -> int:
    """Which of the ``borders`` between the bins parts good from other labelled documents (counts by bin) best: the largest sum of
    both sides' shares of right answers, each label counting alike; of equal ones the middle."""
    right = (1 - np.cumsum(high)[:-1] / high.sum()) + np.cumsum(low)[:-1] / low.sum()
    best = np.flatnonzero(right >= right.max() - 1e-12)
    return int(best[np.argmin(np.abs(borders[best] - (borders[best[0]] + borders[best[-1]]) / 2))])


def by_block(rows: DataFrame, keys: list[str], make: Callable[[np.ndarray], np.ndarray]) -> list[np.ndarray]:
    """``make`` of the matrix ``f`` of each block (rows of equal ``keys``, which lie together), in the order of the keys: an array a
    block of PART documents comes to the driver. Blocks do not hang on how the input lies, so that reruns agree to the last bit."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([float(v)]) for v in key] + [pa.array([make(np.concatenate(held)).tolist()], pa.list_(pa.float64()))], [*keys, "s"])

        for part in batches:
            if not part.num_rows:
                continue
            at = np.stack([part.column(k).to_numpy(zero_copy_only=False) for k in range(len(keys))], axis=1)
            x = part.column(len(keys)).flatten().to_numpy().reshape(len(at), -1)
            cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1), len(at)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if key is not None and tuple(at[lo]) != key:
                    yield out()
                    held = []
                key = tuple(at[lo])
                held.append(x[lo:hi])
        if key is not None:
            yield out()

    got = rows.select(*keys, "f").mapInArrow(apply, ", ".join(f"{k} double" for k in keys) + ", s array<double>").collect()
    return [np.array(r[-1]) for r in sorted(got, key=tuple)]


def ranked(rows: DataFrame, labels: DataFrame, work: Scratch, id_col: str, label_col: str) -> tuple[DataFrame, dict[float, int]]:
    """All documents that may be learnt from, as (``y``, ``part``, ``turn``, ``f``), and how many there are of each label.

    ``turn`` numbers the documents of a label from 0 in the order of a seeded hash of id and features; ``part`` is a range of
    the hash with about PART of them."""
    known = labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("double").alias("y")).where("i is not null and y is not null")
    known = known.groupBy("i").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z").select("i", "y")
    if known.select("y").distinct().limit(GRADES + 1).count() > GRADES:
        raise ValueError(f"more than {GRADES} different labels: bin them first")
    own = rows.where("open").select(F.col(id_col).alias("i"), "f")
    met = own.join(known.hint("merge"), "i").select("y", "f", F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "i", "f"), 1).alias("h"))
    met = work.save(met, "met")
    counts = {r["y"]: r["count"] for r in met.groupBy("y").count().collect()}  # a row a label
    if not counts:
        return met, counts
    parts = F.lit(1)
    for y, n in counts.items():
        parts = F.when(F.col("y") == y, -(-n // PART)).otherwise(parts)
    met = met.withColumn("part", F.shiftright(F.shiftright("h", 43) * parts.cast("long"), 20).cast("int"))
    base, spent = [], dict.fromkeys(counts, 0)
    for r in sorted(met.groupBy("y", "part").count().collect()):  # a row for PART documents
        base.append((r["y"], r["part"], spent[r["y"]]))
        spent[r["y"]] += r["count"]
    base = F.broadcast(met.sparkSession.createDataFrame(base, "y double, part int, base long"))
    turn = F.row_number().over(Window.partitionBy("y", "part").orderBy("h", "f")) - 1 + F.col("base")
    met = met.join(base, ["y", "part"]).select("y", "part", turn.alias("turn"), "f")
    return work.save(met.repartition("y", "part").sortWithinPartitions("y", "part", "turn"), "ranked"), counts


def differences(met: DataFrame, counts: dict[float, int], opponents: int = OPPONENTS) -> DataFrame:
    """(``pair``, ``part``, ``f``): the features of the preferred less those of the other document, for the pairs that ``pairs``
    deals to all documents of ``ranked``. The larger side asks for its opponents by their turns; a document of the smaller
    side that many ask for is joined as several copies."""
    meet = []
    for pair, (low, high) in enumerate(combinations(sorted(counts), 2)):
        big, small = (high, low) if counts[high] >= counts[low] else (low, high)
        m, n = counts[big], counts[small]
        meet.append((pair, big, small, m, n, 1.0 if big == high else -1.0, -(-m * opponents // (n * ASKED))))
    meet = F.broadcast(met.sparkSession.createDataFrame(meet, "pair int, big double, small double, m long, n long, sign double, copies long"))  # a row for two labels
    j, k, m = F.col("j"), F.col("turn"), F.col("m")
    wanted = F.when(F.col("sign") > 0, k + j * m + j).otherwise(j * m + F.pmod(k - j, m)) % F.col("n")
    ask = met.join(meet, F.col("y") == F.col("big")).withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(opponents - 1).cast("long"))))
    ask = ask.select("pair", (k / PART).cast("int").alias("part"), "turn", "j", "sign", "f", wanted.alias("other"), (k % F.col("copies")).alias("copy"))
    told = met.join(meet, F.col("y") == F.col("small")).select("pair", F.col("turn").alias("other"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"), F.col("f").alias("g"))
    both = ask.join(told.hint("merge"), ["pair", "other", "copy"])
    d = F.zip_with("f", "g", lambda a, b: a - b)
    both = both.select("pair", "part", "turn", "j", F.transform(d, lambda v: v * F.col("sign")).alias("f"))
    return both.repartition("pair", "part").sortWithinPartitions("pair", "part", "turn", "j").select("pair", "part", "f")


def moments(x: np.ndarray) -> np.ndarray:
    """Number, means and products of deviations of the rows."""
    mean = x.mean(axis=0)
    return np.concatenate(([len(x)], mean, ((x - mean).T @ (x - mean)).ravel()))


def merged(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Means and covariances of all rows from the ``moments`` of blocks."""
    size = int(np.sqrt(len(parts[0])))  # 1 + size + size * size
    n, mean, cross = 0.0, np.zeros(size), np.zeros((size, size))
    for p in parts:
        off = p[1 : size + 1] - mean
        cross += p[size + 1 :].reshape(size, size) + np.outer(off, off) * n * p[0] / (n + p[0])
        mean, n = mean + off * p[0] / (n + p[0]), n + p[0]
    return mean, cross / n


def fit(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Ranking:
    """Learn from ``rows`` (``id_col``, ``f``: features, ``open``: may its label be learnt), all documents.

    All labelled documents that may be learnt from meet in preference pairs; the weights come from the losses of all pairs, summed on
    Spark at each Newton step, the threshold from histograms of all rows and of all labelled ones. Ids that are null, labels that are
    null, and ids with two different labels are left out. With fewer than two labels nothing is learnt and every score is 0. Rows
    that repeat an id all count; other columns of ``labels`` are ignored, whatever their names.
    """
    work = Scratch(rows.sparkSession, "pairs")
    met, counts = ranked(rows, labels, work, id_col, label_col)
    if len(counts) < 2:
        work.drop("met", "ranked")
        return Ranking([])
    work.drop("met")
    mean, cov = merged(by_block(met, ["y", "part"], moments))
    spread = np.sqrt(np.diag(cov))
    spread[spread < 1e-12] = np.inf  # the same in all documents: no weight
    size = len(spread)
    d = work.save(differences(met, counts), "differences")

    def sums(w: np.ndarray) -> Sums:
        flat = lambda x: np.concatenate([np.ravel(v) for v in summed(x / spread, w)])
        total = np.sum(by_block(d, ["pair", "part"], flat), axis=0)
        return float(total[0]), total[1 : size + 1], total[size + 1 :].reshape(size, size)

    pairs_ = sum(max(counts[a], counts[b]) * OPPONENTS for a, b in combinations(counts, 2))
    weights = newton(size, sums, pairs_) / spread
    work.drop("differences")
    out = Ranking(weights.tolist())

    # The histograms of strengths: equal steps of their logistic transform around the labelled documents' mean.
    mid, wide = float(mean @ weights), max(1e-9, float(np.sqrt(max(0.0, weights @ cov @ weights))))
    squash = 1 / (1 + F.exp(-F.greatest(F.least((out.strength(F.col("f")) - mid) / wide, F.lit(30.0)), F.lit(-30.0))))
    bin_ = F.least(F.floor(squash * BINS), F.lit(BINS - 1)).cast("int").alias("bin")

    def counted(table: DataFrame) -> np.ndarray:
        held = np.zeros(BINS)
        for r in table.groupBy(bin_).count().collect():  # BINS rows
            held[r["bin"]] = r["count"]
        return held

    held, top = counted(rows), max(counts)
    at = np.arange(1, BINS) / BINS
    borders = mid + wide * np.log(at / (1 - at))
    best = level(counted(met.where(F.col("y") == top)), counted(met.where(F.col("y") != top)), borders)
    out.cut, out.level = float(borders[best]), float(np.cumsum(held)[best] / held.sum())
    work.drop("ranked")
    return out


def measured(docs: DataFrame, open_: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``open``, ``f``): what ``fit`` and ``score`` read. Other columns are ignored, whatever their names."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            f = pa.array([features(t) for t in part.column(2).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), f], ["id", "open", "f"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(open_, F.lit(True)).alias("open"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(apply, f"id {kind}, open boolean, f array<double>").withColumnRenamed("id", id_col)


def score(rows: DataFrame, model: Ranking, id_col: str = "doc_id") -> DataFrame:
    """(id, ``score``, ``predicted``) of every row of ``measured``, from the whole text alone. Null and empty texts
    are scored as texts without words; repeated rows get the same score each; an empty table gives no rows."""
    return rows.select(F.col(id_col), model.score(F.col("f")).alias("score")).withColumn("predicted", (F.col("score") >= GOOD).cast("int"))


def op11_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all ``documents``, learnt from the ``labels`` of three quarters; edge cases as in ``fit`` and
    ``score``."""
    docs, labels, work = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), Scratch(spark, "ranking")
    rows = work.save(measured(docs, fold(F.col("doc_id"), 4) != 2), "features")  # read thrice
    model = fit(rows, labels.where(F.coalesce(fold(F.col("doc_id"), 4) != 2, F.lit(False))))
    out = score(rows.select("doc_id", "f"), model)
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")
