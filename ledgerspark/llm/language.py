"""Language identification by prediction by partial matching (PPM, method C, with exclusion).

For every language a variable-order tree of byte contexts (up to ``ORDER`` bytes) holds the counts of the byte
that follows. A byte never seen in a context escapes to the next shorter one: with n different bytes seen t
times in all, the escape has probability n / (t + n), and the shorter context's distribution is restricted to
the bytes not yet excluded; below the empty context all 256 bytes are alike. A context never seen escapes at no
cost. The statistics are frozen after training, so what a byte costs hangs on the ``ORDER`` bytes before it only:
the costs of all byte runs seen in training, and of the escapes, are worked out once, and a text's exact code length
under each language is a sum of look-ups in the trees.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, fold, slices, table, utf8

#: Longest context in bytes.
ORDER = 3
#: Bounds of the training sample: documents a language, bytes of all their texts. Languages in one set of trees.
SAMPLE, SAMPLE_BYTES, TOGETHER = 400, 8 << 20, 16
#: A text is of no known language if it costs more than this times the dearest quarter of its language's training
#: texts a byte, and ``SLACK`` bits for its beginning.
DEAR, SLACK = 4.0, 96
SEED = 5
#: The start of a text in the runs of symbols, and their base.
START, BASE = 256, 257


def grams(data: bytes) -> np.ndarray:
    """The runs of ORDER + 1 symbols that end at each byte, as numbers to base ``BASE``."""
    s = np.concatenate((np.full(ORDER, START, np.int64), np.frombuffer(data, np.uint8).astype(np.int64)))
    out = s[: len(data)]
    for j in range(1, ORDER + 1):
        out = out * BASE + s[j : j + len(data)]
    return out


@dataclass
class Step:
    """From a run of symbols (by number) and one more symbol to the number of the longer run: a bit a symbol, and
    the number of the first run of each 64."""

    bits: np.ndarray
    start: np.ndarray

    @classmethod
    def build(cls, before: np.ndarray, symbols: np.ndarray, runs: int, size: int) -> Step:
        """Of runs in order: the number of each one's prefix, and its last symbol."""
        words = (size + 63) // 64
        bits = np.zeros((runs, words), np.uint64)
        np.bitwise_or.at(bits, (before, symbols >> 6), np.uint64(1) << (symbols & 63).astype(np.uint64))
        count = np.bitwise_count(bits).astype(np.int64).ravel()
        return cls(bits.ravel(), (np.cumsum(count) - count).astype(np.int32))

    def next(self, runs: np.ndarray, word: np.ndarray, bit: np.ndarray, words: int) -> np.ndarray:
        """Numbers of the longer runs, -1 where either is unknown."""
        at = np.maximum(runs, 0)
        at = at * words + word if words > 1 else at
        mask = self.bits[at]
        out = self.start[at] + np.bitwise_count(mask & (bit - np.uint64(1)))
        out[(runs < 0) | ((mask & bit) == 0)] = -1
        return out


@dataclass
class Trees:
    """The context trees of some languages. ``to``: byte -> symbol, 0 for bytes never seen. ``cost[k]``: what the
    last symbol of each run of k + 1 symbols costs; ``escape[k]``: what leaving each run of k + 1 symbols as a
    context costs; a column a language, in bits."""

    to: np.ndarray
    steps: list[Step]
    cost: list[np.ndarray]
    escape: list[np.ndarray]

    @classmethod
    def build(cls, runs: np.ndarray, language: np.ndarray, counts: np.ndarray, n: int) -> Trees:
        """From the (ORDER + 1)-runs seen, each with the number of its language and its count there."""
        parts = [runs // BASE ** (ORDER - j) % BASE for j in range(ORDER + 1)]
        seen = np.unique(np.concatenate(parts)) if len(runs) else np.empty(0, np.int64)
        seen = seen[seen != START]
        to = np.zeros(BASE, np.int64)
        to[seen], to[START] = np.arange(1, len(seen) + 1), len(seen) + 1
        a = len(seen) + 2
        full = to[parts[0]] if len(runs) else np.empty(0, np.int64)
        for part in parts[1:]:
            full = full * a + to[part]
        levels = [np.unique(full)]  # runs of ORDER + 1 symbols, then shorter ones: beginnings and ends of the longer
        for k in range(ORDER - 1, 0, -1):
            levels.insert(0, np.unique(np.concatenate((levels[0] // a, levels[0] % a ** (k + 1)))))
        levels.insert(0, np.arange(a, dtype=np.int64))

        own = np.zeros((a, n))
        np.add.at(own, (full % a, language), counts)
        t, d = own.sum(axis=0), (own > 0).sum(axis=0)
        rest = np.where(d < 256, d / np.maximum(t + d, 1) / np.maximum(256 - d, 1), 0)
        p = np.where(own > 0, own / np.maximum(t + np.where(d < 256, d, 0), 1), np.where(t > 0, np.maximum(rest, 2.0**-60), 1 / 256))
        cost, escape, steps = [-np.log2(p)], [], []
        for k in range(1, ORDER + 1):
            longer, shorter = levels[k], levels[k - 1]
            before, symbol, tail = np.searchsorted(shorter, longer // a), longer % a, np.searchsorted(shorter, longer % a**k)
            own = np.zeros((len(longer), n))
            np.add.at(own, (np.searchsorted(longer, full % a ** (k + 1)), language), counts)
            t, d, used = (np.zeros((len(shorter), n)) for _ in range(3))
            np.add.at(t, before, own)
            np.add.at(d, before, own > 0)
            np.add.at(used, before, np.where(own > 0, 2.0 ** -cost[-1][tail], 0.0))
            left = 1 - used
            whole = left < 1e-9  # no other byte can follow, so nothing is put aside for it
            leave = np.where(t > 0, np.where(whole, 2.0**-60, d / np.maximum(t + d, 1) / np.where(whole, 1, left)), 1.0)
            escape.append(-np.log2(leave))
            p = own / np.maximum(t + np.where(whole, 0, d), 1)[before]
            cost.append(np.where(own > 0, -np.log2(np.where(own > 0, p, 1)), escape[-1][before] + cost[-1][tail]))
            steps.append(Step.build(before, symbol, len(shorter), a))
        return cls(to.astype(np.int32), steps, [c.astype(np.float32) for c in cost], [e.astype(np.float32) for e in escape])

    def bits(self, data: bytes, first: int) -> np.ndarray:
        """Cost of ``data[first:]`` under each language, with what stands before it as context; where nothing
        stands before it, the text begins there."""
        s = self.to[np.frombuffer(data, np.uint8)]
        if first == 0:
            s, first = np.concatenate((np.full(ORDER, self.to[START], np.int32), s)), ORDER
        words = (int(self.to[START]) + 64) // 64
        word, bit = s >> 6, np.uint64(1) << (s & 63).astype(np.uint64)
        runs, out, live = [s], np.zeros(self.cost[0].shape[1]), np.arange(first, len(s))
        for step in self.steps:  # runs[k][i]: the run of k + 1 symbols that ends at i
            longer = np.empty(len(s), np.int32)
            longer[0], longer[1:] = -1, step.next(runs[-1][:-1], word[1:], bit[1:], words)
            runs.append(longer)
        for k in range(ORDER, 0, -1):
            here = runs[k][live]
            met = here >= 0
            out += self.cost[k].take(here[met], axis=0).sum(axis=0, dtype=np.float64)
            live = live[~met]
            context = runs[k - 1][live - 1]
            out += self.escape[k - 1][context[context >= 0]].sum(axis=0, dtype=np.float64)
        return out + self.cost[0][s[live]].sum(axis=0, dtype=np.float64)


@dataclass
class Model:
    """Languages in order, the trees of each ``TOGETHER`` of them, and the bits a byte above which a text is of no
    known language."""

    languages: list[str]
    trees: list[Trees]
    limits: np.ndarray

    def lengths(self, texts: list[bytes], chunk: int = 1 << 15) -> np.ndarray:
        """Code lengths in bits, a row for each text and a column for each language."""
        out = np.zeros((len(texts), len(self.languages)))
        for i, t in enumerate(texts):
            for at in range(0, len(t), chunk):
                lo = max(0, at - ORDER)
                out[i] += np.concatenate([g.bits(t[lo : at + chunk], at - lo) for g in self.trees])
        return out

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Best language (index) and its share of the posterior under equal priors."""
        bits = self.lengths(texts)
        best = bits.argmin(axis=1)
        share = np.exp2(np.clip(bits.min(axis=1, keepdims=True) - bits, -1000, 0))
        return best, 1 / share.sum(axis=1)

    def known(self, texts: list[bytes]) -> np.ndarray:
        """Whether the language of least code length is one in which a text of this length may cost so much."""
        bits, size = self.lengths(texts), np.array([len(t) for t in texts])
        best = bits.argmin(axis=1)
        return bits.min(axis=1) <= self.limits[best] * size + SLACK


def build(languages: list[str], names: np.ndarray, runs: np.ndarray, counts: np.ndarray) -> Model:
    """The model from (language, run of ORDER + 1 symbols, count) rows."""
    number = np.searchsorted(np.array(languages, object), names) if len(names) else np.empty(0, np.int64)
    trees = []
    for lo in range(0, len(languages), TOGETHER):
        n = min(TOGETHER, len(languages) - lo)
        own = (number >= lo) & (number < lo + n)
        trees.append(Trees.build(runs[own], number[own] - lo, counts[own].astype(np.float64), n))
    return Model(languages, trees, np.full(len(languages), np.inf))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Learn from at most ``sample`` documents of each language (the lowest seeded hashes), whole texts.

    ``docs`` holds only rows that may be learnt from. Rows without language, text or letters are left out.
    Every language is learnt, with an equal share of ``sample_bytes``: documents are taken until it is spent, the last
    of them whole, however long. Repeated rows count once. Other columns are ignored, whatever their names.
    The driver holds one row a language and the runs of the sample.
    """
    spark, work = docs.sparkSession, Scratch(docs.sparkSession, "language")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("h", F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "id", "text"), 1))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    names = sorted(counts)
    if not names:
        return Model([], [], np.empty(0))
    # About as many as wanted pass the bound on the hash, so the sort that cuts them off is a small one.
    low = [(n, min((1 << 63) - 1, int(1.5 * sample / c * (1 << 63)) + (1 << 56))) for n, c in counts.items()]
    low = F.broadcast(spark.createDataFrame(low, "lang string, most long"))  # a row a language
    light = rows.select("lang", "h", F.octet_length("text").cast("long").alias("n")).join(low, "lang").where("h <= most")
    turn = Window.partitionBy("lang").orderBy("h")
    first = light.groupBy("lang", "h").agg(F.max("n").alias("n")).withColumns({"k": F.row_number().over(turn), "spent": F.sum("n").over(turn) - F.col("n")})
    first = work.save(first.where((F.col("k") <= sample) & (F.col("spent") < max(1, sample_bytes // len(names)))).select("lang", "h"), "picked")
    texts = rows.join(F.broadcast(first), ["lang", "h"], "left_semi").dropDuplicates(["lang", "h"]).select("lang", "text")  # at most ``sample`` a language
    texts = work.save(texts, "texts")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            for lang, t in zip(part.column(0).to_pylist(), utf8(part.column(1).to_pylist()), strict=True):
                for at in range(0, len(t), 1 << 20):
                    lo = max(0, at - ORDER)
                    keys, c = np.unique(grams(t[lo : at + (1 << 20)])[at - lo :], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(c)], ["lang", "g", "c"])

    met = texts.mapInArrow(count, "lang string, g long, c long").groupBy("lang", "g").agg(F.sum("c").alias("c")).toArrow()
    model = build(names, met.column("lang").to_numpy(), met.column("g").to_numpy(), met.column("c").to_numpy())
    shared = spark.sparkContext.broadcast(model)  # bounded by the sample

    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            data = utf8(part.column(1).to_pylist())
            own = [shared.value.languages.index(x) for x in part.column(0).to_pylist()]
            bits = shared.value.lengths(data)[np.arange(len(data)), own] / [max(1, len(t)) for t in data]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(bits, pa.float64())], ["lang", "bits"])

    dear = texts.mapInArrow(costs, "lang string, bits double").groupBy("lang").agg(F.percentile("bits", F.lit(0.75)).alias("q")).collect()
    work.drop("picked", "texts")
    limits = {r["lang"]: r["q"] * DEAR for r in dear}
    model.limits = np.array([limits[n] for n in names])
    return model


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` -> (id, ``lang_pred``, ``score``); ``und`` with score 0 for null texts, texts without a letter,
    and where nothing was learnt. Other texts get the language of least code length over the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for part in slices(batches):
            names, scores = [], []
            letter = pc.fill_null(pc.match_substring_regex(part.column(1), r"\p{L}"), False).to_pylist()
            if m.languages:
                best, share = m.predict(utf8(part.column(1).to_pylist()))
                for ok, b, p in zip(letter, best.tolist(), share.tolist(), strict=True):
                    names.append(m.languages[b] if ok else "und")
                    scores.append(min(1.0, p) if ok else 0.0)
            else:
                names, scores = ["und"] * part.num_rows, [0.0] * part.num_rows
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(apply, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def keep_known(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text is in one of the languages learnt: it has a letter
    and costs no more bits a byte than texts of its language do (``DEAR``). Where nothing could be learnt every text
    with a letter is kept. Null and empty texts go; rows that repeat stay or go together."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for part in slices(batches):
            part = part.filter(pc.fill_null(pc.match_substring_regex(part.column(at), r"\p{L}"), False))
            if m.languages and part.num_rows:
                part = part.filter(pa.array(m.known(utf8(part.column(at).to_pylist()))))
            yield part

    return docs.mapInArrow(apply, docs.schema)


def op5_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all ``documents``, learnt from three quarters of them; edge cases as in ``fit`` and
    ``predict``."""
    docs = table(spark, sf_dir, "documents")
    held = fold(F.col("doc_id"), 4) == 2
    model = fit(docs.where(~held))
    out = predict(docs, model)
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
