"""Benchmark decontamination by pigeonhole edit matching.

An item of n characters has an error budget of k = floor(rate * n) edits and is split into k + 1 pieces, so a
passage within the budget holds at least one piece unchanged. One Aho-Corasick pass over a document finds all
piece hits. The pieces are also taken in groups: a passage within the budget has a group of s pieces with at
most s - 1 edits, so a hit is first verified on its group, then on the whole item, both with Myers'
bit-parallel distance around the place the hit implies. No passage within the budget is missed.

Items shorter than ``LEAST`` characters get no error budget: they are found where they stand unchanged between word
borders, by the same pass. A benchmark of more than ``BLOCK_CHARS`` characters is dealt into blocks, and the documents
are read once: every piece of documents meets all blocks, each of which is built into a matcher in turn and kept while
the memory for matchers allows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, slices, table

#: Edits a character of an item; items with fewer characters than the second have no budget.
RATE, LEAST = 0.08, 32
#: Characters of benchmark text in one matcher; bytes of text that a task holds while it goes through several.
BLOCK_CHARS, HELD = 4 << 20, 32 << 20
GROUPS = 4
#: Characters of benchmark text that the driver and a task hold at once; a larger benchmark goes portion by portion.
PORTION = 128 << 20


def normal(text: str | None) -> str:
    """Lower case, runs of white space as one space."""
    return " ".join((text or "").lower().split())


class Pattern:
    """A pattern's bit masks for Myers' algorithm."""

    def __init__(self, text: str) -> None:
        self.n = len(text)
        self.masks: dict[str, int] = {}
        for i, c in enumerate(text):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def best(self, text: str, anchored: bool = False) -> tuple[int, int]:
        """(distance, end) of the substring of ``text`` (a prefix, if anchored) nearest to the pattern."""
        full, high = (1 << self.n) - 1, 1 << (self.n - 1)
        pv, mv, score, get = full, 0, self.n, self.masks.get
        best, end, first = score, 0, int(anchored)
        for at, c in enumerate(text, 1):
            eq = get(c, 0)
            xv = eq | mv
            xh = ((eq & pv) + pv ^ pv) | eq
            ph = (mv | ~(xh | pv)) & full
            mh = pv & xh
            if ph & high:
                score += 1
            elif mh & high:
                score -= 1
            ph = ph << 1 | first
            pv = (mh << 1 | ~(xv | ph)) & full
            mv = ph & xv & full
            if score < best:
                best, end = score, at
        return best, end


class Matcher:
    """Finds all items of a bounded list in a text."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE, least: int = LEAST) -> None:
        self.items, pieces = [], {}
        for item, raw in items:
            text = normal(raw)
            if not text:
                continue
            n, k = len(text), int(rate * len(text)) if len(text) >= least else 0
            cut = [n * j // (k + 1) for j in range(k + 2)]
            groups = min(GROUPS, k + 1)
            edge = [(k + 1) * g // groups for g in range(groups + 1)]
            spans = [(cut[a], cut[b], b - a - 1, Pattern(text[cut[a] : cut[b]])) for a, b in zip(edge, edge[1:], strict=False)]
            for g, (a, b) in enumerate(zip(edge, edge[1:], strict=False)):
                for j in range(a, b):
                    pieces.setdefault(text[cut[j] : cut[j + 1]], []).append((len(self.items), g, cut[j]))
            self.items.append((item, k, n, Pattern(text), Pattern(text[::-1]), spans, len(text) < least))
        self.automaton = ahocorasick.Automaton()
        for piece, where in pieces.items():
            self.automaton.add_word(piece, (len(piece), where))
        if pieces:
            self.automaton.make_automaton()
        self.empty = not pieces

    def find(self, text: str, first: bool = False) -> list[tuple[int, int, int, int]]:
        """(item, distance, start, end) of the nearest passage of each item within its budget; with ``first``
        the first one found. ``text`` is normalised."""
        if self.empty or not text:
            return []
        wanted: dict[tuple[int, int], set[int]] = {}
        whole: dict[int, tuple[int, int, int, int]] = {}
        for end, (length, where) in self.automaton.iter(text):
            for i, g, offset in where:
                at = end + 1 - length - offset
                if not self.items[i][6]:
                    wanted.setdefault((i, g), set()).add(at)
                elif i not in whole and _alone(text, at, end + 1):  # a short item: the hit is the whole of it
                    whole[i] = (self.items[i][0], 0, at, end + 1)
                    if first:
                        return [whole[i]]
        lines: dict[int, list[tuple[int, int]]] = {}
        for (i, g), diagonals in wanted.items():
            a, b, budget, pattern = self.items[i][5][g]
            for lo, hi in _runs(sorted(diagonals), budget):
                if pattern.best(text[max(0, lo + a - budget) : hi + b + budget])[0] <= budget:
                    lines.setdefault(i, []).append((lo - budget, hi + budget))
        out = list(whole.values())
        for i, places in lines.items():
            item, k, n, forward, backward, *_ = self.items[i]
            near = None
            for lo, hi in places:
                begin = max(0, lo - k)
                part = text[begin : hi + n + k]
                distance, end = forward.best(part)
                if distance <= k and (near is None or (distance, begin) < near[1:3]):
                    start = end - backward.best(part[:end][::-1], anchored=True)[1]
                    near = (item, distance, begin + start, begin + end)
            if near:
                out.append(near)
                if first:
                    return out
        return out


def _alone(text: str, start: int, end: int) -> bool:
    """Whether no letter or digit touches the ends of a place that begins or ends with one."""
    before = start > 0 and text[start - 1].isalnum() and text[start].isalnum()
    return not before and not (end < len(text) and text[end].isalnum() and text[end - 1].isalnum())


def _runs(at: list[int], gap: int) -> Iterator[tuple[int, int]]:
    """Runs of sorted numbers whose neighbours are at most ``gap`` apart, as (first, last)."""
    lo = hi = at[0]
    for x in at[1:]:
        if x > hi + gap:
            yield lo, hi
            lo = x
        hi = x
    yield lo, hi


def portions(benchmark: DataFrame, item_col: str, text_col: str, most: int | None = None) -> list[DataFrame]:
    """The benchmark in portions of about ``most`` characters, by a hash of items and texts: only one portion at a time goes to the
    driver and the tasks, and the documents are read once for each."""
    size = benchmark.agg(F.sum(F.length(text_col))).first()[0] or 0
    n = -(-size // (most or PORTION)) or 1
    return [benchmark.where(F.pmod(F.xxhash64(item_col, text_col), F.lit(n)) == k) for k in range(n)] if n > 1 else [benchmark]


def blocks(benchmark: DataFrame, item_col: str, text_col: str, chars: int) -> list[list[tuple[int, str]]]:
    """All items of a portion of the benchmark in blocks of about ``chars`` characters, for every task."""
    rows = benchmark.where(F.col(text_col).isNotNull()).select(F.col(item_col).alias("item"), F.col(text_col).alias("text"))
    out, held = [[]], 0
    for r in rows.orderBy("item", "text").toLocalIterator():
        if held and held + len(r["text"]) > chars:
            out, held = [*out, []], 0
        out[-1].append((r["item"], r["text"]))
        held += len(r["text"])
    return out


def _pieces(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """The batches gathered into tables of about ``most`` bytes, so that a matcher serves many texts."""
    held, n = [], 0
    for part in slices(batches):
        held, n = [*held, part], n + part.nbytes
        if n >= most:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


class Matchers:
    """The matchers of all blocks: one block's is built once and kept, those of several are built in turn."""

    def __init__(self, items: list[list[tuple[int, str]]], rate: float, least: int) -> None:
        self.items, self.rate, self.least, self.kept = items, rate, least, None

    def each(self) -> Iterator[Matcher]:
        if len(self.items) == 1:
            self.kept = self.kept or Matcher(self.items[0], self.rate, self.least)
            yield self.kept
        else:
            yield from (Matcher(x, self.rate, self.least) for x in self.items)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", rate: float = RATE, least: int = LEAST, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row for each document and benchmark item whose passage it holds: id, item, ``distance``,
    ``start_char`` and ``end_char`` (of the nearest such passage, in the text in lower case with single
    spaces). Null or empty texts and items have none; repeated rows are reported as often as they occur; a
    passage in many documents, or many items in one, are all reported. Ids and items may be of any type; other
    columns are ignored, whatever their names."""
    parts = portions(benchmark, item_col, item_text)
    if len(parts) > 1:
        work = Scratch(docs.sparkSession, "contamination")
        found = [work.save(_contamination(docs, p, id_col, text_col, item_col, item_text, rate, least, block_chars), str(k)) for k, p in enumerate(parts)]
        return reduce(DataFrame.unionByName, found)
    return _contamination(docs, benchmark, id_col, text_col, item_col, item_text, rate, least, block_chars)


def _contamination(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str, rate: float, least: int, block_chars: int) -> DataFrame:
    spark = docs.sparkSession
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    items = blocks(benchmark, item_col, item_text, block_chars)
    sent = spark.sparkContext.broadcast(items)
    numbered = {item: k for k, item in enumerate(dict.fromkeys(i for block in items for i, _ in block))}
    names = spark.createDataFrame([(k, item) for item, k in numbered.items()], f"k int, item {item_kind}")
    numbers = spark.sparkContext.broadcast(numbered)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = Matchers([[(numbers.value[i], t) for i, t in block] for block in sent.value], rate, least)
        for part in _pieces(batches, HELD if len(sent.value) > 1 else 1):
            texts = [normal(t) for t in part.column(1).to_pylist()]
            rows = [(row, *hit) for m in every.each() for row, t in enumerate(texts) for hit in m.find(t)]
            cols = list(zip(*rows, strict=True)) or [[], [], [], [], []]
            ids = part.column(0).combine_chunks().take(pa.array(cols[0], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, pa.int32()) for c in cols[1:]]], ["id", "k", "distance", "start_char", "end_char"])

    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(scan, f"id {kind}, k int, distance int, start_char int, end_char int")
    out = found.join(F.broadcast(names), "k")  # a row an item of the benchmark
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "distance", "start_char", "end_char")


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", rate: float = RATE, least: int = LEAST, block_chars: int = BLOCK_CHARS, short: bool = False) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no passage of any benchmark item. With ``short`` these are
    the documents for which ``contamination`` reports nothing. Without it an item of fewer than ``least`` characters,
    counted in lower case with single spaces, though reported, is no ground to lose a document. Null and empty texts
    stay."""
    parts = portions(benchmark, item_col, item_text)
    work = Scratch(docs.sparkSession, "clean")
    for k, part in enumerate(parts[:-1]):
        docs = work.save(_clean(docs, part, text_col, item_col, item_text, rate, least, block_chars, short), str(k))
        work.drop(str(k - 1))
    return _clean(docs, parts[-1], text_col, item_col, item_text, rate, least, block_chars, short)


def _clean(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text: str, rate: float, least: int, block_chars: int, short: bool) -> DataFrame:
    at = docs.columns.index(text_col)
    sent = docs.sparkSession.sparkContext.broadcast(blocks(benchmark, item_col, item_text, block_chars))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = Matchers([[(0, t) for _, t in block if short or len(normal(t)) >= least] for block in sent.value], rate, least)
        for part in _pieces(batches, HELD if len(sent.value) > 1 else 1):
            texts = [normal(t) for t in part.column(at).to_pylist()]
            good = [True] * len(texts)
            for m in every.each():
                good = [g and not m.find(t, first=True) for g, t in zip(good, texts, strict=True)]
            yield from part.filter(pa.array(good, pa.bool_())).to_batches()

    return docs.mapInArrow(keep, docs.schema)


def op3_pigeonhole_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passages of ``benchmark`` in all ``documents``; edge cases as in ``contamination``."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
