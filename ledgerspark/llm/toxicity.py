"""Toxicity by a convolutional text classifier: hashed word embeddings, filters over one to three words, max
pooling over the whole text and a logistic layer, trained in numpy on all labelled texts.

The labelled texts are dealt to parts by a hash. In each round every part goes on training from the same network, each in its
task, and Spark takes the mean of what came out: of an embedding over the parts that changed it, by how often they did.

Words are lower-cased runs of letters and digits. A word's vector is the sum of hashed embeddings, one of the word
and one of each of its beginnings of ``STARTS`` letters, so that words never seen share what is known of
their stem. Thresholds are calibrated
by language: the language is predicted from the text alone (PPM code lengths), each language's threshold is
the one with the best F1 on the quarter of the labelled texts that is kept out of training, drawn towards that of all languages the more the
fewer documents it rests on, and scores are shifted on the logit scale so that the threshold is at 0.5.
"""

from __future__ import annotations

import copy
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import language
from ledgerspark.llm.common import Scratch, fold, slices, table, utf8

WORDS = re.compile(r"[^\W_]+")
#: Texts with more different characters outside words than this are split by the expression, others by putting spaces for them.
ODD = 64
ROWS, DIM, WIDTHS, FILTERS = 1 << 15, 8, (1, 2, 3), 6
#: Lengths of the word beginnings with an embedding of their own, and characters whose words are told apart at once, about.
STARTS, GROUP = (4, 5, 6), 1 << 20
#: Size of a part of the training texts, about: documents of each label, words of all of them.
SAMPLE, SAMPLE_WORDS = 4000, 1_500_000
#: Letters a word, about, where words are not counted yet; steps a unit of the logit in the thresholds' histograms; bits of the filter
#: of labelled ids at most, and bits an id.
LETTERS, FINE, BITS, SPARSE = 6, 256, 1 << 28, 16
EPOCHS, RATE, DECAY, SEED = 8, 0.25, 1e-5, 3
#: Training steps at least: small samples are gone through more often.
LEAST_STEPS = 8000
#: An embedding counts d / (d + RARE) of its size, for d training documents that hold its word.
RARE = 2
#: Share of a text's words that a training step sees.
KEEP = 0.5
#: All filters of all widths, shorter ones first, and those of more than j words, which have a row for their word j in ``Network.maps``.
ALL, LONGER = len(WIDTHS) * FILTERS, [sum(w > j for w in WIDTHS) * FILTERS for j in range(max(WIDTHS))]
#: Of each row of ``Network.maps``, its filter and its word.
FILTER, PLACE = np.concatenate([np.arange(ALL - n, ALL) for n in LONGER]), np.repeat(np.arange(len(LONGER)), LONGER)
#: A language's own threshold and that of all languages are mixed in the proportion of its documents in the
#: calibration part and this many.
OWN = 60


def spaced(text: str | None) -> str:
    """The words of the whole text, as ``WORDS`` finds them in its lower case, with spaces between them."""
    text = (text or "").lower()
    odd = [c for c in set(text) if not c.isalnum()]
    if len(odd) > ODD:
        return " ".join(WORDS.findall(text))
    for c in odd:
        text = text.replace(c, " ")
    return text.strip(" ")


def _hashes(words: pa.StringArray) -> np.ndarray:
    """Embedding rows of words: a row a word, its hash and those of its beginnings."""
    strings = lambda a: a.to_numpy(zero_copy_only=False).tolist()
    hashes = lambda texts: np.array([xxhash.xxh32_intdigest(t) for t in texts], np.intp) % ROWS
    rows = [hashes(strings(words))]
    for n in STARTS:
        start = pc.utf8_slice_codeunits(words, 0, n).dictionary_encode()
        rows.append(hashes([f"{n}^{t}" for t in strings(start.dictionary)]).take(start.indices.to_numpy()))
    return np.stack(rows, axis=1)


def words_in(texts: list[str | None]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """All the texts in order, some at a time: the embedding rows of their different words, and of each text the numbers of its words."""
    lo = 0
    while lo < len(texts):
        some, size = [], 0
        while lo < len(texts) and size < GROUP:
            some.append(spaced(texts[lo]) or None)
            size += len(some[-1] or "")
            lo += 1
        words = pc.ascii_split_whitespace(pa.array(some, pa.string()))
        ends = np.cumsum(pc.fill_null(pc.list_value_length(words), 0))
        words = words.flatten().dictionary_encode()
        yield _hashes(words.dictionary), np.split(words.indices.to_numpy(), ends[:-1])


def words_of(text: str | None) -> np.ndarray:
    """Embedding rows of the words of the whole text: a row a word, its hash and those of its beginnings."""
    rows, (places,) = next(words_in([text]))
    return rows.take(places, axis=0)


@dataclass
class Network:
    """``maps`` holds what each filter takes of its first word, then what those of two and more words take of their second, and so on."""

    table: np.ndarray
    maps: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Network:
        normal = lambda *s: (rng.standard_normal(s) * 0.3).astype(np.float32)
        table, filters = normal(ROWS, DIM), [normal(w, DIM, FILTERS) for w in WIDTHS]
        maps = np.concatenate([f[j].T for j in range(max(WIDTHS)) for f in filters if len(f) > j])
        return cls(table, maps, np.zeros(ALL, np.float32), normal(ALL), 0.0)

    def vectors(self, ids: np.ndarray) -> np.ndarray:
        """The sum of the embeddings of each row of ``ids``."""
        e = self.table.take(ids[:, 0], axis=0)
        for k in range(1, ids.shape[1]):
            e += self.table.take(ids[:, k], axis=0)
        return e

    def pooled(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``best`` of the words' vectors."""
        return self.best(lambda lo, hi: self.vectors(ids[lo:hi]), len(ids))

    def best(self, vectors: Callable[[int, int], np.ndarray], n: int, chunk: int = 4096) -> tuple[np.ndarray, np.ndarray]:
        """Largest activation of every filter over ``n`` words, and where; 0 and -1 where no window exists or all
        are negative. Windows are taken in chunks, so memory is bounded for any length."""
        best, where = np.zeros(ALL, np.float32), np.full(ALL, -1)
        for at in range(0, n, chunk):
            a = self.maps @ vectors(at, at + chunk + max(WIDTHS) - 1).T  # a row a filter and word, a column a place
            top, row = a[:ALL], ALL
            for j, longer in enumerate(LONGER[1:], 1):
                top[-longer:, :-j] += a[row : row + longer, j:]
                top[-longer:, -j:] = -np.inf  # no room for a window
                row += longer
            first = top[:, :chunk].argmax(axis=1)
            value = top[np.arange(ALL), first] + self.bias
            better = value > best
            best[better] = value[better]
            where[better] = at + first[better]
        return best, where

    def logit(self, ids: np.ndarray) -> float:
        return float(self.pooled(ids)[0] @ self.out + self.out_bias)

    def logits(self, rows: np.ndarray, texts: list[np.ndarray]) -> list[float]:
        """As ``logit`` of each text, whose words are given by their numbers in ``rows``; a word's embeddings are summed once."""
        e = self.vectors(rows)
        best = lambda t: self.best(lambda lo, hi: e.take(t[lo:hi], axis=0), len(t))[0]
        return [float(best(t) @ self.out + self.out_bias) for t in texts]


@dataclass
class State:
    """A network in training: sums of squared gradients, how far each embedding is trusted, and how often each was changed."""

    net: Network
    trust: np.ndarray
    rows: np.ndarray = field(default_factory=lambda: np.full(ROWS, 1e-3, np.float32))
    rest: np.ndarray | None = None
    turns: np.ndarray = field(default_factory=lambda: np.zeros(ROWS))

    def packed(self) -> np.ndarray:
        """All numbers but the embeddings and theirs, in rows of DIM + 1."""
        flat = np.concatenate((self.net.maps.ravel(), self.net.bias, self.net.out, [self.net.out_bias], self.rest))
        return np.resize(np.concatenate((flat, np.zeros(-len(flat) % (DIM + 1)))), (-(-len(flat) // (DIM + 1)), DIM + 1))

    def unpack(self, flat: np.ndarray) -> None:
        net, size = self.net, len(self.rest)
        maps, net.bias, net.out, last = np.split(flat.ravel().astype(np.float32), np.cumsum([net.maps.size, ALL, ALL]))
        net.maps, net.out_bias, self.rest = maps.reshape(-1, DIM), float(last[0]), last[1 : 1 + size]

    @classmethod
    def fresh(cls, df: np.ndarray, seed: int = SEED) -> State:
        trust = (df / (df + RARE)).astype(np.float32)[:, None]
        net = Network.fresh(np.random.default_rng(seed))
        net.table *= trust
        return cls(net, trust, rest=np.full(net.maps.size + 2 * ALL, 1e-3, np.float32))


def train(state: State, texts: list[np.ndarray], labels: np.ndarray, weight: dict[int, float], rates: list[float], seed: int) -> None:
    """An epoch for each of ``rates`` of Adagrad on the logistic loss, one text at a time; only the pooled windows get gradients.
    A text of label y counts ``weight[y]`` times."""
    rng, net = np.random.default_rng(seed), state.net
    seen_maps, seen_bias, seen_out = np.split(state.rest, np.cumsum([net.maps.size, ALL]))  # views
    seen_maps, flat, many = seen_maps.reshape(-1, DIM), net.table.reshape(-1), 1 + len(STARTS)
    one, dims = np.ones(len(FILTER) * many), np.arange(DIM)
    for rate in rates:
        for i in rng.permutation(len(texts)):
            kept = (rng.random(len(texts[i])) < KEEP).nonzero()[0]
            ids = texts[i].take(kept, axis=0).astype(np.intp)
            h, where = net.pooled(ids)
            p = 1 / (1 + np.exp(-max(-30, min(30, h @ net.out + net.out_bias))))
            g = np.float32((p - labels[i]) * weight[int(labels[i])])
            grad = g * h + DECAY * net.out
            back = g * net.out
            seen_out += grad * grad
            net.out -= rate * grad / np.sqrt(seen_out)
            net.out_bias -= rate * float(g) * 0.1
            live = where >= 0
            if live.all():
                c, m, own, word = slice(None), slice(None), FILTER, PLACE
            elif live.any():
                c, m = live, live[FILTER]
                own, word = FILTER[m], PLACE[m]
            else:
                continue
            b = back[c]
            seen_bias[c] += b * b
            net.bias[c] -= rate * b / np.sqrt(seen_bias[c])
            b, met = back[own][:, None], ids.take(where[own] + word, axis=0)
            maps = net.maps[m]
            up, down = net.vectors(met) * b, maps * b
            seen_maps[m] += up * up
            net.maps[m] = maps - rate * up / np.sqrt(seen_maps[m])
            r = met.ravel()
            np.add.at(state.rows, r, (np.einsum("ij,ij->i", down, down) / np.float32(DIM)).repeat(many))
            np.add.at(state.turns, r, one[: len(r)])
            share = (rate * state.trust[r, 0] / np.sqrt(state.rows[r])).reshape(-1, many, 1)
            np.subtract.at(flat, (met[:, :, None] * DIM + dims).ravel(), (share * down[:, None]).ravel())


def threshold(logits: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> float:
    """The logit with the best F1, in the middle of the gap below it; row k counts ``counts[k]`` times."""
    order = np.argsort(-logits, kind="stable")
    y, z, n = labels[order], logits[order], counts[order]
    hit = np.cumsum(y * n)
    f1 = 2 * hit / (hit + np.cumsum((1 - y) * n) + max(1, (y * n).sum()))
    last = np.append(z[:-1] > z[1:], True)
    best = int(np.argmax(np.where(last, f1, -1)))
    return float((z[best] + z[best + 1]) / 2 if best + 1 < len(z) else z[best] - 1)


@dataclass
class Classifier:
    net: Network | None
    languages: language.Model
    cuts: dict[str, float]
    cut: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.net is None:
            return np.zeros(len(texts))
        logits = np.array([z for rows, places in words_in(texts) for z in self.net.logits(rows, places)])
        cuts = np.full(len(texts), self.cut)
        if self.languages.languages:
            best, _ = self.languages.predict(utf8(texts))
            cuts = np.array([self.cuts.get(self.languages.languages[b], self.cut) for b in best])
        return 1 / (1 + np.exp(-np.clip(logits - cuts, -30, 30)))


def _marked(docs: DataFrame, known: DataFrame, n: int) -> DataFrame:
    """The rows of ``docs`` whose id ``i`` may be among the ``n`` of ``known``, so that few other texts are shuffled: a bitmap of hashes of
    ids, BITS bits at most. All rows of known ids stay."""
    place = F.pmod(F.xxhash64(F.lit(SEED + 1), "i"), F.lit(min(BITS, max(1 << 15, SPARSE * n)))) + 1
    bits = known.select(place.alias("x")).groupBy(F.bitmap_bucket_number("x").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("x")).alias("bits"))
    at = F.bitmap_bit_position("x").cast("int")
    byte = F.conv(F.hex(F.substring("bits", at / 8 + 1, F.lit(1))), 16, 10).cast("int")
    rows = docs.withColumn("x", place).join(F.broadcast(bits), F.bitmap_bucket_number("x") == F.col("b"))
    return rows.where(F.floor(byte / F.pow(F.lit(2.0), at % 8)) % 2 == 1).select(*docs.columns)


def fit(docs: DataFrame, labels: DataFrame, languages: language.Model, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE, sample_words: int = SAMPLE_WORDS) -> Classifier:
    """Learn from all labelled documents, whole texts, in parts of about ``sample`` documents of a label and ``sample_words`` words.

    Rows whose label is not 0 or 1 are left out, as are documents with two different labels. A quarter of the documents of
    each label is kept for the thresholds. With one label only, or none, every score is 0. Rows that repeat a labelled id all
    count. Other columns are ignored, whatever their names. A task holds the words of one part; the driver holds one
    network and histograms of logits.
    """
    spark, work = docs.sparkSession, Scratch(docs.sparkSession, "toxicity")
    known = labels.select(F.col(id_col).alias("i"), F.col(label_col).alias("y")).where(F.col("y").isin(0, 1) & F.col("i").isNotNull())
    known = known.groupBy("i").agg(F.min("y").cast("int").alias("y"), F.max("y").alias("z")).where("y = z").select("i", "y")
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("text"))
    light = rows.select("i", F.length("text").cast("long").alias("n")).join(known.hint("merge"), "i")
    sizes = {r["y"]: r for r in light.groupBy("y").agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).collect()}
    if len(sizes) < 2:
        return Classifier(None, languages, {}, 0.0)
    total = sum(r["docs"] for r in sizes.values())
    parts = max(*(-(-r["docs"] // sample) for r in sizes.values()), -(-sum(r["n"] for r in sizes.values()) // (LETTERS * sample_words)))
    part = lambda d: d.withColumns({"part": F.pmod(F.xxhash64(F.lit(SEED + 2), "i"), F.lit(parts)), "h": F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "i"), 1)})
    shared = spark.sparkContext.broadcast(languages)  # bounded by its sample

    def learnt(texts: pa.Table, own: pa.Table) -> pa.Table:
        """The words of a part's labelled texts; its documents in the order of a hash, label by label in turn."""
        label = dict(zip(own.column("i").to_pylist(), own.column("y").to_pylist(), strict=True))
        met = sorted((label[i], h, i, t or "") for i, h, t in zip(texts.column("i").to_pylist(), texts.column("h").to_pylist(), texts.column("text").to_pylist(), strict=True) if i in label)
        turn, last, out = -1, None, []
        for y, h, i, t in met:
            turn = 0 if last is None or last[0] != y else turn + (last != (y, h, i))
            last = (y, h, i)
            out.append((turn, y, t))
        out.sort()
        held = [t for k, _, t in out if k % 4 == 3] if len(met) >= 8 else [t for _, _, t in out]
        best = iter(shared.value.predict(utf8(held))[0].tolist() if shared.value.languages and held else [])
        lang = [next(best, -1) if len(met) < 8 or k % 4 == 3 else -1 for k, _, _ in out]
        words = [rows.take(t, axis=0).astype(np.int16).tobytes() for rows, some in words_in([t for _, _, t in out]) for t in some]
        return pa.table({"part": pa.array([texts.column("part")[0].as_py()] * len(out) if out else [], pa.int64()), "k": pa.array([k for k, _, _ in out], pa.int64()), "y": pa.array([y for _, y, _ in out], pa.int32()), "lang": pa.array(lang, pa.int32()), "ids": pa.array(words, pa.binary())})

    both = part(_marked(rows, known, total)).groupBy("part").cogroup(part(known).groupBy("part"))
    data = work.save(both.applyInArrow(learnt, "part long, k long, y int, lang int, ids binary"), "words")
    held = F.col("k") % 4 == 3
    split = {(r["y"], r["held"]) for r in data.select("y", held.alias("held")).distinct().collect()}
    split = len(split) == 4  # both labels on either side
    learn = data.where(~held) if split else data
    counts = {r["y"]: r["count"] for r in learn.groupBy("y").count().collect()}
    n = sum(counts.values())
    weight = {y: 0.5 * n / c for y, c in counts.items()}

    def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
        """Part by part, rows of which lie together: its texts and labels."""
        now, texts, ys = None, [], []
        for batch in batches:
            for p, y, ids in zip(*(batch.column(c).to_pylist() for c in ("part", "y", "ids")), strict=True):
                if p != now and texts:
                    yield now, texts, np.array(ys)
                    texts, ys = [], []
                now = p
                texts.append(np.frombuffer(ids, np.int16).reshape(-1, 1 + len(STARTS)))
                ys.append(y)
        if texts:
            yield now, texts, np.array(ys)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts, _ in texts_of(batches):
            df = np.zeros(ROWS, np.int64)
            for t in texts:
                df[np.unique(t)] += 1
            r = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(r.astype(np.int32)), pa.array(df[r])], ["r", "n"])

    df = np.zeros(ROWS, np.int64)
    for r in learn.mapInArrow(documents, "r int, n long").groupBy("r").agg(F.sum("n").alias("n")).collect():  # ROWS at most
        df[r["r"]] = r["n"]
    state = State.fresh(df)
    epochs = max(EPOCHS, -(-LEAST_STEPS // n))
    rates = [RATE * (1 - 0.8 * e / max(1, epochs - 1)) for e in range(epochs)]
    each = epochs if parts == 1 else -(-epochs // EPOCHS)
    for at in range(0, epochs, each):
        state = _round(learn, state, texts_of, weight, rates[at : at + each], at)
    model = Classifier(state.net, languages, {}, 0.0)
    net = spark.sparkContext.broadcast(state.net)

    def logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = [net.value.logit(np.frombuffer(t.as_py(), np.int16).reshape(-1, 1 + len(STARTS))) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.round(np.clip(z, -99, 99) * FINE).astype(np.int64))], ["y", "lang", "z"])

    met = (data.where(held) if split else data).select("y", "lang", "ids").mapInArrow(logits, "y int, lang int, z long").groupBy("y", "lang", "z").count().toArrow()
    work.drop("words")
    y, z, lang, c = (met.column(k).to_numpy() for k in ("y", "z", "lang", "count"))
    z = z / FINE
    model.cut = threshold(z, y, c)
    for k, name in enumerate(languages.languages):
        own = lang == k
        if len(set(y[own])) == 2:
            share = c[own].sum() / (c[own].sum() + OWN)
            model.cuts[name] = float(share * threshold(z[own], y[own], c[own]) + (1 - share) * model.cut)
    return model


def _round(learn: DataFrame, state: State, texts_of: Callable, weight: dict[int, float], rates: list[float], seed: int) -> State:
    """All parts train on from ``state``, and the mean of what they come to: ROWS rows and the filters come to the driver."""
    begin = learn.sparkSession.sparkContext.broadcast(state)  # about 2 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts, ys in texts_of(batches):
            own = copy.deepcopy(begin.value)
            own.turns[:] = 0
            train(own, texts, ys, weight, rates, [SEED, part, seed])
            r = np.flatnonzero(own.turns)
            rest = own.packed()
            v = np.concatenate((np.concatenate((own.net.table[r], own.rows[r][:, None]), axis=1), rest)).astype(np.float64)
            w = np.concatenate((own.turns[r], np.full(len(rest), float(len(texts)))))
            key = np.concatenate((r, ROWS + np.arange(len(rest)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(w), *(pa.array(v[:, j] * w) for j in range(DIM + 1))], ["r", "w", *(f"v{j}" for j in range(DIM + 1))])

    names = [f"v{j}" for j in range(DIM + 1)]
    met = learn.mapInArrow(run, "r int, w double, " + ", ".join(f"{v} double" for v in names)).groupBy("r").agg(*[(F.sum(v) / F.sum("w")).alias(v) for v in names]).toArrow()
    r, v = met.column("r").to_numpy(), np.stack([met.column(x).to_numpy() for x in names], axis=1)
    own, rest = r < ROWS, np.argsort(r)[-(r >= ROWS).sum() :]
    state.net.table[r[own]], state.rows[r[own]] = v[own, :DIM], v[own, DIM]
    state.unpack(v[rest])
    return state


def score(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` -> (id, ``score``, ``predicted``) from the whole text alone. Null and empty texts are scored
    as texts without words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # ROWS embeddings and the bounded language model

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            p = shared.value.scores(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))], ["id", "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(apply, f"id {kind}, score double, predicted int").withColumnRenamed("id", id_col)


def op7_cnn_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all ``documents``, learnt from the ``labels`` of four fifths; edge cases as in ``fit`` and
    ``score``."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    open_ = fold(F.col("doc_id"), 5) != 0
    languages = language.fit(docs.where(open_))
    model = fit(docs.where(open_), labels.where(open_), languages)
    held = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")
