"""License scan by diagonal voting, in DataFrame functions only.

The hashes of all rolling word k-grams of all texts are joined to the positions they have in license templates;
grams that no template holds are left out before they become rows. Hits vote for the diagonal (position in the text less position in the template); neighbouring diagonals are
merged, so that a few inserted or missing words do not split a notice; a merged run of diagonals is a span,
verified by the share of the template's words that its hits cover and by its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, ascii_lower, table

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
K = 3
#: Diagonals at most so far apart are merged.
SLACK = 2
#: Least share of a template's words that a span's hits cover, and how much longer than the template a span may be.
COVER, LONGER = 0.7, 1.2

#: Phrases of the base scan, by label in sorted order.
PHRASES = {"apache": "apache license", "gpl": "general public license", "mit": "mit license"}

#: Wording of public license notices, (label, text).
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("gpl-2.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License"),
    ("lgpl", "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl-3.0", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
        "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORDS), F.lit(0))


def grams(words: Column, k: int) -> Column:
    """The k-grams of an array of words, as strings, in order."""
    gram = lambda i: F.concat_ws(" ", *[F.get(words, i + j) for j in range(k)])
    return F.when(F.size(words) >= k, F.transform(F.sequence(F.lit(0), F.size(words) - k), gram))


def template_grams(spark: SparkSession, templates: list[tuple[str, str]], k: int) -> DataFrame:
    """(hash, gram, template, label, len, tpos) of a fixed list of texts; its size does not follow the data."""
    t = spark.createDataFrame([(i, label, text) for i, (label, text) in enumerate(templates)], "template int, label string, t string")
    t = t.withColumn("w", words_of(F.col("t")))
    return t.select("template", "label", F.size("w").alias("len"), F.posexplode(grams(F.col("w"), k)).alias("tpos", "gram")).withColumn("hash", F.xxhash64("gram"))


def gram_hits(words: Column, hashes: list[int], k: int) -> Column:
    """Array of (pos, hash) of the k-grams of an array of words whose hash is in a fixed list."""
    at = lambda i: F.struct(i.alias("pos"), F.xxhash64(F.concat_ws(" ", *[F.get(words, i + j) for j in range(k)])).alias("hash"))
    every = F.transform(F.sequence(F.lit(0), F.size(words) - k), at)
    return F.when(F.size(words) >= k, F.filter(every, lambda x: x["hash"].isin(hashes))).otherwise(F.array().cast("array<struct<pos:int,hash:bigint>>"))


def spans_of(hits: DataFrame, grams_: DataFrame, k: int = K, slack: int = SLACK, cover: float = COVER) -> DataFrame:
    """(id, text_hash, ``hits``) -> (id, text_hash, label, template, start_word, end_word, cover, verified)."""
    # The outer form: before a plain explode Spark tests the array, and would make it anew for that.
    rolled = hits.select("id", "text_hash", F.explode_outer("hits").alias("x")).select("id", "text_hash", "x.pos", "x.hash").where("hash is not null")
    met = rolled.join(F.broadcast(grams_), "hash")
    key = ["id", "text_hash", "template"]
    votes = met.groupBy(*key, "label", "len", (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(
        F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.collect_set("tpos").alias("tpos")
    )
    along = Window.partitionBy(*key).orderBy("diagonal")
    new = (F.col("diagonal") - F.lag("diagonal").over(along) > slack).cast("int")
    runs = votes.withColumn("run", F.sum(F.coalesce(new, F.lit(0))).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    spans = runs.groupBy(*key, "label", "len", "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.array_distinct(F.flatten(F.collect_list("tpos"))).alias("tpos"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("tpos", lambda p: F.sequence(p, p + (k - 1))))))
    spans = spans.withColumn("cover", covered / F.col("len"))
    length = F.col("hi") + k - F.col("lo")
    return spans.select(
        "id", "text_hash", "label", "template", F.col("lo").alias("start_word"), (F.col("hi") + k).alias("end_word"), "cover",
        ((F.col("cover") >= cover) & (length <= F.col("len") * LONGER + slack * 2)).alias("verified"),
    )


def license_spans(docs: DataFrame, templates: list[tuple[str, str]] | None = None, k: int = K, slack: int = SLACK, cover: float = COVER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of license notices: (id, text_hash, label, template, start_word, end_word, cover, verified).

    ``text_hash`` is xxhash64 of the text, so that rows equal in id and text give one set of spans. A null
    text counts as empty. ``end_word`` is exclusive. Templates have at least ``k`` words. Texts of any length are
    read whole; other columns are ignored, whatever their names.
    """
    known = template_grams(docs.sparkSession, templates or TEMPLATES, k)
    hashes = [r["hash"] for r in known.select("hash").distinct().collect()]  # of a fixed list
    words = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), words_of(F.col(text_col)).alias("w"))
    return spans_of(words.select("id", "text_hash", gram_hits(F.col("w"), hashes, k).alias("hits")), known, k, slack, cover)


def license_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] | None = None, k: int = K, slack: int = SLACK, cover: float = COVER) -> DataFrame:
    """One row per document: word and phrase counts, labels and a score.

    Columns: id, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``,
    ``score`` (largest share of a template found; 0 without any). Null, empty and wordless texts have no
    words, null places, empty labels and score 0. Repeated rows are reported as often as they occur. Other columns
    are ignored, whatever their names.
    """
    spark, work = docs.sparkSession, Scratch(docs.sparkSession, "licenses")
    known = template_grams(spark, templates or TEMPLATES, k)
    hashes = [r["hash"] for r in known.select("hash").distinct().collect()]  # of a fixed list
    low = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), ascii_lower(F.col(text_col)).alias("low"))
    base = low.select("id", "text_hash", F.contains("low", F.lit("license")).alias("any"), F.regexp_extract_all("low", F.lit(WORDS), F.lit(0)).alias("w"))
    w = F.col("w")

    def places(phrase: str) -> Column:
        parts = phrase.split()
        here = lambda i: F.forall(F.array(*[F.struct(F.lit(j).alias("j"), F.lit(p).alias("p")) for j, p in enumerate(parts)]), lambda x: F.get(w, i + x["j"]) == x["p"])
        return F.when(F.col("any") & (F.size(w) >= len(parts)), F.filter(F.sequence(F.lit(0), F.size(w) - len(parts)), here)).otherwise(F.array().cast("array<int>"))

    # The words of a text are split once: what is found in them is written, and both parts go on from there.
    found = base.select("id", "text_hash", F.size(w).cast("long").alias("n_words"), *[places(p).alias(label) for label, p in PHRASES.items()], gram_hits(w, hashes, k).alias("hits"))
    found = work.save(found, "found")
    every = F.concat(*PHRASES)
    named = F.array_compact(F.array(*[F.when(F.size(label) > 0, F.lit(label)) for label in PHRASES]))
    base = found.select(
        "id", "text_hash", "n_words", F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"), named.alias("named")
    )
    spans = spans_of(found.select("id", "text_hash", "hits"), known, k, slack, cover)
    spans = spans.groupBy("id", "text_hash").agg(F.collect_set(F.when(F.col("verified"), F.col("label"))).alias("found"), F.max("cover").alias("cover"))
    spans = spans.select(F.col("id").alias("fid"), F.col("text_hash").alias("fhash"), "found", "cover")
    out = base.join(spans.hint("merge"), F.col("id").eqNullSafe(F.col("fid")) & (F.col("text_hash") == F.col("fhash")), "left")
    labels = F.array_sort(F.array_union("named", F.coalesce("found", F.array().cast("array<string>"))))
    return out.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join("named", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), F.coalesce("cover", F.lit(0.0)).alias("score"),
    )


def op10_diagonal_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in all ``documents``; edge cases as in ``license_report``."""
    return license_report(table(spark, sf_dir, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = lambda c: rf"regexp_extract_all(translate(coalesce({c}, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_PLACES = ", ".join(f"list_filter(CASE WHEN list_contains(w, 'license') THEN range(len(w)) ELSE [] END, lambda i: w[i + 1:i + {len(p.split())}] = {p.split()!r}) AS {label}" for label, p in PHRASES.items())
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, {_WORDS('text')} AS w FROM documents
), b AS (SELECT n, doc_id, len(w) AS n_words, {_PLACES} FROM d
), t AS (SELECT template, label, len(w) AS size, unnest(range(len(w) - {K - 1})) AS tpos, w FROM (SELECT template, label, {_WORDS('body')} AS w FROM (VALUES
  {', '.join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate((x, y.replace("'", "''")) for x, y in TEMPLATES))}) v(template, label, body))
), g AS (SELECT template, label, size, tpos, array_to_string(w[tpos + 1:tpos + {K}], ' ') AS gram FROM t
), r AS (SELECT n, pos, array_to_string(w[pos + 1:pos + {K}], ' ') AS gram FROM (SELECT n, w, unnest(range(len(w) - {K - 1})) AS pos FROM d)
), h AS (SELECT n, template, label, size, pos, tpos, pos - tpos AS diagonal FROM r JOIN g USING (gram)
), v AS (SELECT n, template, diagonal, diagonal - lag(diagonal) OVER (PARTITION BY n, template ORDER BY diagonal) > {SLACK} AS new FROM (SELECT DISTINCT n, template, diagonal FROM h)
), m AS (SELECT n, template, diagonal, sum(coalesce(new, false)::INT) OVER (PARTITION BY n, template ORDER BY diagonal) AS run FROM v
), s AS (SELECT n, template, label, size, run, min(pos) AS lo, max(pos) AS hi, list(DISTINCT tpos) AS held FROM h JOIN m USING (n, template, diagonal) GROUP BY ALL
), c AS (SELECT n, label, size, lo, hi, len(list_distinct(flatten(list_transform(held, lambda p: range(p, p + {K}))))) / size AS cover FROM s
), f AS (SELECT n, list(DISTINCT label) FILTER (cover >= {COVER} AND hi + {K} - lo <= size * {LONGER} + {2 * SLACK}) AS found, max(cover) AS cover FROM c GROUP BY n
), x AS (SELECT *, list_concat(apache, gpl, mit) AS places, list_filter([CASE WHEN len(apache) > 0 THEN 'apache' END, CASE WHEN len(gpl) > 0 THEN 'gpl' END, CASE WHEN len(mit) > 0 THEN 'mit' END], lambda l: l IS NOT NULL) AS named FROM b)
SELECT doc_id, n_words::BIGINT AS n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT AS first_word, list_max(places)::BIGINT AS last_word, array_to_string(named, ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(named, coalesce(found, [])))), ',') AS labels, coalesce(cover, 0)::DOUBLE AS score
FROM x LEFT JOIN f ON x.n = f.n
"""
