"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

Base spans (e-mail, IP, card and phone numbers) are the protected entities, each also as a member of its group (mail
domain, the IP's or the number's beginning) and of its kind, so that what a single text cannot show is backed by all
texts of the group or kind. Corpus co-occurrence tells how strongly a term reveals an entity, a group or a kind: the
pointwise mutual information of both over documents, as a share of the entity's information content (1 for a term that
occurs with the entity only), discounted by t / (t + 1) for t different texts that hold both: 0.5 for a pair seen in
one text, so that a word that is merely rare reveals nothing, 0.67 for two, 0.86 for six. The discount hangs on no
size. Of a term's entities in a document the most revealing counts. From ``generalise`` on a term is generalised to its kind where the
entity occurs, from ``remove`` on it is removed.
All counts are of whole documents, so it does not matter how far from the entity a term stands; terms inside base
spans are no terms of their document. Entities of the same documents have the same counts and are scored once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, table

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. Runs are taken whole and without backtracking, which changes no match: a
#: match starts where its run starts or where the match before it ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+"
CARD = r"[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TERM = r"[\p{L}\p{N}]+"

GENERALISE, REMOVE = 0.6, 0.85
SPAN = "struct<kind:string,start:int,end:int,hit:string>"


def _places(text: Column, pattern: str, kind: str, may: Column) -> Column:
    """All matches with their places, in code points; ``may`` is a cheap test that is true where one exists."""
    pieces, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def step(acc: Column, i: Column) -> Column:
        start = acc["at"] + F.length(F.get(acc["pieces"], i))
        hit = F.get(acc["hits"], i)
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(hit)).alias("end"), hit.alias("hit"))
        return F.struct((start + F.length(hit)).alias("at"), F.concat(acc["out"], F.array(span)).alias("out"), acc["pieces"].alias("pieces"), acc["hits"].alias("hits"))

    none = F.array().cast(f"array<{SPAN}>")
    begin = F.struct(F.lit(0).alias("at"), none.alias("out"), pieces.alias("pieces"), hits.alias("hits"))
    found = F.aggregate(F.when(may, F.sequence(F.lit(0), F.size(hits) - 1)), begin, step, lambda acc: acc["out"])
    return F.when(may, found).otherwise(none)


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _byte(part: Column) -> Column:
    bare = F.ltrim(part, F.lit("0"))
    return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= F.lit("255")))


def base_spans(text: Column) -> Column:
    """Array of (kind, start, end, hit): the base spans of a text without nulls, by kind, then start."""
    email = _places(text, EMAIL, "email", F.contains(text, F.lit("@")) & text.rlike(EMAIL))
    ip = F.filter(_places(text, IP, "ip", text.rlike(IP)), lambda s: F.forall(F.split(s["hit"], r"\."), _byte))
    card = F.filter(_places(text, CARD, "card", text.rlike(CARD)), lambda s: F.length(_digits(s["hit"])).between(16, 19) & F.call_function("luhn_check", _digits(s["hit"])))
    phone = F.filter(_places(text, PHONE, "phone", F.contains(text, F.lit("+")) & text.rlike(PHONE)), lambda s: F.length(_digits(s["hit"])).between(8, 15))
    return F.concat(email, ip, card, phone)


def entities(span: Column) -> Column:
    """What a base span protects: its value, its group and its kind."""
    hit, kind = F.lower(span["hit"]), span["kind"]
    group = F.when(kind == "email", F.substring_index(hit, "@", -1)).when(kind == "ip", F.substring_index(hit, ".", 2)).when(kind == "card", F.substring(_digits(hit), 1, 6)).otherwise(F.substring(_digits(hit), 1, 4))
    return F.array(F.concat_ws("=", kind, hit), F.concat_ws("~", kind, group), kind)


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def sanitised(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its tag; of overlapping spans the first by place counts."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["tag"])))

    def step(acc: Column, s: Column) -> Column:
        out = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), s["tag"])
        nxt = F.struct(s["end"].alias("at"), out.alias("out"))
        return F.when(s["start"] >= acc["at"], nxt).otherwise(acc)

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(ordered, begin, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def sanitise(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    generalise: float = GENERALISE,
    remove: float = REMOVE,
) -> DataFrame:
    """One row per document: id, ``text_hash``, ``base`` and ``added`` spans (kind, start, end, ...) and ``clean_text``,
    the text with base spans as ``[EMAIL]`` and the like and telling terms as ``[TERM]`` or ``[NUMBER]``, or removed; null
    where nothing is replaced.

    Places are code points, ends exclusive. Null texts count as empty and give no spans; ids may be null or
    repeat; rows equal in id and text get equal spans. Documents without a base span are never changed.
    """
    spark, work = docs.sparkSession, Scratch(docs.sparkSession, "privacy")
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("h", F.xxhash64("text"))
    found = docs.withColumn("base", base_spans(F.col("text")))
    bare = sanitised(F.col("text"), F.transform("base", lambda s: F.struct(s["start"], s["end"], F.lit(" ").alias("tag"))))
    ents = F.array_distinct(F.flatten(F.transform("base", entities)))
    found = found.withColumn("ents", ents).withColumn("terms", F.when(F.size("base") > 0, F.array_distinct(terms(bare))))
    kept = F.when(F.size("base") > 0, F.col("text")).alias("text")  # texts without an entity are never changed
    found = work.save(found.select("id", "h", "base", "ents", "terms", kept), "found")

    # Document counts of entities, of terms with them, and of terms in the whole corpus; equal rows count apart.
    n = F.lit(docs.select(F.count("*")).first()[0])
    held = found.where(F.size("base") > 0)
    place = F.struct("id", "h")
    df_e = held.select("id", "h", F.explode("ents").alias("e")).groupBy("e").agg(
        F.count("*").alias("df_e"), F.bit_xor(F.xxhash64(F.lit(1), place)).alias("x"), F.bit_xor(F.xxhash64(F.lit(2), place)).alias("y"), F.sum(F.pmod(F.xxhash64(F.lit(3), place), F.lit(1 << 31))).alias("z")
    )
    # One entity of those that stand in the same rows.
    df_e = work.save(df_e.groupBy("df_e", "x", "y", "z").agg(F.min("e").alias("e")).select("e", "df_e"), "entities")
    key = lambda x, y: F.col(f"{x}.id").eqNullSafe(F.col(f"{y}.id")) & (F.col(f"{x}.h") == F.col(f"{y}.h"))
    few = held.select("id", "h", F.explode("ents").alias("e")).join(df_e.select("e").hint("merge"), "e", "left_semi")
    few = work.save(few.groupBy("id", "h").agg(F.collect_set("e").alias("ents")), "few")
    pairs = held.alias("f").join(few.alias("g").hint("merge"), key("f", "g")).select("f.id", "f.h", "f.terms", F.explode("g.ents").alias("e"))
    pairs = pairs.select("id", "h", "e", F.explode("terms").alias("t"))
    df_et = pairs.groupBy("e", "t").agg(F.count("*").alias("df_et"), F.countDistinct("h").alias("texts"))
    weight = F.col("texts") / (F.col("texts") + 1)
    joint = df_et.withColumn("weight", weight).where(F.col("weight") >= generalise)  # no share is above 1, so others reveal too little
    joint = work.save(joint.join(df_e.hint("merge"), "e").drop("texts"), "joint")
    # The outer form: before a plain explode Spark tests the array, and would make it anew for that.
    df_t = docs.select(F.explode_outer(F.array_distinct(terms(F.col("text")))).alias("t")).where("t is not null").groupBy("t").agg(F.count("*").alias("df_t"))
    both = df_t.join(joint.hint("merge"), "t")
    pmi = F.log2(n * F.col("df_et") / (F.col("df_t") * F.col("df_e")))
    known = F.log2(n / F.col("df_e"))
    leak = F.when(known > 0, pmi / known).otherwise(0.0) * F.col("weight")
    telling = work.save(both.select("e", "t", leak.alias("leak")).where(F.col("leak") >= generalise), "telling")

    # Where the telling terms stand, in the documents that hold the entity.
    named = pairs.join(telling.hint("merge"), ["e", "t"]).groupBy("id", "h", "t").agg(F.max("leak").alias("leak"))
    named = work.save(named, "named")
    homes = work.save(named.select("id", "h").distinct(), "homes")
    inside = held.alias("d").join(homes.alias("m").hint("merge"), key("d", "m"), "left_semi").dropDuplicates(["id", "h"])
    cut = F.arrays_zip(F.split("text", TERM, -1).alias("gap"), F.regexp_extract_all("text", F.lit(TERM), F.lit(0)).alias("word"))
    at = inside.select("id", "h", F.posexplode_outer(cut).alias("pos", "x")).select("id", "h", "pos", F.col("x.gap").alias("gap"), F.col("x.word").alias("word"))
    run = Window.partitionBy("id", "h").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    at = at.withColumn("end", F.sum(F.length("gap") + F.coalesce(F.length("word"), F.lit(0))).over(run).cast("int")).where("word is not null")
    at = at.select("id", "h", F.lower("word").alias("t"), (F.col("end") - F.length("word")).alias("start"), "end")
    met = at.alias("a").join(named.alias("b").hint("merge"), key("a", "b") & (F.col("a.t") == F.col("b.t")))
    kind = F.when(F.col("leak") >= remove, "").when(F.col("a.t").rlike(r"^\p{N}+$"), "[NUMBER]").otherwise("[TERM]")
    added = met.groupBy("a.id", "a.h").agg(F.array_sort(F.collect_list(F.struct("start", "end", F.lit("term").alias("kind"), "leak", kind.alias("tag")))).alias("added"))
    added = work.save(added, "added")
    work.drop("entities", "few", "joint", "telling", "named", "homes")

    none = F.array().cast("array<struct<start:int,end:int,kind:string,leak:double,tag:string>>")
    out = found.alias("f").join(added.alias("a").hint("merge"), key("f", "a"), "left").select("f.id", "f.h", "f.base", F.coalesce("a.added", none).alias("added"), "f.text")
    # A base span is replaced whole, so terms inside it are not.
    apart = lambda s: ~F.exists("base", lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"]))
    out = out.withColumn("added", F.filter("added", apart))
    tags = F.concat(
        F.transform("base", lambda s: F.struct(s["start"], s["end"], F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("tag"))),
        F.transform("added", lambda s: F.struct(s["start"], s["end"], s["tag"])),
    )
    clean = F.when(F.size("base") > 0, sanitised(F.col("text"), tags))
    return out.select(F.col("id").alias(id_col), F.col("h").alias("text_hash"), "base", "added", clean.alias("clean_text"))


def clean_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(id, ``clean_text``) of all documents: base spans become ``[EMAIL]`` and the like, telling terms
    ``[TERM]`` or ``[NUMBER]``, or nothing. Null texts become empty."""
    changed = sanitise(docs, id_col, text_col, **how).where("clean_text is not null").dropDuplicates([id_col, "text_hash"])
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("d")
    met = d.join(changed.alias("s").hint("merge"), F.col("d.id").eqNullSafe(F.col(f"s.{id_col}")) & (F.xxhash64("d.text") == F.col("s.text_hash")), "left")
    return met.select(F.col("d.id").alias(id_col), F.coalesce("s.clean_text", "d.text").alias("clean_text"))


def op4_pmi_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and telling spans of all ``documents``, and the digest of the text once they are replaced (null where
    nothing is); edge cases as in ``sanitise``."""
    r = sanitise(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    every = F.filter(F.array(written(F.col("base")), written(F.col("added"))), lambda x: x != "")
    return r.select(
        "doc_id", *[count(k) for k in KINDS], F.size("base").cast("long").alias("n_base"), F.sha2(written(F.col("base")), 256).alias("base_sha256"), F.array_join(every, ",").alias("spans"), F.size("added").cast("long").alias("n_term"),
        F.sha2("clean_text", 256).alias("clean_sha256"),
    )
