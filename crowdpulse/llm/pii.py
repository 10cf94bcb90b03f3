r"""Personal data in texts: patterns, and terms that give a protected entity away.

Base: e-mail and IP addresses, card and phone numbers by pattern, leftmost and without overlap per
kind; matches that fail their test (parts up to 255, 14 to 19 digits with Luhn's sum, 10 to 15
digits) are dropped.

Terms: each found value is a protected entity e. The words t of its documents are counted over the
corpus, wherever they stand outside e-mail addresses: n(t, e) documents with t and e, n(t) documents
with t, n(e) documents with e, N documents. How strongly t reveals e is its share of e's information,
    PMI(t; e) / IC(e) = log(n(t, e) N / (n(t) n(e))) / log(N / n(e)),
1 where t occurs with e only. A term that reaches ``generalise`` is replaced by its class wherever it
stands in a document with e; from ``remove`` on it is removed. In a corpus of N documents nearly every
rare word meets some entity once, so a pair needs evidence beyond that: ``support`` different texts with
both, or t is a name in a text of e, written with a capital in the middle of a sentence there and never
without. Copies of a text are one text.

Everything is DataFrame expressions. Positions are code points, from the lengths of what lies between
the matches. Patterns use possessive repeats, so no text needs a deep or quadratic search: a match
starts where no character of its first run stands before it, or right where the last match ended,
which is the same as trying every place. Null texts are empty. Repeated rows are kept as rows.
Counts are merged before each shuffle. As n(t, e) is n(e) at most, a term of e has n(t) up to
n(e)^generalise N^(1 - generalise): other words are left out before they are paired with entities.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm.tables import packed, staged, text_of, unpacked

KINDS = ("email", "ip", "card", "phone", "term")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this holds no match.
SIGNS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: A word that can be a term: letters, marks within.
WORD = r"\p{L}(?:[\p{L}\p{M}]|['’-](?=\p{L})){2,}+"
#: Least different texts with a term and its entity, unless it is a name; least disclosure to generalise and to remove.
SUPPORT, GENERALISE, REMOVE = 3, 0.8, 0.95
#: A word with a capital that begins no sentence, and one without a capital.
CAPITAL = r"(?<=[^.!?:\s]\x20)(?=\p{Lu})" + WORD
PLAIN = r"(?<![\p{L}\p{M}'’-])(?=\p{Ll})" + WORD
FOUND = "array<struct<start:int,end:int,value:string>>"


def located(text: Column, pattern: Column | str) -> Column:
    """Every match with its place.

    Places are running sums over what lies between the matches. They are taken in blocks of about
    sqrt(n) matches, then over the blocks, as an array that grows by one costs a copy each time.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    gaps, values = F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    pairs = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(values)),
        values,
        lambda g, v: F.struct(v.alias("value"), F.length(g).alias("skip")),
    )
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(FOUND).alias("all"))

    def step(a: Column, m: Column) -> Column:
        start = a["at"] + m["skip"]
        end = start + F.length(m["value"])
        one = F.struct(start.alias("start"), end.alias("end"), m["value"])
        return F.struct(end.alias("at"), F.concat(a["all"], F.array(one)).alias("all"))

    def block(p: Column) -> Column:
        size = F.greatest(F.ceil(F.sqrt(F.size(p))).cast("int"), F.lit(1))
        first = F.sequence(F.lit(1), F.greatest(F.size(p), F.lit(1)), size)
        return F.transform(first, lambda k: F.aggregate(F.slice(p, k, size), zero, step))

    def placed(blocks: Column) -> Column:
        ends = F.aggregate(
            blocks, F.array(F.lit(0)), lambda a, b: F.concat(a, F.array(F.element_at(a, -1) + b["at"]))
        )
        moved = F.zip_with(
            blocks,
            F.slice(ends, F.lit(1), F.size(blocks)),
            lambda b, at: F.transform(
                b["all"], lambda m: F.struct((m["start"] + at).alias("start"), (m["end"] + at).alias("end"), m["value"])
            ),
        )
        return F.flatten(moved)

    # An array of one binds what several lambdas read, so that it is worked out once.
    blocks = F.transform(F.array(pairs), block)
    return F.transform(blocks, placed)[0]


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits has a sum of Luhn that 10 divides."""

    def add(total: Column, k: Column) -> Column:
        d = F.substring(number, (F.length(number) - k).cast("int"), F.lit(1)).cast("int")
        twice = F.when(2 * d > 9, 2 * d - 9).otherwise(2 * d)
        return total + F.when(k % 2 == 1, twice).otherwise(d)

    places = F.sequence(F.lit(0), F.length(number) - 1)
    return F.aggregate(places, F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.concat(F.lit("0"), F.substring(p, 1, 3)).cast("int") <= 255))
    if kind == "card":
        number = digits(value)
        return F.when(F.length(number).between(14, 19), luhn(number)).otherwise(False)
    if kind == "phone":
        return F.length(digits(value)).between(10, 15)
    return F.lit(True)


def entity(kind: str, value: Column) -> Column:
    """One value for all ways of writing an entity."""
    plain = F.lower(value) if kind == "email" else value if kind == "ip" else digits(value)
    return F.xxhash64(F.lit(kind), plain)


def detected(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, found: the base matches of all kinds with kind (number) and entity; words beside them."""
    none = F.array().cast(FOUND)
    rows = docs.select("doc_id", text_of().alias("text"))
    for kind, pattern in PATTERNS.items():
        sign = SIGNS[kind]
        possible = F.col("text").contains(sign) if sign else F.col("text").rlike("[0-9][ -]?[0-9]")
        rows = rows.withColumn(kind, F.when(possible, located(F.col("text"), pattern)).otherwise(none))

    def kept(kind: str) -> Column:
        good = F.filter(kind, lambda m: valid(kind, m["value"]))
        return F.transform(
            good,
            lambda m: F.struct(
                m["start"].alias("start"),
                F.lit(KINDS.index(kind)).alias("kind"),
                m["end"].alias("end"),
                entity(kind, m["value"]).alias("entity"),
            ),
        )

    found = F.array_sort(F.concat(*[kept(k) for k in PATTERNS]))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), found.alias("found"), "text")
    # Of the kinds only e-mail addresses have letters.
    plain = F.regexp_replace("text", PATTERNS["email"], " ")
    none = F.array().cast("array<string>")

    def where_found(words: Column) -> Column:
        return F.when(F.size("found") > 0, words).otherwise(none)

    capital, small = (F.regexp_extract_all(plain, F.lit(p), F.lit(0)) for p in (CAPITAL, PLAIN))
    names = F.array_except(F.transform(capital, F.lower), small)
    words = F.array_distinct(words_of(plain))
    return rows.select("doc_id", "text_hash", "found", where_found(words).alias("words"), where_found(names).alias("names"))


def words_of(text: Column) -> Column:
    """The words of a text that can be terms, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def risky(docs: DataFrame, base: DataFrame, support: int = SUPPORT, least: float = GENERALISE) -> DataFrame:
    """(entity, term, disclosure) of the terms that give an entity away."""
    total = docs.count()
    own = F.array_distinct(F.transform("found", lambda m: m["entity"]))
    texts = base.where(F.size("found") > 0).groupBy("text_hash")
    texts = staged(texts.agg(F.count("*").alias("n"), F.first(own).alias("entities"), F.first("words").alias("words"), F.first("names").alias("names")), "texts")
    single = texts.select("text_hash", "n", F.explode("entities").alias("entity"))
    entities = single.groupBy("entity").agg(F.sum("n").alias("n_entity"))
    most = F.pow("n_entity", F.lit(least)) * F.pow(F.lit(float(total)), F.lit(1 - least)) * (1 + 1e-9)
    entities = entities.where(F.col("n_entity") < total).withColumn("most", most)
    single = single.join(entities, "entity").groupBy("text_hash", "n")
    held = single.agg(F.max("most").alias("most"), F.collect_list(F.struct("entity", "n_entity", "most")).alias("own"))
    # Every word of every document is counted; hashes stand for words up to the join.
    words = F.array_distinct(F.transform(words_of(text_of()), lambda w: F.xxhash64(w)))
    spread = docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n_term"))
    terms = texts.select("text_hash", "names", F.explode("words").alias("term")).withColumn("word", F.xxhash64("term"))
    terms = terms.withColumn("name", F.array_contains("names", F.col("term"))).drop("names")
    rare = terms.join(spread, "word").join(held, "text_hash").where(F.col("n_term") <= F.col("most"))
    near = F.filter("own", lambda e: e["most"] >= F.col("n_term"))
    pairs = rare.select("term", "n_term", "n", "name", F.explode(near).alias("e"))
    pairs = pairs.select("term", "n_term", "n", "name", "e.entity", "e.n_entity")
    joint = pairs.groupBy("entity", "term", "n_entity", "n_term").agg(
        F.sum("n").alias("joint"), F.count("*").alias("texts"), F.max("name").alias("name")
    )
    information = F.log(F.lit(float(total)) / F.col("n_entity"))
    pmi = F.log(F.col("joint") * float(total) / (F.col("n_term") * F.col("n_entity")))
    known = joint.where((F.col("texts") >= support) | F.col("name")).withColumn("disclosure", pmi / information)
    return known.where(F.col("disclosure") >= least).select("entity", "term", "disclosure")


def term_spans(docs: DataFrame, base: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, text_hash, terms): places of the revealing terms of each document's own entities."""
    own = base.select("doc_id", "text_hash", F.explode(F.array_distinct(F.transform("found", lambda m: m["entity"]))).alias("entity"))
    listed = own.join(terms, "entity").groupBy("doc_id", "text_hash", "term").agg(F.max("disclosure").alias("disclosure"))
    listed = listed.groupBy("doc_id", "text_hash").agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("by"))
    listed = staged(listed.toDF("_id", "_hash", "by"), "revealing")
    keyed = docs.select("doc_id", F.xxhash64(text_of()).alias("text_hash"), text_of().alias("text"))
    held = keyed.join(listed, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
    words = F.filter(located(F.col("text"), WORD), lambda m: F.map_contains_key("by", F.lower(m["value"])))
    places = F.transform(
        words,
        lambda m: F.struct(
            m["start"].alias("start"),
            F.lit(KINDS.index("term")).alias("kind"),
            m["end"].alias("end"),
            F.element_at("by", F.lower(m["value"])).alias("disclosure"),
        ),
    )
    return held.select("doc_id", "text_hash", places.alias("terms")).dropDuplicates(["doc_id", "text_hash"])


def protected(docs: DataFrame, support: int = SUPPORT, generalise: float = GENERALISE) -> DataFrame:
    """doc_id, text_hash, spans: all spans of every document as (start, kind, end, disclosure), in order."""
    base = staged(detected(docs), "found")
    places = term_spans(docs, base, risky(docs, base, support, generalise)).toDF("_id", "_hash", "terms")
    joined = base.join(places, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    shape = "array<struct<start:int,kind:int,end:int,disclosure:double>>"
    own = F.transform(
        "found",
        lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end"), F.lit(1.0).alias("disclosure")),
    )
    # A term within a base span is part of it.
    free = F.filter(
        F.coalesce("terms", F.array().cast(shape)),
        lambda t: ~F.exists("found", lambda m: (m["start"] < t["end"]) & (t["start"] < m["end"])),
    )
    return joined.select("doc_id", "text_hash", F.array_sort(F.concat(own.cast(shape), free.cast(shape))).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ","
    )


def digest(found: DataFrame) -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"] < KINDS.index("term"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", *[count(k) for k in PATTERNS], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


def sanitised(docs: DataFrame, remove: float = REMOVE, **options) -> DataFrame:
    """``docs`` with text sanitised: base spans by their kind in brackets, terms by [NAME] or [WORD], or gone."""
    found = protected(docs, **options).where("size(spans) > 0").dropDuplicates(["doc_id", "text_hash"])
    found = found.toDF("_id", "_hash", "_spans")
    rows = packed(docs, "doc_id", "text", F.xxhash64(text_of()).alias("_of"))
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_of") == F.col("_hash")), "left")
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in PATTERNS])
    own = lambda a, b: F.substring(F.col("text"), a + 1, b - a)

    def step(a: Column, s: Column) -> Column:
        word = own(s["start"], s["end"])
        name = F.when(F.initcap(F.substring(word, 1, 1)) == F.substring(word, 1, 1), "[NAME]").otherwise("[WORD]")
        term = F.when(s["disclosure"] >= remove, "").otherwise(name)
        mark = F.when(s["kind"] < len(PATTERNS), F.element_at(marks, F.least(s["kind"], F.lit(len(PATTERNS) - 1)) + 1)).otherwise(term)
        after = s["start"] >= a["at"]  # what overlaps a span before it is covered by it
        piece = F.concat(a["text"], own(a["at"], s["start"]), mark)
        return F.struct(
            F.greatest(a["at"], s["end"]).alias("at"), F.when(after, piece).otherwise(a["text"]).alias("text")
        )

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))
    whole = F.aggregate("_spans", zero, step, lambda a: F.concat(a["text"], own(a["at"], F.length("text"))))
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(whole)
    return joined.select(*unpacked(docs, text=text))
