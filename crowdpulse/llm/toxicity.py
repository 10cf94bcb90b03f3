"""Toxicity scores: boosted trees over dense features, calibrated by isotonic regression.

Features per text: rates of capitals, marks, symbols and repeats; density of words from a lexicon
(fixed words, and words and word beginnings learned from labels), the strongest of them, how close
second-person words stand to them, and the rate of obfuscated words (digits or symbols for letters,
letters apart). Words are compared in a plain form: lower case, look-alike signs as letters, other
signs dropped, doubled letters once.

The labelled rows whose crc32(doc_id) mod 5 is not 0 are split by that remainder: 1 and 2 teach the
lexicon, 3 the trees, 4 the calibration. At most about ``sample`` of them are used, chosen by a hash
of the id; every document is scored over its whole text. lang, source, doc_id and labels are no
inputs. A null text counts as empty, empty texts have a score. Several labels of one document count
as toxic if any does. Where labels show one class only, every score is that class's share.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from crowdpulse.llm import features as X
from crowdpulse.llm import words as W
from crowdpulse.llm.tables import fold, staged, text_of

#: Labelled rows to learn from, entries of the learned lexicon, trees, their depth.
SAMPLE, ENTRIES, TREES, DEPTH, SEED = 20_000, 4000, 30, 4, 11
#: Least documents of a learned entry, least log odds, least standard errors above the rest.
SUPPORT, LOG_ODDS, ERRORS = 3, 1.5, 3.0
#: Beginnings of words, in bytes; 0: the whole word.
BEGINNINGS = (0, 5, 6, 7)
#: Words around a hit that are searched for the second person.
NEAR = 5
INSULTS = (
    "idiot idiots stupid moron morons loser losers pathetic worthless disgusting trash scum clown clowns dumb "
    "fool ugly freak hate kill imbecile garbage vermin filthy retard bastard bitch asshole shit fuck fucking "
    "dummkopf arschloch idioten abschaum wertlos imbécile connard salaud ordure stupide débile inútil estúpido "
    "imbécil basura asqueroso payaso"
).split()
SECOND = "you your yours yourself ya u du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre tú ti usted ustedes tus".split()
NAMES = (
    "fixed_hits", "learned_hits", "hit_density", "learned_density", "learned_weight", "learned_mean", "distinct_hits",
    "second_density", "near_second", "disguised_words", "disguised_hits", "spread_words",
)
LIKE = np.arange(256, dtype=np.uint8)
LIKE[65:91] += 32
for sign, letter in zip(b"0134578@$!", b"oieastbasi"):
    LIKE[sign] = letter
KEPT = np.zeros(256, bool)
KEPT[97:123] = True
KEPT[0x80:] = True
SIGN = np.zeros(256, bool)
SIGN[list(b"0134578@$!*#._-")] = True


class Plain(NamedTuple):
    words: W.Words
    hashes: list[np.ndarray]  # one per beginning
    disguised: np.ndarray  # a sign between letters
    letter: np.ndarray  # a single letter


def plain(part: W.Texts) -> Plain:
    w = W.words(part)
    data = LIKE[part.bytes]
    # Capital letters of two bytes (À to Þ) have small ones 0x20 above.
    upper = np.zeros(len(data), bool)
    upper[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    data = np.where(upper, data + 0x20, data).astype(np.uint8)
    keep = KEPT[data].copy()
    # An exclamation mark that ends a word is a mark.
    raw = part.bytes
    tail = w.end - 1
    for _ in range(3):
        marks = (raw[tail] == ord("!")) & (tail > w.start)
        keep[tail[marks]] = False
        tail = np.where(marks, tail - 1, tail)
    keep[1:] &= (data[1:] != data[:-1]) | (data[1:] >= 0x80)
    left = np.concatenate([[0], np.cumsum(keep)])
    start, end = left[w.start], left[w.end]
    short = data[keep]
    empty = end == start
    hashes = []
    for size in BEGINNINGS:
        stop = np.minimum(end, start + size) if size else end
        h = np.zeros(len(start), np.uint64)
        if (~empty).any():
            h[~empty] = W.mix(W.hashes(short, start[~empty], stop[~empty]) + np.uint64(size))
        if size:
            h[end - start < size] = 0
        hashes.append(h)
    letters = X.counts(X.LETTER[raw] | X.OTHER[raw], w.start, w.end)
    inner = X.counts(SIGN[raw], np.minimum(w.start + 1, tail), tail)
    return Plain(w, hashes, (inner > 0) & (letters > 1), (letters == 1) & (w.end - w.start <= 2))


def hashes_of(words: list[str]) -> np.ndarray:
    part = next(W.texts(pa.array([" ".join(words)])))
    return np.unique(plain(part).hashes[0])


class Lexicon(NamedTuple):
    fixed: np.ndarray
    second: np.ndarray
    entries: np.ndarray  # sorted hashes
    weights: np.ndarray


def features(column: pa.Array, lexicon: Lexicon) -> np.ndarray:
    out = [np.column_stack([X.of_texts(part), of_texts(part, lexicon)]) for part in W.texts(column)]
    return np.concatenate(out) if out else np.zeros((0, len(X.NAMES) + len(NAMES)))


def of_texts(part: W.Texts, lexicon: Lexicon) -> np.ndarray:
    n = len(part.starts)
    p = plain(part)
    owner = p.words.text
    words = np.maximum(np.bincount(owner, minlength=n), 1)
    fixed = np.isin(p.hashes[0], lexicon.fixed)
    weight = np.zeros(len(owner))
    if len(lexicon.entries):
        for h in p.hashes:
            at = np.minimum(np.searchsorted(lexicon.entries, h), len(lexicon.entries) - 1)
            weight = np.maximum(weight, np.where(lexicon.entries[at] == h, lexicon.weights[at], 0))
    learned = weight > 0
    hit = fixed | learned
    second = np.isin(p.hashes[0], lexicon.second)

    def count(flags: np.ndarray) -> np.ndarray:
        return np.bincount(owner[flags], minlength=n).astype(float)

    # A hit is near the second person if one of the words around it, in the same text, is.
    near = np.zeros(len(owner), bool)
    for k in range(1, NEAR + 1):
        same = owner[k:] == owner[:-k]
        near[k:] |= second[:-k] & same
        near[:-k] |= second[k:] & same
    near &= hit
    strongest = np.zeros(n)
    np.maximum.at(strongest, owner, weight)
    total = np.bincount(owner, weight, minlength=n)
    again, _ = X.repeats(owner[hit], p.hashes[0][hit], n)
    hits = count(hit)
    return np.column_stack(
        [
            count(fixed),
            count(learned),
            hits / words,
            count(learned) / words,
            strongest,
            total / words,
            hits - again,
            count(second) / words,
            count(near),
            count(p.disguised) / words,
            count(p.disguised & hit),
            count(p.letter) / words,
        ]
    )


def tokens(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(owner, hash) of the distinct words and beginnings of each text."""
    for part in W.texts(column):
        p = plain(part)
        h = np.concatenate(p.hashes)
        owner = np.tile(p.words.text, len(p.hashes))[h != 0]
        pairs = np.unique(np.rec.fromarrays([owner, h[h != 0]], names="owner,hash"))
        yield pairs["owner"] + part.first, pairs["hash"]


def learned(rows: DataFrame, entries: int = ENTRIES) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and log odds of the words and beginnings that set toxic texts apart; rows: text, toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
            for owner, h in tokens(batch.column("text")):
                keys, at = np.unique(h, return_inverse=True)
                yes = np.bincount(at, toxic[owner], minlength=len(keys)).astype(np.int64)
                everyone = np.bincount(at, minlength=len(keys)).astype(np.int64)
                columns = [pa.array(keys.view(np.int64)), pa.array(yes), pa.array(everyone - yes)]
                yield pa.RecordBatch.from_arrays(columns, ["token", "yes", "no"])

    sizes = rows.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    yes, no = (sizes[0] or 0) + 1.0, (sizes[1] or 0) + 1.0
    counts = rows.select("text", "toxic").mapInArrow(run, "token long, yes long, no long").groupBy("token")
    counts = counts.agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).where(F.col("yes") >= SUPPORT)
    odds = F.log((F.col("yes") + 0.5) / yes) - F.log((F.col("no") + 0.5) / no)
    spread = F.sqrt(1 / (F.col("yes") + 0.5) + 1 / (F.col("no") + 0.5))
    best = counts.select("token", odds.alias("odds"), (odds / spread).alias("errors"))
    best = best.where((F.col("odds") > LOG_ODDS) & (F.col("errors") > ERRORS))
    found = best.orderBy(F.col("errors").desc(), "token").limit(entries).collect()
    hashes = np.array([r.token for r in found], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.array([r.odds for r in found])[order]


class Model(NamedTuple):
    lexicon: Lexicon
    trees: object | None
    calibration: object | None
    share: float


def _featured(text: Column, lexicon: Lexicon) -> Column:
    @arrow_udf("array<double>")
    def run(column: pa.Array) -> pa.Array:
        x = features(column, lexicon)
        return pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))

    return array_to_vector(run(text))


def _raw(trees, rows: DataFrame) -> DataFrame:
    return trees.transform(rows).withColumn("raw", vector_to_array("probability")[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from a hash sample of about ``sample`` labelled rows outside the held-out fold."""
    marks = labels.where("doc_id is not null and toxic is not null").where(fold() > 0)
    marks = marks.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    known = marks.count()
    kept = F.pmod(F.xxhash64(F.lit(SEED), F.col("doc_id")), F.lit(1_000_000)) < 1e6 * sample / max(known, 1)
    own = docs.where("doc_id is not null").where(fold() > 0).where(kept).select("doc_id", text_of().alias("text"))
    marks = marks.where(kept).withColumnRenamed("doc_id", "_id")
    rows = own.join(marks, own["doc_id"] == marks["_id"]).select(fold().alias("fold"), "text", "toxic")
    rows = staged(rows, "labelled")
    classes = {(r.part, r.toxic): r["count"] for r in rows.groupBy(F.greatest("fold", F.lit(2)).alias("part"), "toxic").count().collect()}
    total = sum(classes.values())
    share = sum(n for (_, t), n in classes.items() if t) / total if total else 0.5
    fixed, second = hashes_of(INSULTS), hashes_of(SECOND)
    none = np.zeros(0, np.uint64), np.zeros(0)
    if len({t for _, t in classes}) < 2:
        return Model(Lexicon(fixed, second, *none), None, None, share)
    both = lambda part: len({t for p, t in classes if p == part}) == 2
    lexicon = Lexicon(fixed, second, *(learned(rows.where("fold in (1, 2)")) if both(2) else none))
    x = staged(rows.select("fold", "toxic", _featured(F.col("text"), lexicon).alias("features")).coalesce(8), "examples")
    # With too few examples in a fold, all of them teach.
    teach = x.where("fold = 3") if both(3) and both(4) else x
    gbt = GBTClassifier(
        labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, subsamplingRate=0.8, seed=SEED, minInstancesPerNode=3
    )
    trees = gbt.fit(teach.coalesce(6))
    calibrate = x.where("fold = 4") if both(3) and both(4) else x
    isotonic = IsotonicRegression(featuresCol="raw", labelCol="toxic", predictionCol="calibrated")
    return Model(lexicon, trees, isotonic.fit(_raw(trees, calibrate).select("raw", "toxic")), share)


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, score, predicted."""
    model = fit(docs, labels, sample)
    if model.trees is None:
        out = docs.select("doc_id", F.lit(float(model.share)).alias("score"))
    else:
        rows = docs.select("doc_id", _featured(text_of(), model.lexicon).alias("features"))
        found = model.calibration.transform(_raw(model.trees, rows))
        # A trace of the trees' own score orders the documents of one calibration step.
        out = found.select("doc_id", (0.99 * F.col("calibrated") + 0.01 * F.col("raw")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
