"""Toxicity by maximum-scoring segments of token log-odds.

Fit: a bounded sample of labelled documents (``MAX_DOCS`` per class, by hash
of the id) gives, for each word and each word beginning of 4 to 8 letters, the
number of distinct contexts (neighbouring words) it has in toxic and in clean
documents. Contexts rather than occurrences, so a text that was copied a
thousand times speaks once. A unit's score is its log-odds between the classes
with an informative Dirichlet prior; only units clearly likelier in toxic documents are kept,
at most ``MAX_UNITS``. Every other word has the log-odds of the remaining mass.

Score: a linear scan (Ruzzo and Tompa) finds all maximal scoring segments of a
document's token scores. Segment scores are compared by extreme-value
statistics: a segment of score S in n words has ``lambda * S - ln(K * n)``,
with K from the clean training documents and lambda 1, as scores are log-odds; it is significant where
that is positive. The greatest value and the best sum statistic of several segments make
the document's score by a monotone curve fitted on the training documents.

Defined cases: null and empty texts, and texts without words, have no segment
and the score of a document with greatest segment 0 and n = 1; labels that are null are not used, a doc_id
with several labels counts as toxic if one says so; a null doc_id is scored
but never learned from (held_out false); repeated rows each get a row; an empty table gives an
empty table; without labels of both classes every score is 0. Texts are scored
whole. Columns other than doc_id and text pass through ``score_toxicity``.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import BLOCK_CHARS, RecentCache, held, map_blocks, read_table, release, ship, text_blocks

#: Labelled documents to learn from, of each class.
MAX_DOCS = 5000
#: Units in the model.
MAX_UNITS = 50_000
#: Least z-score, log-odds and number of contexts of a unit.
MIN_Z, MIN_ODDS, MIN_CONTEXTS = 3.0, 1.5, 4
#: Weight of the Dirichlet prior, as a share of the sample's contexts.
PRIOR = 0.05
#: Lengths of word beginnings that are units.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Characters whose contexts a Python worker holds at a time.
CONTEXT_CHARS = 400_000
#: Words that a Python worker remembers (twice as many at most).
CACHE_ENTRIES = 100_000
THRESHOLD = 0.7

_WORD = re.compile(r"[^\W\d_]+")
_PASSAGE = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("score", T.DoubleType())]))


@dataclass
class ToxicityModel:
    units: dict[str, float] = field(default_factory=dict)  # word, or beginning with * after it
    rest: float = 0.0
    lam: float = 1.0
    log_k: float = 0.0
    curve: tuple[tuple[float, ...], tuple[float, ...]] | None = None  # statistics and their shares of toxic documents

    def probability(self, statistic: float) -> float:
        if self.curve is None:
            return 0.0
        # The curve is flat in places; a trace of the statistic itself keeps the order.
        return float(0.999 * np.interp(statistic, *self.curve) + 0.001 / (1 + math.exp(-max(min(statistic, 30.0), -30.0))))

    def word_score(self, word: str) -> float:
        units = self.units
        best = units.get(word)
        if best is not None:
            return best
        for n in reversed(BEGINNINGS):
            if len(word) > n and (s := units.get(word[:n] + "*")) is not None:
                return s
        return self.rest


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in linear time."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[list] = []  # start, end, sum before it, sum at its end
    back: list[int] = []    # nearest earlier segment with a smaller sum before it
    for i in np.flatnonzero(scores > 0).tolist():
        seg = [i, i + 1, total[i], total[i + 1]]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= seg[2]:
                j = back[j]
            if j < 0 or found[j][3] >= seg[3]:
                found.append(seg)
                back.append(j)
                break
            seg = [found[j][0], seg[1], found[j][2], seg[3]]
            del found[j:], back[j:]
    return [(a, b, float(r - l)) for a, b, l, r in found]


def statistic(scores: list[float], n: int, lam: float, log_k: float) -> float:
    """The evidence of the segments' scores in a document of n words.

    The sum T of the r greatest normalised scores has, for chance segments, a probability near
    exp(-T) T^(r-1) / (r! (r-1)!); the value is the greatest of its negative logarithms, or the
    greatest normalised score where none is positive.
    """
    chance = math.log(max(n, 1)) + log_k
    values = sorted((lam * s - chance for s in scores), reverse=True)
    if not values:
        return -chance
    best, total, factorials = 0.0, 0.0, 0.0
    for r, v in enumerate(values, 1):
        if r > 1 and v <= 0:
            break
        total += v
        factorials += math.log(r) + (math.log(r - 1) if r > 1 else 0.0)
        best = max(best, total - (r - 1) * math.log(max(total, 1.0)) + factorials)
    return max(values[0], best) if values[0] > 0 else values[0]


# ---------------------------------------------------------------- fit

def fit_toxicity(docs: DataFrame, labels: DataFrame, learn: F.Column | None = None,
                 max_docs: int = MAX_DOCS) -> ToxicityModel:
    """``learn``: condition on doc_id of the labelled rows to learn from (all, if None)."""
    spark = docs.sparkSession
    ship(spark)
    known = labels.select("doc_id", "toxic").where("doc_id is not null and toxic in (0, 1)")
    if learn is not None:
        known = known.where(learn)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = [r for y in (0, 1) for r in known.where(F.col("toxic") == y)
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs).collect()]
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len({r["toxic"] for r in sample}) < 2:
        return ToxicityModel()
    picked = spark.createDataFrame([(r["doc_id"], int(r["toxic"])) for r in sample], "doc_id long, toxic int")
    # The sample has 2 * max_docs ids at most; its texts are few beside the corpus.
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
             .join(F.broadcast(picked), "doc_id").where("text is not null").select("text", "toxic").distinct())

    def contexts(batches):
        release()
        for batch, lines in text_blocks(batches, chars=CONTEXT_CHARS):
            seen = set()
            for t, y in zip(lines, batch.column(1).to_pylist(), strict=True):
                w = _WORD.findall(t.lower())
                seen.update(zip(["", *w[:-1]], w, [*w[1:], ""], [y] * len(w)))
            rows = list(seen)
            yield pa.RecordBatch.from_arrays([
                pa.array([r[1] for r in rows], pa.string()), pa.array([f"{r[0]} {r[2]}" for r in rows], pa.string()),
                pa.array([r[3] for r in rows], pa.int32())], names=["word", "context", "toxic"])

    words = (texts.mapInArrow(contexts, "word string, context string, toxic int")
             .groupBy("word", F.xxhash64("context").alias("context"))
             .agg(F.max("toxic").alias("t"), F.max(1 - F.col("toxic")).alias("c"))
             .groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c")))
    words = words.persist()
    total = words.agg(F.sum("t"), F.sum("c")).first()
    n_t, n_c = float(total[0] or 0), float(total[1] or 0)
    weight = PRIOR * (n_t + n_c)
    prior = PRIOR * (F.col("t") + F.col("c"))
    t, c = F.col("t") + prior, F.col("c") + prior
    odds = F.log(t / (n_t + weight - t)) - F.log(c / (n_c + weight - c))
    clear = (odds / F.sqrt(1 / t + 1 / c) >= MIN_Z) & (odds >= MIN_ODDS) & (F.col("t") + F.col("c") >= MIN_CONTEXTS)
    clear = F.coalesce(clear, F.lit(False))
    # A beginning stands for the words that have no score of their own.
    beginnings = F.array(*[
        F.when(F.length("word") > n, F.concat(F.substring("word", 1, n), F.lit("*"))) for n in BEGINNINGS])
    units = (words.where(~clear).select(F.explode(beginnings).alias("word"), "t", "c").where("word is not null")
             .groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
             .unionByName(words.select("word", "t", "c")).where(clear))
    kept = (units.select("word", odds.alias("odds")).orderBy(F.col("odds").desc(), "word")
            .limit(MAX_UNITS).collect())
    words.unpersist()
    model = ToxicityModel({r["word"]: r["odds"] for r in kept})
    _calibrate(model, texts, sizes)
    return model


def _calibrate(model: ToxicityModel, texts: DataFrame, sizes: dict[int, int]) -> None:
    """lambda, K and the logistic curve, from what the sample's documents give (a few numbers each)."""
    def scan(batches):
        for batch, lines in text_blocks(batches):
            rows = [_segments_of(model, _WORD.findall(t.lower())) for t in lines]
            yield pa.RecordBatch.from_arrays([
                batch.column(1).cast(pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
                pa.array([sum(r[2]) for r in rows], pa.float64()),
                pa.array([[s for _, _, s in r[0]] for r in rows], pa.list_(pa.float64())),
                pa.array([r[2] for r in rows], pa.list_(pa.float64()))],
                names=["toxic", "n", "sum", "segments", "positive"])

    rows = texts.mapInArrow(scan, "toxic int, n long, sum double, segments array<double>, positive array<double>").collect()
    clean = [r for r in rows if r["toxic"] == 0]
    positive = np.array([s for r in clean for s in r["positive"]])
    plain = max(sum(r["n"] for r in clean) - len(positive), 1)
    # With log-odds, the mean of exp(score) over the tokens of clean documents is 1 (lambda is 1);
    # the score of the words without a unit is set so that it is.
    n = plain + len(positive)
    model.rest = math.log(max(n - np.exp(positive).sum(), 0.5 * n) / plain)
    rows = texts.mapInArrow(scan, "toxic int, n long, sum double, segments array<double>, positive array<double>").collect()
    # K: chance segments of score s0 or more number K * n * exp(-lambda * s0), s0 their median in clean documents.
    chance = [s for r in rows if r["toxic"] == 0 for s in r["segments"]] or [0.0]
    s0 = float(np.median(chance))
    model.log_k = math.log(sum(s >= s0 for s in chance)) + model.lam * s0 - math.log(n)
    x = np.array([statistic(r["segments"], r["n"], model.lam, model.log_k) for r in rows])
    y = np.array([r["toxic"] for r in rows], float)
    share = np.where(y == 1, sizes.get(1, 1) / max(y.sum(), 1), sizes.get(0, 1) / max((1 - y).sum(), 1))
    order = np.lexsort((y, x))
    blocks: list[list[float]] = []  # pool adjacent violators: weight, weight of toxic, least and greatest statistic
    for k in order.tolist():
        blocks.append([share[k], share[k] * y[k], x[k], x[k]])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            (v, t, _, most), (w, u, least, _) = blocks.pop(), blocks[-1]
            blocks[-1] = [v + w, t + u, least, most]
    model.curve = (tuple(float(e) for b in blocks for e in b[2:]), tuple(b[1] / b[0] for b in blocks for _ in b[2:]))


def _segments_of(model: ToxicityModel, words: list[str], cache: dict | None = None):
    get = (cache or {}).get
    scores = np.array([s if (s := get(w)) is not None else model.word_score(w) for w in words])
    return segments(scores) if len(words) else [], len(words), scores[scores > 0].tolist() if len(words) else []


# ---------------------------------------------------------------- score

def score_toxicity(docs: DataFrame, model: ToxicityModel, chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with score, predicted (1 from ``THRESHOLD``) and passages (start, end in
    characters of the text and score) of every significant segment. A task looks at texts of about ``chars``
    characters at a time (or one longer text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = "toxicity", hash(tuple(model.units.items())), model.curve
    names = ("score", "predicted", "passages")
    docs = docs.drop(*names).withColumn("text", F.col("text").cast("string"))
    schema = T.StructType(docs.schema.fields + [
        T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
        T.StructField("passages", _PASSAGE)])

    def block(batch: pa.RecordBatch, texts: list[str]) -> dict:
        model = shared.value
        cache = held(key, lambda: RecentCache(CACHE_ENTRIES))
        words = [_WORD.findall(t.lower()) for t in texts]
        seen: set[str] = set()
        for w in words:
            seen.update(w)
        known = cache.new
        for w in cache.missing(seen):
            known[w] = model.word_score(w)
        scores, passages = [], []
        for text, w in zip(texts, words, strict=True):
            s = np.fromiter(map(known.__getitem__, w), float, len(w))
            found = segments(s) if len(w) else []
            value = statistic([v for _, _, v in found], len(w), model.lam, model.log_k)
            scores.append(model.probability(value))
            passages.append(_places(text, found, len(w), model) if value > 0 and found else [])
        cache.trim()
        scores = np.array(scores)
        return {n: batch.column(i) for i, n in enumerate(batch.schema.names)} | {
            "score": scores, "predicted": (scores >= THRESHOLD).astype(np.int32),
            "passages": pa.array(passages, pa.list_(pa.struct([
                ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))}

    return map_blocks(docs, block, schema, chars)


def _places(text: str, found: list[tuple[int, int, float]], n: int, model: ToxicityModel) -> list[dict]:
    limit = (math.log(max(n, 1)) + model.log_k) / model.lam
    spans = [m.span() for m in _WORD.finditer(text.lower())]
    return [{"start": spans[a][0], "end": spans[b - 1][1], "score": s} for a, b, s in found if s > limit]


def fold(doc_id: str, parts: int) -> F.Column:
    return F.crc32(F.col(doc_id).cast("string")) % parts


def op6_model(spark: SparkSession, sf_dir: str) -> ToxicityModel:
    return fit_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"),
                        fold("doc_id", 3) != 1)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and decision for every document's whole text; learned from two folds of the labels."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, op6_model(spark, sf_dir))
    return scored.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
                         "score", "predicted", F.size("passages").cast("long").alias("n_passages"))
