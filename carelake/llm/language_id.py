"""Language identification with string kernels.

Kernel: two texts are compared by the character n-grams of 1 to 3 (blended
spectrum) that both contain, presence only, divided by the geometric mean of
their own numbers. Landmark texts give the Nyström map of the kernel, and one
ridge regression per language (one versus the rest) is fitted in that space.
All is linear in the presence vector, so scoring a batch of texts is one
matrix product of presences with the landmarks' folded weights.

Fit: a bounded sample of labelled rows, ``PER_LANGUAGE`` distinct texts of at most ``SAMPLE_CHARS`` characters
per language (by hash of the text), for at most ``MAX_LANGUAGES`` languages;
``LANDMARKS`` of each language's texts are landmarks. Counting of n-grams covers whole texts. N-grams of the
sample's ``ALPHABET`` most frequent characters are features of their own; all others, of any script, are
hashed into ``2 ** RARE_BITS`` features.

Defined cases: a null text, or one without a letter or without a feature, is ``und`` with score 0;
so is every text if no labelled row is there to learn from. Ties go to the first
language in order of name. Rows with null lang or doc_id are never learned from;
repeated texts are learned once; repeated rows each get a row; an empty table
gives an empty table; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from .common import map_blocks, read_table

#: Texts of each language to learn from, and their greatest length.
PER_LANGUAGE, SAMPLE_CHARS = 300, 20_000
#: Of these, the landmarks.
LANDMARKS = 60
MAX_LANGUAGES = 256
#: Characters whose n-grams have features of their own: the sample's most frequent ones (a power of two, less one
#: for the rest).
ALPHABET = 127
SHIFT = 7
#: Features that n-grams with any other character are hashed into, as a power of two.
RARE_BITS = 16
RIDGE = 1e-2
UNKNOWN = "und"
#: Texts in a matrix product.
BATCH = 256


@dataclass
class KernelModel:
    languages: list[str]
    code: np.ndarray        # code point to 0 (other) or 1..ALPHABET
    slots: list[np.ndarray]  # n-gram (its characters' codes shifted together) to feature, or to the number of features
    rare: np.ndarray        # hash of an n-gram with another character to feature, or to the number of features
    weights: np.ndarray     # features x languages

    @property
    def size(self) -> int:
        return self.weights.shape[0]


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")


def _rare(points: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of the n-grams that hold a character without a code."""
    other = codes == 0
    if not other.any():
        return np.zeros(0, np.int64)
    one = points.astype(np.uint64) + np.uint64(1)
    two = one[:-1] << np.uint64(21) | one[1:]
    three = two[:-1] << np.uint64(21) | one[2:]
    pair = other[:-1] | other[1:]
    ids = np.concatenate([one[other], two[pair], three[pair[:-1] | other[2:]]])
    ids = (ids ^ ids >> np.uint64(31)) * np.uint64(0x7FB5D329728EA185)
    ids = (ids ^ ids >> np.uint64(27)) * np.uint64(0x81DADEF4BC2DD44D)
    return (ids >> np.uint64(64 - RARE_BITS)).astype(np.int64)


def _grams(codes: np.ndarray):
    """Ids of the n-grams of 1, 2 and 3 characters."""
    one = codes.astype(np.uint32)
    two = one[:-1] << SHIFT | one[1:]
    return one, two, two[:-1] << SHIFT | one[2:]


def presence(texts: list[str], model: KernelModel) -> np.ndarray:
    """texts x features, 1 where the text has the n-gram."""
    out = np.zeros((len(texts), model.size + 1), np.float32)
    for row, text in zip(out, texts, strict=True):
        points = _points(text)
        codes = model.code[points]
        for grams, slots in zip(_grams(codes), model.slots, strict=True):
            row[slots[grams]] = 1
        row[model.rare[_rare(points, codes)]] = 1
    return out[:, :-1]


def score(texts: list[str], model: KernelModel) -> np.ndarray:
    """texts x languages: the regressions' values."""
    p = presence(texts, model)
    return (p @ model.weights) / np.sqrt(np.maximum(p.sum(1, keepdims=True), 1))


def fit_kernel(texts: list[str], langs: list[str], landmarks: int = LANDMARKS) -> KernelModel | None:
    """From the sample, in a fixed order."""
    languages = sorted(set(langs))
    if not languages:
        return None
    chars, counts = np.unique(np.concatenate(
        [_points(t) for t in texts] or [np.zeros(0, "<u4")]),
        return_counts=True)
    code = np.zeros(0x110000, np.uint8)
    kept = chars[np.lexsort((chars, -counts))][:ALPHABET]
    code[kept] = np.arange(1, len(kept) + 1)
    taken: dict[str, int] = {}
    marks = []
    for k, lang in enumerate(langs):
        taken[lang] = taken.get(lang, 0) + 1
        if taken[lang] <= landmarks:
            marks.append(k)
    # The features: n-grams of the landmarks; those that hold other characters by their hashes.
    slots, size = [], 0
    for n in (1, 2, 3):
        seen = np.zeros(1 << SHIFT * n, bool)
        for k in marks:
            seen[_grams(code[_points(texts[k])])[n - 1]] = True
        ids = np.flatnonzero(seen)
        for place in range(n):
            ids = ids[(ids >> SHIFT * place) & ((1 << SHIFT) - 1) > 0]
        table = np.full(1 << SHIFT * n, -1, np.int32)
        table[ids] = np.arange(size, size + len(ids))
        size += len(ids)
        slots.append(table)
    rare = np.full(1 << RARE_BITS, -1, np.int32)
    for k in marks:
        points = _points(texts[k])
        rare[_rare(points, code[points])] = 0
    used = np.flatnonzero(rare == 0)
    rare[used] = np.arange(size, size + len(used))
    size += len(used)
    for table in [*slots, rare]:
        table[table < 0] = size
    model = KernelModel(languages, code, slots, rare, np.zeros((size, 0), np.float32))
    marked = presence([texts[k] for k in marks], model)
    marked /= np.sqrt(np.maximum(marked.sum(1, keepdims=True), 1))
    values, vectors = np.linalg.eigh((marked @ marked.T).astype(float))
    keep = values > 1e-6 * values.max()
    nystroem = vectors[:, keep] / np.sqrt(values[keep])     # kernel values with the landmarks to features
    phi = []
    for start in range(0, len(texts), BATCH):
        p = presence(texts[start:start + BATCH], model)
        p /= np.sqrt(np.maximum(p.sum(1, keepdims=True), 1))
        phi.append((p @ marked.T) @ nystroem)
    phi = np.concatenate(phi)
    target = np.where(np.array(langs)[:, None] == np.array(languages), 1.0, -1.0)
    w = np.linalg.solve(phi.T @ phi + RIDGE * len(texts) / len(languages) * np.eye(phi.shape[1]), phi.T @ target)
    model.weights = (marked.T @ (nystroem @ w)).astype(np.float32)
    return model


def fit_language(docs: DataFrame, learn: F.Column | None = None) -> KernelModel | None:
    """``docs``: text and lang; ``learn``: condition of the rows to learn from."""
    rows = docs.where("lang is not null and text is not null")
    if learn is not None:
        rows = rows.where(learn)
    rows = rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.where(F.length("text").between(1, SAMPLE_CHARS)).withColumn("h", F.xxhash64("text"))
    first = Window.partitionBy("lang").orderBy("h")
    hashes = rows.select("lang", "h").distinct().withColumn("k", F.row_number().over(first))
    picked = hashes.where(F.col("k") <= PER_LANGUAGE).select("lang", "h")
    langs = [r["lang"] for r in picked.groupBy("lang").count()
             .orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()]
    keys = picked.where(F.col("lang").isin(langs)).collect() if langs else []  # at most MAX_LANGUAGES * PER_LANGUAGE
    spark = docs.sparkSession
    few = spark.createDataFrame([(r["lang"], r["h"]) for r in keys], "lang string, h long")
    texts = rows.join(F.broadcast(few), ["lang", "h"]).dropDuplicates(["lang", "h"]).collect()
    texts = sorted((r["h"], r["lang"], r["text"]) for r in texts)
    return fit_kernel([t for _, _, t in texts], [x for _, x, _ in texts])


def identify(docs: DataFrame, model: KernelModel | None) -> DataFrame:
    """``docs`` with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score").withColumn("text", F.col("text").cast("string"))
    schema = T.StructType(docs.schema.fields + [T.StructField("lang_pred", T.StringType()),
                                                T.StructField("score", T.DoubleType())])

    def block(batch: pa.RecordBatch, texts: list[str]) -> dict:
        model = shared.value
        pred, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        lettered = [k for k, t in enumerate(texts) if any(map(str.isalpha, t))] if model else []
        for start in range(0, len(lettered), BATCH):
            rows = lettered[start:start + BATCH]
            values = score([texts[k] for k in rows], model)
            best = values.argmax(1)
            known = values.any(1)  # all 0: without a feature
            pred[rows] = np.where(known, np.array(model.languages, object)[best], UNKNOWN)
            scores[rows] = np.where(known, np.clip((values[np.arange(len(rows)), best].astype(float) + 1) / 2, 0, 1), 0)
        return {n: batch.column(i) for i, n in enumerate(batch.schema.names)} | {
            "lang_pred": pa.array(pred.tolist(), pa.string()), "score": scores}

    return map_blocks(docs, block, schema)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document's whole text, learned from three folds of the ids."""
    docs = read_table(spark, sf_dir, "documents")
    part = F.crc32(F.col("doc_id").cast("string")) % 4
    model = fit_language(docs.select("doc_id", "text", "lang"), part != 2)
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
