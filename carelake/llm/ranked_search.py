"""Ranked lexical search by Block-Max MaxScore over a sharded inverted index.

**Index.** Each task cuts its documents into shards of about ``SHARD_CHARS``
characters and inverts each shard by itself, so building needs no shuffle. One row
per (shard, term) holds the term's postings there in blocks of ``BLOCK``:
gaps of document places and frequencies as variable-length bytes, and beside them,
uncompressed, each block's last place, its end in the bytes and its greatest
contribution; ``bound`` is the greatest of the shard. A row without
term holds the shard's documents (ids and length norms). Every word of every text is indexed.

**Search.** Queries are taken in parts of bounded size. A part's terms
select their rows of the index; the rows of a shard meet in one task, bounded by the shard's size:

* lists are taken by falling bound (weight times greatest contribution). As long as
  the bounds of the lists left could reach the ``k``-th best score so far they are essential:
  all their postings are added up. The rest only adds to documents found already;
* for a list of the rest, a document is rejected if its score, the maximum of its
  block in the list and the bounds of the lists after it stay under the ``k``-th
  best score; only blocks with documents that are left are decompressed.

Each shard returns its heap of ``k`` per query, ties included up to the smaller doc_id; the heaps
are merged by a window with a limit before its shuffle.

Terms are runs of ASCII letters and digits and of all other non-ASCII characters, A-Z in lower
case. With N documents that have a term, L terms of all, n of one document, df documents with
the term and tf its occurrences in one, a term weighs ``floor(1000 ln((2N + 2) / (2 df + 1)))`` and
adds ``(10^9 tf) div (1000 tf + 12 m)`` times that, ``m = 75 + (25 n N) div L``, in 64-bit integers.

Defined cases: null and empty texts have no terms and are neither found nor counted; items
without terms find nothing; equal rows of items are one item, rows with one id and two texts are two; equal rows of
documents are all ranked; equal scores go by ascending doc_id, null ids last; texts of any length are
indexed whole (a longer one than a shard is a shard); empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from carelake.session import work_dir

from .common import read_table, ship, text_blocks

#: Characters of a shard, but for one longer text.
SHARD_CHARS = 16_000_000
#: Postings of a block.
BLOCK = 128
#: Queries and characters of their terms that are searched for at a time.
PART_ITEMS, PART_CHARS = 20_000, 4_000_000
#: Documents returned for each query.
TOP = 20

# The scale of a contribution, and the weights of frequency and length in it.
SCALE, TF_WEIGHT, NORM_WEIGHT, LENGTH_SHARE = 1_000_000_000, 1000, 12, 25

INDEX_SCHEMA = ("shard long, term string, df long, bound long, lasts array<int>, ends array<int>, "
                "maxima array<int>, payload binary")

#: What is no part of a term becomes a space, A-Z become a-z.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))


def terms_of(text: str) -> list[bytes]:
    """The text's terms in order, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


# ---------------------------------------------------------------- the index

@dataclass
class Index:
    path: str
    documents: int  #: that have a term
    terms: int      #: of all documents, with repeats


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all terms: summed in each task first."""
    ship(docs.sparkSession)

    def run(batches):
        with_terms = total = 0
        for _, texts in text_blocks(batches):
            sizes = [len(terms_of(t)) for t in texts]
            with_terms += sum(map(bool, sizes))
            total += sum(sizes)
        yield pa.RecordBatch.from_arrays([pa.array([with_terms]), pa.array([total])], names=["n", "l"])

    row = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "n long, l long").agg(
        F.sum("n"), F.sum("l")).first()
    return row[0] or 0, row[1] or 0


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Variable-length bytes (7 bits each, the last under 128) of the values, and where each ends."""
    size = np.ones(len(values), np.int64)
    for k in range(1, 9):
        size += values >= 1 << 7 * k
    ends = np.cumsum(size)
    starts = ends - size
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(size.max(initial=0))):
        has = size > k
        out[starts[has] + k] = values[has] >> 7 * k & 127 | np.where(size[has] > k + 1, 128, 0)
    return out, ends


def unpack(data) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    more = raw >= 128
    if not more.any():
        return raw.astype(np.int64)
    ends = np.flatnonzero(~more)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((raw & 127).astype(np.int64) << 7 * place, starts)


class _Shard:
    """Collects the postings of a shard's documents."""

    def __init__(self, documents: int, terms: int):
        self.documents, self.terms = documents, terms
        self.vocabulary: dict[bytes, int] = {}
        self.postings: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.chars = 0

    def add(self, ids: list, texts: list[str]) -> None:
        cut = [terms_of(t) for t in texts]
        vocabulary = self.vocabulary
        for words in cut:
            for w in set(words):
                if w not in vocabulary:
                    vocabulary[w] = len(vocabulary)
        sizes = np.array([len(c) for c in cut], np.int64)
        terms = np.fromiter((vocabulary[w] for c in cut for w in c), np.int64, int(sizes.sum()))
        places = np.repeat(np.arange(len(self.ids), len(self.ids) + len(cut)), sizes)
        keys, counts = np.unique(terms << 32 | places, return_counts=True)
        self.postings.append(((keys >> 32).astype(np.int32), (keys & 0xFFFFFFFF).astype(np.int32), counts))
        self.ids += ids
        self.sizes += sizes.tolist()
        self.chars += sum(map(len, texts))

    def rows(self, shard: int) -> pa.RecordBatch:
        norm = 100 - LENGTH_SHARE + LENGTH_SHARE * np.array(self.sizes, np.int64) * self.documents // max(self.terms, 1)
        term, place, count = (np.concatenate(x) for x in zip(*self.postings, strict=True))
        order = np.argsort(term, kind="stable")  # places ascend within a term, for blocks came in their order
        term, place, count = term[order], place[order].astype(np.int64), count[order].astype(np.int64)
        gain = SCALE * count // (TF_WEIGHT * count + NORM_WEIGHT * norm[place])
        first = np.flatnonzero(np.diff(term, prepend=-1))         # of each list
        df = np.diff(first, append=len(term))
        in_list = np.arange(len(term)) - np.repeat(first, df)
        heads = np.flatnonzero(in_list % BLOCK == 0)              # of each block
        gap = np.diff(place, prepend=0)
        gap[first] = place[first]
        data, ends = pack(np.stack([gap, count], 1).reshape(-1))
        tails = np.append(heads[1:], len(term))[:len(heads)] - 1
        blocks = -(-df // BLOCK)
        list_start = np.concatenate([[0], ends[2 * (first + df) - 1]]) if len(first) else np.zeros(1, np.int64)
        maxima = np.maximum.reduceat(gain, heads) if len(heads) else gain
        block_ends = ends[2 * tails + 1] - np.repeat(list_start[:-1], blocks)
        offsets = pa.array(np.concatenate([[0], np.cumsum(blocks)]), pa.int32())
        words = list(self.vocabulary)
        payload = pa.BinaryArray.from_buffers(pa.binary(), len(first), [
            None, pa.array(list_start, pa.int32()).buffers()[1], pa.py_buffer(data)])
        lists = pa.RecordBatch.from_arrays([
            pa.array(np.full(len(first), shard)), pa.array([words[t] for t in term[first]], pa.binary()).cast(pa.string()),
            pa.array(df, pa.int64()),
            pa.array(np.maximum.reduceat(gain, first) if len(first) else gain, pa.int64()),
            pa.ListArray.from_arrays(offsets, pa.array(place[tails], pa.int32())),
            pa.ListArray.from_arrays(offsets, pa.array(block_ends, pa.int32())),
            pa.ListArray.from_arrays(offsets, pa.array(maxima, pa.int32())), payload],
            names=["shard", "term", "df", "bound", "lasts", "ends", "maxima", "payload"])
        ids = np.array([0 if i is None else i for i in self.ids], "<i8")
        known = np.array([i is not None for i in self.ids], np.uint8)
        own = pa.RecordBatch.from_pylist([{
            "shard": shard, "term": None, "df": len(ids), "bound": 0, "lasts": [], "ends": [], "maxima": [],
            "payload": ids.tobytes() + norm.astype("<i8").tobytes() + known.tobytes()}], schema=lists.schema)
        return pa.Table.from_batches([own, lists]).combine_chunks().to_batches()[0]


def build_index(docs: DataFrame, path: str, shard_chars: int = SHARD_CHARS) -> Index:
    """Write the index of all documents (doc_id, text) to the folder ``path``."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    documents, terms = corpus_size(docs)

    def run(batches):
        made, shard = 0, _Shard(documents, terms)
        for batch, texts in text_blocks(batches):
            if shard.ids and shard.chars + sum(map(len, texts)) > shard_chars:
                yield shard.rows((TaskContext.get().partitionId() << 32) + made)
                made, shard = made + 1, _Shard(documents, terms)
            shard.add(batch.column(0).to_pylist(), texts)
        if shard.ids:
            yield shard.rows((TaskContext.get().partitionId() << 32) + made)

    docs.mapInArrow(run, INDEX_SCHEMA).write.parquet(f"{path}/postings")
    spark.createDataFrame([(documents, terms)], "documents long, terms long").coalesce(1).write.parquet(f"{path}/size")
    return Index(path, documents, terms)


def open_index(spark: SparkSession, path: str) -> Index:
    size = spark.read.schema("documents long, terms long").parquet(f"{path}/size").first()
    return Index(path, size.documents, size.terms)


# ---------------------------------------------------------------- search

class _List:
    """A term's postings in a shard; blocks are decompressed when asked for and kept for the shard's queries."""

    def __init__(self, bound, lasts, ends, maxima, payload, norm):
        self.bound, self.lasts, self.maxima = bound, np.array(lasts, np.int64), np.array(maxima, np.int64)
        self.ends, self.payload, self.norm = ends, payload, norm
        self.blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.whole: tuple[np.ndarray, np.ndarray] | None = None

    def _decode(self, data, before: int) -> tuple[np.ndarray, np.ndarray]:
        values = unpack(data)
        place = before + np.cumsum(values[::2])
        count = values[1::2]
        return place, SCALE * count // (TF_WEIGHT * count + NORM_WEIGHT * self.norm[place])

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of all documents that hold the term, ascending, and the term's contributions."""
        if self.whole is None:
            self.whole = self._decode(self.payload, 0)
        return self.whole

    def some(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of some blocks."""
        if self.whole is not None or 2 * len(blocks) > len(self.lasts):
            return self.all()
        for b in blocks.tolist():
            if b not in self.blocks:
                self.blocks[b] = self._decode(self.payload[self.ends[b - 1] if b else 0:self.ends[b]],
                                              int(self.lasts[b - 1]) if b else 0)
        parts = [self.blocks[b] for b in blocks.tolist()]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def max_score(lists: list[tuple[int, _List]], documents: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of all documents that can be among the ``k`` best, ties included.

    ``lists`` are pairs of a weight (above 0) and a list.
    """
    lists = sorted(lists, key=lambda x: -x[0] * x[1].bound)
    left = np.cumsum([0] + [w * x.bound for w, x in reversed(lists)])[::-1].tolist()  # bounds from each list on
    scores = np.zeros(documents, np.int64)
    least, at = 0, 0
    for weight, postings in lists:                       # essential lists
        if left[at] < least:
            break
        place, gain = postings.all()
        scores[place] += weight * gain
        at += 1
        if at < len(lists) and left[at] < scores.max():
            least = max(least, _kth(scores, k))
    found = np.flatnonzero((scores > 0) & (scores + left[at] >= least))
    for j in range(at, len(lists)):                      # the others add to what is found
        weight, postings = lists[j]
        block = np.searchsorted(postings.lasts, found)
        most = np.append(weight * postings.maxima, 0)[block]
        keep = scores[found] + most + left[j + 1] >= least
        found, block, most = found[keep], block[keep], most[keep]
        inside = found[most > 0]
        if len(inside):
            place, gain = postings.some(np.unique(block[most > 0]))
            spot = np.minimum(np.searchsorted(place, inside), len(place) - 1)
            hit = place[spot] == inside
            scores[inside[hit]] += weight * gain[spot[hit]]
            least = max(least, _kth(scores[found], k))
        found = found[scores[found] + left[j + 1] >= least]
    if len(found) > k:
        found = found[scores[found] >= _kth(scores[found], k)]
    return found, scores[found]


def _shard_search(rows: pa.Table, queries: list, weights: dict[str, int], k: int) -> pa.Table:
    """The heap of each query in one shard."""
    rows = rows.to_pylist()
    own = next(r for r in rows if r["term"] is None)
    n = own["df"]
    ids = np.frombuffer(own["payload"], "<i8", n)
    norm = np.frombuffer(own["payload"], "<i8", n, 8 * n)
    known = np.frombuffer(own["payload"], np.uint8, n, 16 * n) > 0
    lists = {r["term"]: _List(r["bound"], r["lasts"], r["ends"], r["maxima"], r["payload"], norm)
             for r in rows if r["term"] is not None}
    out: list[list] = [[], [], [], []]
    for number, item, terms in queries:
        place, score = max_score([(c * weights[t], lists[t]) for t, c in terms.items()
                                  if t in lists and weights[t] > 0], n, k)
        order = np.lexsort((ids[place], ~known[place], -score))[:k]
        place, score = place[order], score[order]
        out[0] += [number] * len(place)
        out[1] += [item] * len(place)
        out[2] += [int(i) if v else None for i, v in zip(ids[place], known[place], strict=True)]
        out[3] += score.tolist()
    return pa.table([pa.array(c, pa.int64()) for c in out], names=["query", "item_id", "doc_id", "score"])


def _searcher(sent, k: int):
    def run(table):
        return _shard_search(table, *sent.value, k)
    return run


def _item_terms(items: DataFrame) -> DataFrame:
    """Distinct items with their terms and how often each holds them."""
    ship(items.sparkSession)

    def run(batches):
        for batch, texts in text_blocks(batches):
            counts = []
            for t in texts:
                count: dict[str, int] = {}
                for w in terms_of(t):
                    count[w.decode("utf-8", "surrogatepass")] = count.get(w.decode("utf-8", "surrogatepass"), 0) + 1
                counts.append(count)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([list(c) for c in counts], pa.list_(pa.string())),
                pa.array([list(c.values()) for c in counts], pa.list_(pa.int64()))],
                names=["item_id", "terms", "counts"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return rows.distinct().mapInArrow(run, "item_id long, terms array<string>, counts array<long>").where(
        F.size("terms") > 0)


def search(spark: SparkSession, index: Index, items: DataFrame, k: int = TOP,
           part_items: int = PART_ITEMS, part_chars: int = PART_CHARS) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of each item (item_id, text)."""
    from .common import cut
    postings = spark.read.schema(INDEX_SCHEMA).parquet(f"{index.path}/postings")
    items = cut(_item_terms(items), "queries")
    size = F.aggregate("terms", F.lit(0).cast("long"), lambda a, t: a + F.length(t) + 1)
    total = items.agg(F.count("*").alias("n"), F.sum(size).alias("chars")).first()
    parts = max(-(-total.n // part_items), -(-(total.chars or 0) // part_chars))
    part = F.pmod(F.xxhash64("item_id", "terms", "counts"), F.lit(max(parts, 1)))
    heaps = spark.createDataFrame([], "part int, query long, item_id long, doc_id long, score long")
    for p in range(parts):  # a part of bounded size goes through the driver, and to the tasks
        rows = items.where(part == p).collect()
        terms = sorted({t for r in rows for t in r.terms})
        wanted = spark.createDataFrame([(t,) for t in [None, *terms]], "t string")
        lists = postings.join(F.broadcast(wanted), F.col("term").eqNullSafe(F.col("t")), "left_semi")
        df = lists.where("term is not null").groupBy("term").agg(F.sum("df").alias("df")).collect()
        weights = {r.term: math.floor(1000 * math.log((2 * index.documents + 2) / (2 * r.df + 1))) for r in df}
        queries = [(n, r.item_id, {t: c for t, c in zip(r.terms, r.counts, strict=True) if t in weights})
                   for n, r in enumerate(rows)]
        sent = spark.sparkContext.broadcast((queries, weights))
        found = lists.groupBy("shard").applyInArrow(_searcher(sent, k), "query long, item_id long, doc_id long, score long")
        heaps = heaps.unionByName(found.withColumn("part", F.lit(p)))
    best = Window.partitionBy("part", "query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (heaps.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    index = build_index(read_table(spark, sf_dir, "documents"), work_dir(spark, "search_index"))
    return search(spark, index, read_table(spark, sf_dir, "benchmark"))


_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_WORDS = (rf"regexp_extract_all(translate(text, '{_LETTERS.upper()}', '{_LETTERS}'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents WHERE text IS NOT NULL),
counted AS (SELECT r, doc_id, words, len(words) AS n FROM d WHERE len(words) > 0),
size AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM counted),
norm AS (SELECT r, doc_id, 75 + (25 * n * n_docs) // n_terms AS m FROM counted, size),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM counted) GROUP BY r, term),
weight AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
           FROM tf, size GROUP BY term, n_docs),
item AS (SELECT row_number() OVER () AS q, item_id, {_WORDS} AS words FROM (SELECT DISTINCT item_id, text FROM benchmark)),
asked AS (SELECT q, item_id, term, count(*) AS c FROM (SELECT q, item_id, unnest(words) AS term FROM item) GROUP BY q, item_id, term),
scored AS (SELECT q, item_id, norm.r, norm.doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
           FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN norm USING (r) GROUP BY q, item_id, norm.r, norm.doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
           FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
