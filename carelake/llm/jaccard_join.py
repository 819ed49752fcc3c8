"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents are sets of hashed word shingles. All sets are in one global order:
shingles that a sketch of the corpus' counts shows to be frequent come last,
the rest are in order of hash. If two sets have a Jaccard similarity of t
or more, they share at least l shingles among the first ``n - ceil(t n) + l``
of each (n its size), for every l. Each document picks its own l: the
more candidates its prefix is estimated to bring, the longer the prefix and the more
shared shingles it asks for. Two documents with l and m are candidates if
their prefixes share min(l, m) shingles.

Steps, all distributed:

1. ``count_sketch``: number of documents by hashed bucket of shingle, over all documents.
2. ``prefixes``: each document's size, set id (equal sets have equal ids and are one node from
   here on) and prefix. Repeated sets within a task send their prefix once.
3. Prefix shingles are aggregated to their least and greatest node (map-side combine);
   those with one node only are done with. Of the others, star pairs (each node with the ``LEADERS`` of the
   least and greatest nodes that it shares most with) are verified first and give components.
4. Pairs of different components that share enough prefix shingles, early enough in both
   sets, and were not verified yet are verified. So within a component a linear number of pairs
   is looked at, and no link between components is lost.
5. Verification joins the full sets, computed anew from the texts of the documents
   involved, and compares them exactly. A node's text is found by a row's key, the hash of
   its doc_id and text, so a null or repeated doc_id finds the node's own text.

Components come from minimum labels with pointer jumping, cut by written tables.

Defined cases: documents without words (null, empty or blank text) have an empty set, are
linked with nothing and are their own component; a text with fewer words than a
shingle is one shingle; repeated rows and equal sets are in one component; a null
doc_id takes part, but is nobody's component_id unless its component has no other id (then null);
an empty table gives an empty table; texts are read whole; other columns are not read.
Hashes have 64 bits.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import cut, read_table, release, ship, text_blocks

WORDS = 5
#: The similarity, as a fraction.
NUMERATOR, DENOMINATOR = 75, 100
#: Shingles per bucket of the sketch that are aimed at, and the bounds of its size (a byte a bucket is broadcast).
PER_BUCKET, MIN_BITS, MAX_BITS = 128, 14, 24
#: Least and greatest number of shared shingles that a document asks for.
LEAST_MATCHES, MOST_MATCHES = 2, 8
#: Partners of each node that are verified before pairs between components are looked at.
LEADERS = 3
#: Rows that are broadcast at most; beyond, joins are shuffled.
MAX_BROADCAST_ROWS = 1_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[_SPACE] = 0
_PLACE = _RANDOM.integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


#: Characters hashed at a time, so that arrays stay in the processor's cache.
_AT_ONCE = 250_000


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes."""
    out: list[np.ndarray] = []
    part: list[str] = []
    size = 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= _AT_ONCE:
            out += _shingle_sets(part)
            part, size = [], 0
    return out + (_shingle_sets(part) if part else [])


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])]


def _shingle_sets(texts: list[str]) -> list[np.ndarray]:
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(e) for e in encoded], np.int64) + 1
    data = _LOWER[np.frombuffer(b" ".join(encoded) + b" ", np.uint8)]
    word_byte = ~_SPACE[data]
    starts = np.flatnonzero(word_byte & np.concatenate([[True], ~word_byte[:-1]]))
    none = np.zeros(0, np.uint64)
    if not len(starts):
        return [none] * len(texts)
    # A word's hash: its bytes' random numbers times powers by place; white space counts 0.
    place = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    powers = np.full(int(place.max()) + 1, _BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    words = _mix(np.add.reduceat(_BYTE[data[starts[0]:]] * powers[place], starts - starts[0]))
    n = np.diff(np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)])))
    ends = np.cumsum(n)
    shingles = np.zeros(max(len(words) - WORDS + 1, 0), np.uint64)
    for j in range(WORDS):
        shingles += words[j:j + len(shingles)] * _PLACE[j]
    shingles = _mix(shingles)
    out = []
    for end, k in zip(ends.tolist(), n.tolist(), strict=True):
        if k >= WORDS:
            out.append(_distinct(shingles[end - k:end - WORDS + 1]))
        elif k:
            out.append(_mix((words[end - k:end] * _PLACE[:k]).sum(keepdims=True) + np.uint64(k)))
        else:
            out.append(none)
    return out


def set_id(hashes: np.ndarray) -> int:
    """Equal for equal sets."""
    mixed = _mix(hashes)
    both = np.array([mixed.sum(), np.bitwise_xor.reduce(mixed * np.uint64(_BASE))], np.uint64)
    return int(_mix(_mix(both[:1]) + both[1:] + np.uint64(len(hashes)))[0].astype(np.int64))


# ---------------------------------------------------------------- order

def count_sketch(docs: DataFrame, bits: int) -> np.ndarray:
    """Documents by bucket (the hash's lowest ``bits``), over all documents. Each task adds up its
    own; slices of the sketch are summed in two rounds, so no task gets more than some hundred slices."""
    ship(docs.sparkSession)
    width = min(bits, 14)

    def count(batches):
        from pyspark import TaskContext
        release()
        total = np.zeros(1 << bits, np.int64)
        for _, texts in text_blocks(batches):
            for s in shingle_sets(texts):
                np.add.at(total, (s & np.uint64((1 << bits) - 1)).astype(np.int64), 1)
        salt = TaskContext.get().partitionId() % 64
        slices = total.reshape(-1, 1 << width)
        used = [k for k in range(len(slices)) if slices[k].any()]
        yield pa.RecordBatch.from_arrays([
            pa.array(used, pa.int32()), pa.array([salt] * len(used), pa.int32()),
            pa.array([_packed(slices[k]) for k in used], pa.binary())], names=["slice", "salt", "counts"])

    def add(frame):
        import pandas as pd
        total = sum(np.frombuffer(zlib.decompress(x), np.int64) for x in frame["counts"])
        return pd.DataFrame({"slice": frame["slice"][:1], "salt": frame["salt"][:1], "counts": [_packed(total)]})

    schema = "slice int, salt int, counts binary"
    parts = docs.select("text").mapInArrow(count, schema)
    parts = parts.groupBy("slice", "salt").applyInPandas(add, schema)
    parts = parts.groupBy("slice").applyInPandas(add, schema)
    out = np.zeros((1 << bits - width, 1 << width), np.int64)
    for r in parts.collect():  # 2 ** MAX_BITS numbers at most
        out[r["slice"]] = np.frombuffer(zlib.decompress(r["counts"]), np.int64)
    return out.reshape(-1)


def _packed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.tobytes(), 1)


def levels(counts: np.ndarray) -> np.ndarray:
    """0 for buckets that are no fuller than chance has it, else 1 + the logarithm of the excess."""
    usual = float(np.median(counts))
    excess = counts - usual - 5 * math.sqrt(usual + 1)
    return np.where(excess > 0, 1 + np.log2(np.maximum(excess, 1)).astype(np.int64), 0).astype(np.uint8)


def prefix_of(hashes: np.ndarray, level: np.ndarray) -> tuple[int, int, np.ndarray]:
    """The number of shared shingles that a document asks for, the number of its shingles that are
    frequent, and its prefix."""
    n = len(hashes)
    need = -(-NUMERATOR * n // DENOMINATOR)
    lv = level[(hashes & np.uint64(len(level) - 1)).astype(np.int64)]
    order = np.argsort(lv, kind="stable") if lv.any() else np.arange(n)
    # Only early shingles bring partners of the same size: after them, too few are left to share.
    early = n - -(-2 * NUMERATOR * n // (NUMERATOR + DENOMINATOR)) + 1
    first = lv[order[:early]]
    cost = float(np.where(first > 0, 2.0 ** (first.astype(float) - 1), 0).sum())  # expected partners
    matches = min(max(LEAST_MATCHES, 1 + int(math.log2(1 + cost))), MOST_MATCHES, need)
    return matches, int((lv > 0).sum()), hashes[order[:n - need + matches]]


# ---------------------------------------------------------------- steps

_SETS = "doc_id long, key long, n long, node long, matches int, frequent int, prefix array<long>"


def prefixes(docs: DataFrame, level: np.ndarray) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(level)

    def run(batches):
        release()
        level, sent = shared.value, set()
        for batch, texts in text_blocks(batches):
            sets = shingle_sets(texts)
            nodes = [set_id(s) if len(s) else None for s in sets]
            asked, frequent, tokens = [], [], []
            for s, node in zip(sets, nodes, strict=True):
                if node is None or node in sent:
                    asked.append(0)
                    frequent.append(0)
                    tokens.append(None)
                    continue
                sent.add(node)
                matches, common, prefix = prefix_of(s, level)
                asked.append(matches)
                frequent.append(common)
                tokens.append(prefix.view(np.int64))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("key"), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.int64()),
                pa.array(asked, pa.int32()), pa.array(frequent, pa.int32()), pa.array(tokens, pa.list_(pa.int64()))],
                names=["doc_id", "key", "n", "node", "matches", "frequent", "prefix"])

    return docs.mapInArrow(run, _SETS)


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def similar_pairs(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """Of ``pairs`` (a, b), those whose sets are similar. ``docs``: key and text; ``nodes``: node, the key of
    one of its rows and whether other rows have that key too."""
    pairs = pairs.select("a", "b")
    n_pairs = pairs.count()
    by_key = pairs.join(nodes.select(F.col("node").alias("b"), "key"), "b").select("key", "a", "b")
    docs = docs.select("key", "text")
    members = docs.join(_small(cut(by_key, f"{name}-members"), n_pairs), "key").select("key", "a", "b", "text")
    firsts = pairs.select("a").distinct().join(nodes.withColumnRenamed("node", "a"), "a").select("key", "a", "copied")
    firsts = cut(firsts, f"{name}-firsts")
    n_copied = firsts.where("copied").count()

    def with_sets(batches):
        release()
        for batch, texts in text_blocks(batches):
            # A document is in several pairs: its rows are neighbours after the join.
            sets, last = [], None
            distinct = [k for k in range(len(texts)) if not k or texts[k] != texts[k - 1]]
            computed = iter(shingle_sets([texts[k] for k in distinct]))
            fresh = set(distinct)
            for k in range(len(texts)):
                if k in fresh:
                    last = next(computed).view(np.int64)
                sets.append(last)
            keep = [i for i, c in enumerate(batch.schema.names) if c not in ("text", "key")]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in keep], pa.array(sets, pa.list_(pa.int64()))],
                                             names=[*[batch.schema.names[i] for i in keep], "hashes"])

    members = members.mapInArrow(with_sets, "a long, b long, hashes array<long>")

    def sets_of(some: DataFrame) -> DataFrame:
        some = docs.join(_small(some.select("key", "a"), n_pairs), "key").select("key", "a", "text")
        return some.mapInArrow(with_sets, "a long, hashes array<long>").withColumnRenamed("hashes", "others")

    # One row of each: repeated rows would meet each other's in the join.
    single = sets_of(firsts.where("not copied"))
    firsts = single.unionByName(cut(sets_of(firsts.where("copied")).dropDuplicates(["a"]), f"{name}-copied")) if n_copied else single
    both = F.size(F.array_intersect("hashes", "others"))
    return (members.join(firsts, "a")
            .where(DENOMINATOR * both >= NUMERATOR * (F.size("hashes") + F.size("others") - both))
            .select("a", "b"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label): the least node of each component, for the nodes that have edges."""
    both = cut(edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
               .unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct(), f"{name}-edges")
    label = cut(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")), name)
    while True:
        near = both.join(label.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("near"))
        step = label.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        jump = label.select(F.col("node").alias("next"), F.col("label").alias("far"))
        step = step.join(jump, "next", "left").select(
            "node", F.col("label").alias("old"), F.least("next", F.coalesce("far", "next")).alias("label"))
        step = cut(step, name)
        label = step.select("node", "label")
        if not step.where("old <> label").limit(1).count():
            return label


def _most_shared(leads: DataFrame) -> DataFrame:
    """Of (node, leader, shared), the ``LEADERS`` of each node that it shares most with."""
    most = Window.partitionBy("node").orderBy(F.desc("shared"), "leader")
    return leads.withColumn("k", F.row_number().over(most)).where(F.col("k") <= LEADERS).drop("k")


def _outside(postings: DataFrame, label: DataFrame, sized: DataFrame) -> DataFrame:
    """The postings of shingles whose nodes are in several components, with label, n and matches of
    the node and the component that has most of the shingle's nodes (main)."""
    placed = cut(postings.join(label, "node", "left").withColumn("label", F.coalesce("label", "node")), "placed")
    sizes = placed.groupBy("token", "label").agg(F.count("*").alias("k"))
    mixed = (sizes.groupBy("token").agg(F.max_by("label", F.struct("k", "label")).alias("main"), F.count("*").alias("labels"))
             .where("labels > 1").select("token", "main"))
    return cut(placed.join(mixed, "token").join(sized.select("node", "n", "matches"), "node"), "mixed")


def row_key():
    """What tells rows apart that share a doc_id, for rows with the columns doc_id (long) and text (string)."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def similarity_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text)."""
    return similarity_rows(docs).select("doc_id", "n_shingles", "component_id")


def similarity_rows(docs: DataFrame) -> DataFrame:
    """What ``similarity_components`` returns of every row, with its ``row_key`` and its
    component's ``label``, which two components that share their smallest doc_id don't share."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("key", row_key())
    words = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = min(max(math.ceil(math.log2(max(words / 6 / PER_BUCKET, 1))), MIN_BITS), MAX_BITS)
    sets = cut(prefixes(docs, levels(count_sketch(docs, bits))), "sets")
    sized = sets.where("matches > 0").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))["key"].alias("key"), F.max("n").alias("n"),
        F.max("matches").alias("matches"))
    copied = sets.where("node is not null").groupBy("key").agg((F.count("*") > 1).alias("copied")).where("copied")
    sized = cut(sized.join(copied, "key", "left").withColumn("copied", F.coalesce("copied", F.lit(False))), "nodes")
    nodes = sized.select("node", "key", "copied")
    rows = sets.where("matches > 0").select("node", "frequent", F.posexplode("prefix").alias("place", "token"))

    # Prefix shingles of two nodes or more: the least, the greatest, the one with most frequent shingles
    # (in a group of near copies, one that has what the others share), and whether that is all.
    tokens = rows.groupBy("token").agg(F.min("node").alias("lo"), F.max("node").alias("hi"),
                                       F.max(F.struct("frequent", "node"))["node"].alias("top"), F.count("*").alias("n"))
    tokens = cut(tokens.where("lo <> hi"), "tokens")
    many = tokens.where("n > 2")
    n_many = many.count()
    stars = cut(rows.join(_small(many.select("token", "lo", "hi", "top"), n_many), "token").drop("frequent"), "stars")
    # Places of a shingle in the sets; 0, which excludes nothing, where it has two nodes only.
    postings = (tokens.where("n = 2").select("token", F.explode(F.array("lo", "hi")).alias("node"), F.lit(0).alias("place"))
                .unionByName(stars.select("token", "node", "place").distinct()))

    def enough(pairs: DataFrame) -> DataFrame:
        """Of (a, b, shared), those with sizes that allow a link and enough shared shingles."""
        return (pairs.join(sized.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("matches").alias("ma")), "a")
                .join(sized.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("matches").alias("mb")), "b")
                .where((DENOMINATOR * F.least("na", "nb") >= NUMERATOR * F.greatest("na", "nb"))
                       & (F.col("shared") >= F.least("ma", "mb"))).select("a", "b"))

    # Star pairs: of the leaders that a node shares prefix shingles with, the ones it shares most with.
    leads = stars.select("node", F.explode(F.array_distinct(F.array("lo", "hi", "top"))).alias("leader")).where("node <> leader")
    twos = tokens.where("n = 2").select(F.explode(F.array(
        F.struct(F.col("lo").alias("node"), F.col("hi").alias("leader")),
        F.struct(F.col("hi").alias("node"), F.col("lo").alias("leader")))).alias("x")).select("x.*")
    leads = leads.unionByName(twos).groupBy("node", "leader").agg(F.count("*").alias("shared"))
    leads = _most_shared(leads)
    star_pairs = leads.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"), "shared")
    first = cut(enough(star_pairs.groupBy("a", "b").agg(F.max("shared").alias("shared"))), "pairs")
    links = cut(similar_pairs(docs, nodes, first, "verify"), "links")
    label = components(links)

    # What is left: pairs of different components. A shingle's largest component there is met by the others'
    # nodes alone: pairs within it are not made. The first l shared shingles of a similar pair stand early:
    # after the k-th, no more than the rest of either set can be shared.
    placed = _outside(postings, label, sized)
    left = placed.where("label <> main").select("token", *[F.col(c).alias(f"{c}1") for c in ("node", "label", "place", "n", "matches")])
    right = placed.select("token", "main", *[F.col(c).alias(f"{c}2") for c in ("node", "label", "place", "n", "matches")])
    asked = F.least("matches1", "matches2")
    both = NUMERATOR + DENOMINATOR  # shared >= t / (1 + t) * (n1 + n2)
    across = left.join(right, "token").where(
        (F.col("label1") != F.col("label2")) & ((F.col("label2") == F.col("main")) | (F.col("node1") < F.col("node2")))
        & (DENOMINATOR * F.least("n1", "n2") >= NUMERATOR * F.greatest("n1", "n2"))
        & (both * (F.least(F.col("n1") - F.col("place1"), F.col("n2") - F.col("place2")) + asked - 1)
           >= NUMERATOR * (F.col("n1") + F.col("n2"))))
    across = (across.select(F.least("node1", "node2").alias("a"), F.greatest("node1", "node2").alias("b"), asked.alias("asked"))
              .groupBy("a", "b", "asked").agg(F.count("*").alias("shared")).where("shared >= asked"))
    rest = cut(across.select("a", "b").join(first, ["a", "b"], "left_anti"), "rest")
    if rest.limit(1).count():
        label = components(links.unionByName(cut(similar_pairs(docs, nodes, rest, "verify-rest"), "more-links")))

    of = sets.select("doc_id", "n", "node", "key").join(label, "node", "left")
    of = of.select("doc_id", "n", "key", F.coalesce("label", "node").alias("label"))
    least = of.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return of.join(least, "label", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.col("key").alias("row_key"), "label")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document's whole text."""
    return similarity_components(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


# ---------------------------------------------------------------- the same in DuckDB

SQL = r"""
with recursive docs as (
    select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
shingles as (
    select distinct r, s from (select r, unnest(case
        when len(w) >= 5 then list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))
        when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from docs)),
sizes as (select r, count(*) as n from shingles group by r),
shared as (select x.r as a, y.r as b, count(*) as c from shingles x join shingles y on x.s = y.s and x.r <> y.r group by all),
links as (select a, b from shared join sizes p on a = p.r join sizes q on b = q.r where 100 * c >= 75 * (p.n + q.n - c)),
reached as (select r, r as q from docs union select reached.r, links.b from reached join links on reached.q = links.a)
select d.doc_id, cast(coalesce(any_value(n), 0) as bigint) as n_shingles, min(o.doc_id) as component_id
from docs d join reached using (r) join docs o on o.r = reached.q left join sizes s on s.r = d.r
group by d.r, d.doc_id
"""
