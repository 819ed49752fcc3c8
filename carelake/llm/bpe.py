"""Byte-level BPE encoding and decoding by corpus-level merge replay.

Texts are cut into pre-tokens; each distinct pre-token of a block of
documents is one word of the block's word list. An inverted index from
token pair to word positions then replays the merges in rank order over the
whole word list: the lowest rank is taken, all its positions are merged, and
only the pairs of the touched neighbours enter the index anew. Documents are
put together from their words' ids.

Spark deals out the documents; a block is a bounded number of characters, and
words seen lately stay in a bounded cache of the Python worker, so a frequent
word is replayed once per worker and no word list grows with the corpus. No
shuffle is needed.

Defined cases: a null or empty text has no ids and decodes to no bytes; a text
of any length is encoded whole; repeated rows are encoded alike; an empty
table gives an empty table; input columns other than the text pass through,
and a column of the input with the name of an output column is replaced.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import BLOCK_CHARS, RecentCache, held, map_blocks, read_table, ship

#: A vocabulary file over this size is refused: it is shipped to every executor.
MAX_VOCABULARY_BYTES = 64 << 20
#: Words and chunks that a Python worker remembers (twice as many at most).
CACHE_ENTRIES = 600_000


def read_vocabulary(path: str) -> bytes:
    if (size := os.path.getsize(path)) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has {size} bytes; at most {MAX_VOCABULARY_BYTES} are broadcast")
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and rank."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) }


class MergeReplay:
    """Encodes word lists by replaying the merges of ``ranks`` in rank order."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.byte_ids = [ranks[bytes([b])] for b in range(256)]
        self.byte_table = np.array(self.byte_ids)
        self.first_ranks = np.array([[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)])
        # Left token to right token to the rank of their merge (-1: none), as far as pairs came up.
        self.pairs: list[dict[int, int]] = [{} for _ in range(max(ranks.values()) + 1)]
        self.n_pairs = 0

    def rank(self, a: int, b: int) -> int:
        """The rank of the merge of two neighbouring tokens, -1 without one."""
        r = self.pairs[a].get(b)
        if r is None:
            if self.n_pairs > 2_000_000:
                for known in self.pairs:
                    known.clear()
                self.n_pairs = 0
            r = self.pairs[a][b] = self.ranks.get(self.bytes_of[a] + self.bytes_of[b], -1)
            self.n_pairs += 1
        return r

    def encode(self, words: Iterable[bytes]) -> list[tuple[int, ...]]:
        """The ids of each word."""
        words = list(words)
        whole = self.ranks
        out = [() if not w else (whole[w],) if w in whole else None for w in words]
        split = [k for k, ids in enumerate(out) if ids is None]
        # The split words' tokens one after the other: -1 between words, later -2 where merged away.
        sizes = np.array([len(words[k]) for k in split], np.int64)
        starts = np.cumsum(sizes + 1) - sizes
        size = int(sizes.sum()) + len(split) + 1
        tokens = np.full(size, -1, np.int64)
        text = np.frombuffer(b"".join([words[k] for k in split]), np.uint8)
        places = np.arange(len(text)) + np.repeat(np.arange(len(split)) + 1, sizes)
        tokens[places] = self.byte_table[text]
        at_byte = np.zeros(size, np.uint8)
        at_byte[places] = text
        inner = np.flatnonzero((tokens[:-1] >= 0) & (tokens[1:] >= 0))
        ranks = self.first_ranks[at_byte[inner], at_byte[inner + 1]]
        inner, ranks = inner[ranks >= 0], ranks[ranks >= 0]
        order = np.argsort(ranks, kind="stable")
        inner, ranks = inner[order], ranks[order]
        edges = np.flatnonzero(np.diff(ranks, prepend=-1))
        #: rank of a pair to the positions of its left token
        index = {int(ranks[e]): p.tolist() for e, p in zip(edges, np.split(inner, edges[1:]), strict=True)} if len(edges) else {}
        first = list(zip(split, starts.tolist(), strict=True))
        token = tokens.tolist()
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        rank, pairs = self.rank, self.pairs
        queue = list(index)
        heapq.heapify(queue)
        doubtful: list[int] = []  # positions where a merge made a pair of lower rank
        while queue:
            r = heapq.heappop(queue)
            positions = index.pop(r)
            if len(positions) > 1:
                positions.sort()
            for p in positions:
                a, q = token[p], after[p]
                if a < 0:
                    continue
                b = token[q]
                if b < 0 or (pairs[a].get(b) or rank(a, b)) != r:
                    continue
                n, l = after[q], before[p]
                token[p], token[q] = r, -2
                after[p], before[n] = n, p
                t = token[l]
                if t >= 0:
                    k = pairs[t].get(r)
                    if k is None:
                        k = rank(t, r)
                    if k >= 0:
                        if k in index:
                            index[k].append(l)
                        else:
                            index[k] = [l]
                            heapq.heappush(queue, k)
                        if k < r:
                            doubtful.append(p)
                t = token[n]
                if t >= 0:
                    k = pairs[r].get(t)
                    if k is None:
                        k = rank(r, t)
                    if k >= 0:
                        if k in index:
                            index[k].append(p)
                        else:
                            index[k] = [p]
                            heapq.heappush(queue, k)
                        if k < r:
                            doubtful.append(p)
        for w, p in first:
            ids = []
            while token[p] >= 0:
                ids.append(token[p])
                p = after[p]
            out[w] = tuple(ids)
        if doubtful:
            self._mend(doubtful, first, token, size, out)
        return out  # type: ignore[return-value]

    def _mend(self, doubtful, first, token, size, out) -> None:
        """Words in which a lower rank came up while a rank was replayed are merged one pair at a time."""
        starts = np.array([p for _, p in first])
        for k in set(np.searchsorted(starts, doubtful, "right") - 1):
            w = first[k][0]
            ids = [self.byte_ids[b] for b in b"".join(self.bytes_of[i] for i in out[w])]
            while True:
                best = min(((r, p) for p in range(len(ids) - 1)
                            if (r := self.rank(ids[p], ids[p + 1])) >= 0), default=None)
                if best is None:
                    break
                ids[best[1]:best[1] + 2] = [best[0]]
            out[w] = tuple(ids)


#: Between a space with a non-space after it and what stands before it, every match of the pattern ends.
_CHUNK = regex.compile(r" (?=\S)")
_ODD = regex.compile(r" \s")


def chunks_of(text: str) -> list[str]:
    """The text's chunks, each but the first without the space that begins it."""
    return _CHUNK.split(text) if _ODD.search(text) or text[-1:] == " " else text.split(" ")


def chunk_key(text: str) -> str | tuple[str, str]:
    return text[1:] if text[:1] == " " else ("", text)


class BlockEncoder:
    """Encodes blocks of texts; ``pre_token`` is the pattern that cuts a text."""

    def __init__(self, ranks: dict[bytes, int], pre_token: str, cache: int = CACHE_ENTRIES):
        self.replay = MergeReplay(ranks)
        self.find = regex.compile(pre_token).findall
        # Ids of chunks and pre-tokens: by what follows their first space, or by ("", text) if there is none.
        self.known = RecentCache(cache)

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian 32-bit integers."""
        cut = [chunks_of(t) for t in texts]
        for c in cut:
            c[0] = chunk_key(c[0])
        seen: set = set()
        for c in cut:
            seen.update(c)
        self._learn(seen)
        known = self.known.new
        out = [b"".join(map(known.__getitem__, c)) for c in cut]
        self.known.trim()
        return out

    def _learn(self, seen: Iterable) -> None:
        new = self.known.missing(seen)
        known = self.known.new
        pieces = {k: self.find(k[1] if isinstance(k, tuple) else " " + k) for k in new}
        words = {w: chunk_key(w) for p in pieces.values() for w in p}
        unknown = set(self.known.missing(words.values()))
        words = [w for w, k in words.items() if k in unknown]
        # A chunk that is one pre-token has the same key; the others are put together afterwards.
        for w, ids in zip(words, self.replay.encode([w.encode("utf-8", "surrogatepass") for w in words]),
                          strict=True):
            known[chunk_key(w)] = np.array(ids, "<u4").tobytes()
        for k, p in pieces.items():
            if len(p) != 1:
                known[k] = b"".join([known[chunk_key(w)] for w in p])


def _with(df: DataFrame, *fields: T.StructField) -> T.StructType:
    names = {f.name for f in fields}
    return T.StructType([f for f in df.schema.fields if f.name not in names] + list(fields))


def bpe_encode(df: DataFrame, vocabulary: str, pre_token: str, text: str = "text",
               out: str = "ids", decoded: str | None = None, cache: int = CACHE_ENTRIES,
               chars: int = BLOCK_CHARS) -> DataFrame:
    """``df`` with the ids of each text as ``array<int>`` in column ``out``; with ``decoded``, also
    the bytes that those ids stand for, in that column (``bpe_decode`` without another pass).

    A worker remembers ``cache`` words (twice as many at most) and takes texts of about ``chars`` characters
    at a time; neither changes the ids."""
    content = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    key = ("bpe", vocabulary, pre_token, cache)
    df = df.withColumn(text, F.col(text).cast("string"))
    fields = [T.StructField(out, T.ArrayType(T.IntegerType(), False), False)]
    if decoded:
        fields.append(T.StructField(decoded, T.BinaryType(), False))

    def block(batch: pa.RecordBatch, texts: list[str]) -> dict:
        encoder = held(key, lambda: BlockEncoder(parse_ranks(content.value), pre_token, cache))
        coded = encoder(texts)
        ends = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(coded), "<i4")))
        columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)} | {
            out: ids.cast(pa.list_(pa.field("element", pa.int32(), False)))}
        if decoded:
            columns[decoded] = _decoded(ids, encoder.replay.bytes_of)
        return columns

    return map_blocks(df, block, _with(df, *fields), chars)


def _decoded(ids: pa.Array, bytes_of: dict[int, bytes]) -> pa.Array:
    table = bytes_of.__getitem__
    return pa.array([b"".join(map(table, x.values.to_numpy().tolist())) if x.is_valid else b"" for x in ids],
                    pa.binary())


def bpe_decode(df: DataFrame, vocabulary: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes that ``ids`` stand for in column ``out``; null ids have no bytes."""
    content = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    schema = _with(df, T.StructField(out, T.BinaryType(), False))
    from pyspark.sql.pandas.types import to_arrow_schema
    target = to_arrow_schema(schema)
    ship(df.sparkSession)

    def run(batches):
        bytes_of = {i: b for b, i in parse_ranks(content.value).items()}
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                columns = dict(zip(batch.schema.names, batch.columns, strict=True)) | {
                    out: _decoded(batch.column(batch.schema.get_field_index(ids)), bytes_of)}
                yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in target],
                                                 schema=target)

    return df.mapInArrow(run, schema)


def op9_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None,
            pre_token: str | None = None) -> DataFrame:
    """Digests of the ids and of the decoded bytes of every document's whole text."""
    import public_tokenizers
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encoded_digests(read_table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary,
                           pre_token or public_tokenizers.PATTERN)


def encoded_digests(docs: DataFrame, vocabulary: str, pre_token: str, cache: int = CACHE_ENTRIES,
                    chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, n_tokens and digests of each document's ids and of the bytes decoded from them."""
    return bpe_encode(docs.select("doc_id", "text"), vocabulary, pre_token, decoded="decoded", cache=cache, chars=chars).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
