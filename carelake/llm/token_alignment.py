"""Alignment of two tokenizers' tokens by products of sparse incidence matrices.

A text with a space before it is cut into tokens by a byte-level BPE (A) and by a piece model (B). Both
partition the same bytes, so each has an incidence matrix of tokens and bytes. The matrices are
in compressed sparse rows (``CSR``), built by hand from token lengths:

* ``A Bᵀ`` by Gustavson's row products has an entry for every pair of tokens whose
  byte ranges overlap, its value the number of shared bytes: the overlap links;
* bytes at which both have a token end cut them into groups. The product of the incidence of A's
  tokens and groups with that of groups and B's tokens has an entry for
  every pair in one group: the shared-group links. There may be many in a long
  group, so the query only counts them (the symbolic phase of the product).

Documents are taken in blocks of bounded size; the product of a long text is summed over slices of
its bytes. A block keeps each of its distinct id pairs once, with the number of its
documents that hold it; links are places in that list. The corpus-wide count of a pair is a
sum by pair over the blocks, so rows shuffled are distinct pairs of blocks, not links, and only
one number per id of A is broadcast (bounded by its vocabulary). Counts come back to a block by its number.

Defined cases: null and empty texts, and texts that A or B don't reproduce byte by byte (such as
those with U+2581), have no tokens: zeros and an empty digest; special tokens' strings are plain
text; repeated rows count as documents each; a null doc_id is kept; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .bpe import read_vocabulary
from .common import cut, held, read_table, ship, text_blocks
from .ranked_search import pack, unpack
from .token_files import LibraryEncoder, byte_level_table

#: Bytes that one product of incidence matrices goes over.
SLICE = 250_000
#: Characters of a block of documents, but for one longer text.
BLOCK = 1_500_000

BLOCK_SCHEMA = ("block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
                "n_shared array<long>, n_links array<long>, digests array<string>, links binary, "
                "pair_a array<int>, pair_b array<int>, pair_docs array<int>")


# ---------------------------------------------------------------- sparse matrices

@dataclass
class CSR:
    """Row r has the entries ``indices[indptr[r]:indptr[r + 1]]``, ascending, with their ``data``."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.indptr))

    def transposed(self) -> CSR:
        count = np.bincount(self.indices, minlength=self.columns)
        order = np.argsort(self.indices, kind="stable") if np.any(np.diff(self.indices) < 0) else slice(None)
        return CSR(np.concatenate([[0], np.cumsum(count)]), self.row_of()[order], self.data[order], self.rows)


def products(a: CSR, b: CSR) -> np.ndarray:
    """Symbolic phase: how many products each row of ``a b`` sums (its entries, if no two meet)."""
    width = np.diff(b.indptr)[a.indices]
    return np.bincount(a.row_of(), width, a.rows).astype(np.int64)


def gustavson(a: CSR, b: CSR) -> CSR:
    """``a b`` by rows: row i is the sum over its entries k of ``a[i, k]`` times row k of ``b``."""
    width = np.diff(b.indptr)[a.indices]
    entry = np.repeat(np.arange(len(a.indices)), width)
    within = np.arange(len(entry)) - np.repeat(np.cumsum(width) - width, width)
    source = b.indptr[a.indices][entry] + within
    return merged(a.row_of()[entry], b.indices[source], a.data[entry] * b.data[source], a.rows, b.columns)


def merged(row: np.ndarray, column: np.ndarray, value: np.ndarray, rows: int, columns: int) -> CSR:
    """A matrix from entries, those of one place added up."""
    key = row * columns + column
    if np.any(np.diff(key) < 0):
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    key, value = key[first], np.add.reduceat(value, first) if len(first) else value
    indptr = np.concatenate([[0], np.cumsum(np.bincount(key // max(columns, 1), minlength=rows))])
    return CSR(indptr, key % max(columns, 1), value, columns)


def byte_incidence(ends: np.ndarray, low: int, high: int) -> tuple[int, CSR]:
    """Tokens with bytes in ``[low, high)``, from the first of them, by those bytes."""
    first, last = np.searchsorted(ends, low, "right"), np.searchsorted(ends, high, "left") + 1
    indptr = np.concatenate([[0], np.minimum(ends[first:last], high) - low])
    return int(first), CSR(indptr, np.arange(high - low), np.ones(high - low, np.int64), high - low)


def overlap_links(a_ends: np.ndarray, b_ends: np.ndarray, step: int = SLICE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of A and of B that share bytes, and how many: A times B transposed, summed over slices of the bytes."""
    size = int(a_ends[-1]) if len(a_ends) else 0
    found = []
    for low in range(0, size, step):
        first_a, a = byte_incidence(a_ends, low, min(low + step, size))
        first_b, b = byte_incidence(b_ends, low, min(low + step, size))
        part = gustavson(a, b.transposed())
        found.append((part.row_of() + first_a, part.indices + first_b, part.data))
    if not found:
        return (np.empty(0, np.int64),) * 3
    whole = merged(*map(np.concatenate, zip(*found, strict=True)), len(a_ends), len(b_ends))
    return whole.row_of(), whole.indices, whole.data


def group_incidence(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, CSR, CSR]:
    """Where groups end, and the incidence of A's tokens and of B's with the groups."""
    cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
    return (cuts, *[CSR(np.arange(len(ends) + 1), np.searchsorted(cuts, ends), np.ones(len(ends), np.int64), len(cuts))
                    for ends in (a_ends, b_ends)])


# ---------------------------------------------------------------- tokens

class Tokenizers:
    """Both tokenizers, from the contents of their files, and the bytes of their tokens."""

    def __init__(self, a: bytes, b: bytes):
        import sentencepiece
        self.a = LibraryEncoder(a, plain=True, entries=200_000)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        byte = byte_level_table()
        vocabulary = json.loads(a)["model"]["vocab"]
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else b""
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i)
                                or self.b.is_unknown(i) else piece.replace("▁", " ").encode())
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)

    def __call__(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Each text's ids by A and by B; none where the bytes of either differ from those of the text."""
        of_a, of_b = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        none = np.empty(0, np.int64)
        out = []
        for text, a, b in zip(texts, self.a([" " + t for t in texts]), self.b.encode(texts, num_threads=1), strict=True):
            a, want = np.frombuffer(a, self.a.width).astype(np.int64), b" " + text.encode()
            same = text and b"".join(map(of_a, a.tolist())) == want and b"".join(map(of_b, b)) == want
            out.append((a, np.array(b, np.int64)) if same else (none, none))
        return out


_DIGITS = np.array([[ord(c) for c in str(i).ljust(10, "\0")] for i in range(1 << 16)], np.uint8)
_WIDTH = np.array([len(str(i)) for i in range(1 << 16)], np.int64)


def groups_text(a_ids, b_ids, a_groups, b_groups, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2;`` of all groups as bytes, and where each group ends in them."""
    if max(a_ids.max(initial=0), b_ids.max(initial=0)) >= len(_WIDTH):
        raise ValueError(f"ids from {len(_WIDTH)} on are not written here")
    n_a, n_b = np.bincount(a_groups, minlength=groups), np.bincount(b_groups, minlength=groups)
    before_a, before_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    ids = np.empty(len(a_ids) + len(b_ids), np.int64)
    separator = np.full(len(ids), ord(","), np.uint8)
    ids[np.arange(len(a_ids)) + before_b[a_groups]] = a_ids
    ids[np.arange(len(b_ids)) + (before_a + n_a)[b_groups]] = b_ids
    separator[before_a + before_b + n_a - 1] = ord("|")
    separator[before_a + before_b + n_a + n_b - 1] = ord(";")
    width = _WIDTH[ids]
    cells = np.concatenate([_DIGITS[ids, :5], np.zeros((len(ids), 1), np.uint8)], 1)
    cells[np.arange(len(ids)), width] = separator
    ends = np.cumsum(width + 1)
    return cells[np.arange(6) <= width[:, None]], ends[before_a + before_b + n_a + n_b - 1]


@dataclass
class Aligned:
    """A block of documents, their tokens one after the other."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_sizes: np.ndarray       # tokens of each document
    b_sizes: np.ndarray
    cuts: np.ndarray          # where groups end, in bytes
    group_a: CSR
    group_b: CSR
    links: tuple[np.ndarray, np.ndarray, np.ndarray]
    byte_ends: np.ndarray     # of each document

    def document_of(self, a_tokens: np.ndarray) -> np.ndarray:
        return np.repeat(np.arange(len(self.a_sizes)), self.a_sizes)[a_tokens]


def align_block(tokenizers: Tokenizers, texts: list[str]) -> Aligned:
    tokens = tokenizers(texts)
    a_ids, b_ids = (np.concatenate([t[k] for t in tokens]) if tokens else np.empty(0, np.int64) for k in (0, 1))
    a_ends, b_ends = np.cumsum(tokenizers.a_sizes[a_ids]), np.cumsum(tokenizers.b_sizes[b_ids])
    a_sizes, b_sizes = (np.array([len(t[k]) for t in tokens], np.int64) for k in (0, 1))
    byte_ends = np.concatenate([[0], a_ends])[np.cumsum(a_sizes)]
    cuts, group_a, group_b = group_incidence(a_ends, b_ends)
    return Aligned(a_ids, b_ids, a_sizes, b_sizes, cuts, group_a, group_b, overlap_links(a_ends, b_ends), byte_ends)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of runs of the given sizes."""
    ends = np.cumsum(sizes)
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends] - total[ends - sizes]


def _block_row(block: int, ids: list, x: Aligned) -> dict:
    link_a, link_b, _ = x.links
    document = x.document_of(link_a)
    n = len(ids)
    n_links = np.bincount(document, minlength=n)
    n_groups = np.diff(np.searchsorted(x.cuts, x.byte_ends, "right"), prepend=0)
    text, ends = groups_text(x.a_ids, x.b_ids, x.group_a.indices, x.group_b.indices, len(x.cuts))
    text, stops = text.tobytes(), np.concatenate([[0], ends])[np.cumsum(n_groups)].tolist()
    digests = [hashlib.sha256(text[a:b - 1]).hexdigest() if b > a else ""
               for a, b in zip([0, *stops], stops)]
    # Each distinct pair once, the frequent first, and the documents that hold it.
    key = x.a_ids[link_a] << 32 | x.b_ids[link_b]
    order = np.argsort(key, kind="stable")
    new = np.diff(key[order], prepend=-1) != 0
    first = np.flatnonzero(new)
    holds = np.add.reduceat((new | (np.diff(document[order], prepend=-1) != 0)).astype(np.int32), first) if len(first) else first
    by_number = np.argsort(-np.diff(first, append=len(key)), kind="stable")
    rank = np.empty(len(first), np.int64)
    rank[by_number] = np.arange(len(first))
    place = np.empty(len(key), np.int64)
    place[order] = rank[np.cumsum(new) - 1]
    pairs = key[order][first][by_number]
    return {"block": block, "doc_ids": ids, "n_a": x.a_sizes.tolist(), "n_b": x.b_sizes.tolist(),
            "n_groups": n_groups.tolist(), "n_links": n_links.tolist(),
            "n_shared": _sums(products(x.group_a, x.group_b.transposed()), x.a_sizes).tolist(),
            "digests": digests, "links": pack(place)[0].tobytes(), "pair_a": (pairs >> 32).astype(np.int32),
            "pair_b": (pairs & 0xFFFFFFFF).astype(np.int32), "pair_docs": holds[by_number].astype(np.int32)}


def _prepare(docs: DataFrame, a: str, b: str):
    """The columns read, and what makes the tokenizers in a task."""
    spark = docs.sparkSession
    ship(spark)
    content = spark.sparkContext.broadcast((read_vocabulary(a), read_vocabulary(b)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows, lambda: held(("alignment", a, b), lambda: Tokenizers(*content.value))


def align(docs: DataFrame, a: str, b: str, shared: bool = False) -> DataFrame:
    """doc_id, ids ``a`` and ``b``, each token's group (``a_group``, ``b_group``) and ``links``: places of the linked
    tokens in their document and the bytes they share. With ``shared``, also ``shared_links``: the places of all
    pairs of tokens in one group."""
    rows, tokenizers = _prepare(docs, a, b)
    schema = ("doc_id long, a array<int>, b array<int>, a_group array<int>, b_group array<int>, "
              "links array<struct<a:int,b:int,bytes:int>>" + (", shared_links array<struct<a:int,b:int>>" if shared else ""))

    def run(batches):
        for batch, texts in text_blocks(batches, chars=BLOCK // 4):
            x = align_block(tokenizers(), texts)
            a_start, b_start = np.cumsum(x.a_sizes) - x.a_sizes, np.cumsum(x.b_sizes) - x.b_sizes
            out = []
            document = x.document_of(x.links[0])
            both = gustavson(x.group_a, x.group_b.transposed()) if shared else None
            for k, i in enumerate(batch.column(0).to_pylist()):
                s, t = slice(a_start[k], a_start[k] + x.a_sizes[k]), slice(b_start[k], b_start[k] + x.b_sizes[k])
                mine = slice(*np.searchsorted(document, [k, k + 1]))
                base = x.group_a.indices[s][0] if x.a_sizes[k] else 0
                row = {"doc_id": i, "a": x.a_ids[s], "b": x.b_ids[t], "a_group": x.group_a.indices[s] - base,
                       "b_group": x.group_b.indices[t] - base,
                       "links": [{"a": int(p), "b": int(q), "bytes": int(n)} for p, q, n in zip(
                           x.links[0][mine] - a_start[k], x.links[1][mine] - b_start[k], x.links[2][mine], strict=True)]}
                if shared:
                    pairs = slice(both.indptr[s.start], both.indptr[s.stop])
                    row["shared_links"] = [{"a": int(p), "b": int(q)} for p, q in zip(
                        both.row_of()[pairs] - a_start[k], both.indices[pairs] - b_start[k], strict=True)]
                out.append(row)
            yield pa.RecordBatch.from_pylist(out, schema=target)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql import types as T
    target = to_arrow_schema(T._parse_datatype_string(schema))
    return rows.mapInArrow(run, schema)


def alignment_digests(docs: DataFrame, a: str, b: str, block_chars: int = BLOCK) -> DataFrame:
    """Per document the sizes of its alignment, how common its links' id pairs are, and the digest of its groups."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema
    rows, tokenizers = _prepare(docs, a, b)
    target = to_arrow_schema(T._parse_datatype_string(BLOCK_SCHEMA))

    def run(batches):
        made = TaskContext.get().partitionId() << 32
        for batch, texts in text_blocks(batches, chars=block_chars):
            row = _block_row(made, batch.column(0).to_pylist(), align_block(tokenizers(), texts))
            yield pa.RecordBatch.from_pylist([row], schema=target)
            made += 1

    blocks = cut(rows.mapInArrow(run, BLOCK_SCHEMA), "alignment")
    pairs = blocks.select("block", F.posexplode(F.arrays_zip("pair_a", "pair_b", "pair_docs")).alias("place", "p"))
    total = F.sum("p.pair_docs").over(Window.partitionBy("p.pair_a", "p.pair_b"))
    counted = cut(pairs.select("block", "place", F.col("p.pair_a").alias("a"), total.alias("count")), "pair-counts")
    highest = counted.groupBy("a").agg(F.max("count").alias("highest"))  # one row per id of A
    counted = (counted.join(F.broadcast(highest), "a")
               .select("block", "place", "count", (F.col("count") == F.col("highest")).alias("best")))

    def digest(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return out_schema.empty_table()
        row = left.to_pylist()[0]
        sizes = np.array(row["n_links"], np.int64)
        count, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        place = right.column("place").to_numpy()
        count[place], best[place] = right.column("count").to_numpy(), right.column("best").to_numpy().astype(np.int64)
        links = unpack(row["links"])
        return pa.table([pa.array(row["doc_ids"], pa.int64()), *[pa.array(row[c], pa.int64()) for c in (
            "n_a", "n_b", "n_groups", "n_links", "n_shared")], pa.array(_sums(best[links], sizes)),
            pa.array(_sums(count[links], sizes)), pa.array(row["digests"], pa.string())], schema=out_schema)

    schema = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_shared long, n_best long, count_sum long, "
              "groups_sha256 string")
    out_schema = to_arrow_schema(T._parse_datatype_string(schema))
    slim = blocks.drop("pair_a", "pair_b", "pair_docs")
    return slim.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(digest, schema)


def op11_token_alignment(spark: SparkSession, sf_dir: str, a: str | None = None, b: str | None = None) -> DataFrame:
    """How the tokens of a byte-level BPE and of a piece model overlap in every document."""
    import public_tokenizers
    return alignment_digests(read_table(spark, sf_dir, "documents"),
                             a or public_tokenizers.path("byte_bpe_50k.json"),
                             b or public_tokenizers.path("piece_bpe_32k.model"))
