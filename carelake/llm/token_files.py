"""Token-id files: canonical length-limited Huffman coding from global counts.

``write_ids`` stores documents' ids in ascending ``doc_id`` order as a folder
of two Parquet tables, so that any store Spark writes to can hold them:

* ``codebook`` (id, bits): code length of every id that occurs. Codes are
  canonical: ordered by length, then id.
* ``blocks`` (part, first_row, before, doc_ids, sizes, checkpoints, payload):
  independent runs of documents. ``payload`` holds the codes, first bit
  highest; ``checkpoints`` has the bit offset of every ``STEP``-th id as
  little-endian unsigned 32-bit integers, so a decoder can begin at any of
  them. ``part`` and ``first_row`` give the order of blocks, ``before`` the
  ids before the block in its part, ``sizes`` the ids of each document.

``read_ids`` decodes a block with one table of all ``limit``-bit windows,
stepping through all stretches between checkpoints at once.

Code lengths come from counts over all documents (one count per id of the
vocabulary reaches the driver) by package-merge, at most ``LIMIT`` bits.

Defined cases: null or empty texts have the end id alone; null doc_ids come
first; repeated rows are all kept, ties in doc_id are ordered by text; an empty table gives an
empty codebook and no blocks; a very long text is encoded whole, in a block of
its own; other columns of the input are not read.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from carelake.session import work_dir

from .bpe import read_vocabulary
from .common import cut, held, read_table, ship, text_blocks

#: Longest code in bits (more, if the vocabulary needs it).
LIMIT = 20
#: Ids between two checkpoints.
STEP = 256
#: Ids that are packed into bits at a time.
STRETCH = 1 << 16
#: Ids in a block, at most (a longer document is a block of its own).
BLOCK_IDS = 1 << 20
#: The id after each document.
END_ID = 0
#: Pieces of text that a Python worker remembers (more if one block has more).
CACHE_ENTRIES = 1_000_000
#: Characters of text whose distinct pieces are looked up at a time.
ENCODE_CHARS = 16_000_000
#: Characters of text that are cut into pieces at a time.
CUT_CHARS = 1_000_000

ID_SCHEMA = "doc_id long, part long, row long, before long, n_tokens long, ids binary"
BLOCK_SCHEMA = ("part long, first_row long, before long, doc_ids array<long>, sizes array<long>, "
                "checkpoints binary, payload binary")


# ---------------------------------------------------------------- encoding texts

# Characters other than white space that every version of Unicode puts in one class and that ``re`` and the library
# class alike.
_COMMON = "!-~\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u04ff\u2010-\u2027\u2030-\u205e\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5"
#: All but them and common white space.
_ODD = re.compile(f"[^\\t\\n\\r\\x20{_COMMON}]")
#: A space and a word of common characters (for Arrow): as a piece, one match of the pattern.
_WORD = f"^ [{_COMMON}]+$"


def byte_level_table() -> dict[str, int]:
    """The byte for which each character stands in byte-level vocabularies, by their rule: printable ones stand for
    themselves, characters from 256 on for the others in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class KnownPieces:
    """Pieces and their ids as Arrow columns, which hold many in little memory.

    With more than ``size`` of them, only those of the block at hand stay, so the memory of a worker does not grow
    with the corpus.
    """

    def __init__(self, size: int):
        self.size, self.pieces, self.ids = size, pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def look_up(self, pieces: pa.LargeStringArray, learn: Callable) -> pa.LargeBinaryArray:
        """Ids of distinct ``pieces``; ``learn`` gives those of new ones."""
        at = pc.index_in(pieces, value_set=self.pieces)
        new = at.is_null()
        fresh, place = pieces.filter(new), at.fill_null(0).to_numpy().astype(np.int64)
        place[new.to_numpy(zero_copy_only=False)] = len(self.pieces) + np.arange(len(fresh))
        if len(fresh):
            self.ids = pa.concat_arrays([self.ids, learn(fresh)])
            self.pieces = pa.concat_arrays([self.pieces, fresh])
        out = self.ids.take(pa.array(place))
        if len(self.pieces) > self.size:
            self.pieces, self.ids = pieces, out
        return out


class LibraryEncoder:
    """Encodes texts with a tokenizers file; matches of its pre-tokenizer never share a token and are encoded once.

    All texts of a call are cut into matches of the pre-tokenizer's pattern (``piece_column``), whose distinct ones are
    looked up; what has odd characters stays whole, up to a space with a non-space after it.
    New pieces that are a space and a word go to the library's model, which is all that the library does with a match
    once its bytes are shown as characters; others go to the library whole.
    With ``plain``, special tokens' strings are ordinary text.
    """

    def __init__(self, content: bytes, plain: bool = False, entries: int = CACHE_ENTRIES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for every core
        from tokenizers import Tokenizer
        text = content.decode()
        self.tokenizer = Tokenizer.from_str(text)
        self.tokenizer.encode_special_tokens = plain
        spec = json.loads(text)
        pre = spec.get("pre_tokenizer") or {}
        self.by_match = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                         and not pre.get("add_prefix_space") and not spec.get("normalizer"))
        self.added = [] if plain else [t["content"] for t in spec.get("added_tokens") or []]
        self.known = KnownPieces(entries)
        self.width = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.signs = np.zeros(256, "<u4")  # the character that shows each byte
        for char, byte in byte_level_table().items():
            self.signs[byte] = ord(char)

    def _library(self, texts: list[str]) -> list[bytes]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ends = np.cumsum([len(x) for x in ids]).tolist()
        data = np.fromiter(chain.from_iterable(ids), self.width, ends[-1] if ends else 0).tobytes()
        size = np.dtype(self.width).itemsize
        return [data[size * a:size * b] for a, b in zip([0, *ends], ends)]

    def _words(self, words: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Ids of words, each one match of the pattern."""
        at = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2], np.uint8)[at[0]:at[-1]]
        shown, tokenize = self.signs[data].tobytes().decode("utf-32-le"), self.tokenizer.model.tokenize
        ids, ends = [], [0]
        for a, b in pairwise((at - at[0]).tolist()):
            ids += [t.id for t in tokenize(shown[a:b])]
            ends.append(len(ids))
        packed = np.array(ids, self.width)
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(words), [None, pa.py_buffer(packed.itemsize * np.array(ends)), pa.py_buffer(packed)])

    def _learn(self, pieces: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Ids of new pieces."""
        simple = pc.match_substring_regex(pieces, _WORD)
        words, alone = pieces.filter(simple), pieces.filter(pc.invert(simple)).to_pylist()
        found = [self._words(words)] if len(words) else []
        if alone:
            found.append(pa.array(self._library(alone), pa.large_binary()))
        order = np.argsort(~simple.to_numpy(zero_copy_only=False), kind="stable")  # words first
        return pa.concat_arrays(found).take(pa.array(np.argsort(order)))

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian integers of ``width``."""
        if not self.by_match:
            return self._library(texts)
        whole = {k for k, t in enumerate(texts) if any(a in t for a in self.added)}
        texts_cut = ["" if k in whole else t for k, t in enumerate(texts)] if whole else texts
        # Arrays with an entry for each character are made for some texts at a time.
        some = np.cumsum([0, *map(len, texts)]) // CUT_CHARS
        borders = [*np.flatnonzero(np.diff(some[:-1], prepend=-1)).tolist(), len(texts)]
        parts = [piece_column(texts_cut[a:b]) for a, b in pairwise(borders)]
        coded = pa.chunked_array([p for p, _ in parts], pa.large_string()).dictionary_encode()
        if len(coded):
            known = self.known.look_up(coded.chunk(0).dictionary, self._learn)
        indices, begun, out = pa.chunked_array([c.indices for c in coded.chunks], pa.int32()), 0, []
        for pieces, ends in parts:
            if not len(pieces):
                out += [b""] * (len(ends) - 1)
                continue
            ids = known.take(indices.slice(begun, len(pieces)).combine_chunks())
            at = np.frombuffer(ids.buffers()[1], np.int64)[ends].tolist()
            data = ids.buffers()[2].to_pybytes() if at[-1] else b""
            out += [data[a:b] for a, b in pairwise(at)]
            begun += len(pieces)
        for k in whole:
            out[k] = self._library([texts[k]])[0]
        return out


#: Classes of characters: letters, numbers, others, white space, and odd ones that are or are not white space.
_LETTER, _NUMBER, _OTHER, _SPACE, _ODD_CHAR, _ODD_SPACE = range(6)


def _class_of(char: str) -> int:
    if _ODD.match(char):
        return _ODD_SPACE if char.isspace() or char in "\u180e" else _ODD_CHAR
    return _SPACE if char.isspace() else _LETTER if char.isalpha() else _NUMBER if char.isdecimal() else _OTHER


#: By code point; all from here on are odd and no white space.
_CLASSES = np.array([_class_of(chr(c)) for c in range(0x9FA6)] + [_ODD_CHAR], np.uint8)
# Fixed value: what the pattern takes after an apostrophe.
_SUFFIXES = [[ord(c) for c in x] for x in ("s", "t", "re", "ve", "m", "ll", "d")]


def piece_column(texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The matches of the pattern in all texts, and where each text's begin; the last entry is the number of all.

    Between a space with a non-space after it and what stands before it, every match ends. Such a chunk stays
    whole if it has an odd character.
    """
    text = "".join(texts)
    edges = np.cumsum([0, *map(len, texts)])
    size = len(text)
    if not size:
        return pa.array([], pa.large_string()), np.zeros(len(edges), np.int64)
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kind = _CLASSES[np.minimum(codes, len(_CLASSES) - 1)]
    first = np.zeros(size + 1, bool)
    first[edges[:-1]] = True
    first = first[:size]
    last = np.append(first[1:], True)
    blank, white = codes == 0x20, (kind == _SPACE) | (kind == _ODD_SPACE)
    before = np.append(np.uint8(_SPACE), kind[:-1])
    # White space before something else is a match of its own, if it is not the space that begins the next one.
    ends_white = white & ~last & ~np.append(white[1:], True)
    begins = first | ends_white | (kind != before) & ~np.append(False, blank[:-1] & ~last[:-1] & ~white[1:])
    marks = np.flatnonzero((codes == 0x27) & ~last & (first | (before <= _NUMBER) | (before == _SPACE) & ~np.append(True, blank[:-1])))
    for suffix in _SUFFIXES:
        at = marks[marks + len(suffix) < size]
        for k, c in enumerate(suffix):
            at = at[(codes[at + k + 1] == c) & ~first[at + k + 1]]
        begins[at + 1] = False
        after = at + len(suffix) + 1
        begins[after[after < size]] = True
    if kind.max() >= _ODD_CHAR:
        chunks = first | blank & ends_white
        starts = np.flatnonzero(chunks)
        odd = np.repeat(np.logical_or.reduceat(kind >= _ODD_CHAR, starts), np.diff(starts, append=size))
        begins = np.where(odd, chunks, begins)
    starts = np.flatnonzero(begins)
    data, offsets = text.encode(), np.append(starts, size)
    if len(data) > size:
        wide = (codes >= 0x80).astype(np.uint8) + (codes >= 0x800) + (codes >= 0x10000)
        offsets[1:] += np.cumsum(wide, dtype=np.int64)[offsets[1:] - 1]
    return (pa.LargeStringArray.from_buffers(len(starts), pa.array(offsets).buffers()[1], pa.py_buffer(data)),
            np.searchsorted(starts, edges))


def token_ids(docs: DataFrame, vocabulary: str, end_id: int | None = END_ID) -> DataFrame:
    """Ids of every document, in ascending doc_id order within and between the parts.

    Columns: doc_id, part (ascending with doc_id), row (place in the part),
    before (ids before it in the part), n_tokens, ids (unsigned little-endian
    integers of 16 bits if the vocabulary allows, else 32).
    """
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    ship(docs.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema
    target = to_arrow_schema(T._parse_datatype_string(ID_SCHEMA))

    def run(batches):
        part, row, before = TaskContext.get().partitionId(), 0, 0
        for batch, texts in text_blocks(batches, chars=ENCODE_CHARS):
            encoder = held(("library", vocabulary), lambda: LibraryEncoder(content.value))
            tail = b"" if end_id is None else np.array([end_id], encoder.width).tobytes()
            ids = [x + tail for x in encoder(texts)]
            sizes = np.array([len(x) for x in ids], np.int64) // np.dtype(encoder.width).itemsize
            ends = before + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.int64()), pa.array(np.full(len(ids), part)),
                pa.array(np.arange(row, row + len(ids))), pa.array(ends - sizes), pa.array(sizes),
                pa.array(ids, pa.binary())], schema=target)
            row, before = row + len(ids), int(ends[-1])

    text = F.col("text").cast("string")
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
               .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text"))
    return ordered.mapInArrow(run, ID_SCHEMA)


# ---------------------------------------------------------------- the code

def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Package-merge: lengths (at most ``limit``) of the best prefix code for ascending ``counts``."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} ids need codes of more than {limit} bits")
    levels, packages = [], np.empty(0)
    for _ in range(limit):
        merged = np.concatenate([counts, packages])
        order = np.argsort(merged, kind="stable")
        levels.append(order < n)
        merged = merged[order][:len(merged) // 2 * 2]
        packages = merged[::2] + merged[1::2]
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(levels):
        leaves = int(leaf[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    return lengths


def canonical(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids by (length, id), their lengths and codes."""
    order = np.lexsort((ids, lengths))
    ids, lengths = ids[order], lengths[order]
    if not len(ids):
        return ids, lengths, ids
    longest = int(lengths[-1])
    steps = 1 << (longest - lengths)
    return ids, lengths, (np.cumsum(steps) - steps) >> (longest - lengths)


class Codec:
    """Codes and the window table of one codebook."""

    def __init__(self, ids, lengths):
        ids, lengths, codes = canonical(np.asarray(ids, np.int64), np.asarray(lengths, np.int64))
        self.longest = int(lengths[-1]) if len(ids) else 0
        size = int(ids.max()) + 1 if len(ids) else 0
        self.code, self.bits = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code[ids], self.bits[ids] = codes, lengths
        windows = 1 << (self.longest - lengths) if len(ids) else ids
        self.window_id = np.repeat(ids, windows).astype(np.uint32)
        self.window_bits = np.repeat(lengths, windows).astype(np.uint8)
        #: One id alone has the code 0, and no code begins with 1.
        if len(ids) == 1:
            self.window_id, self.window_bits = np.repeat(self.window_id, 2), np.repeat(self.window_bits, 2)

    def encode(self, ids: np.ndarray, step: int = STEP) -> tuple[bytes, bytes]:
        """The payload and its checkpoints."""
        # Stretches of ids whose arrays stay in the processor's cache; ``total`` bits lie before each.
        stretch, total, checkpoints = step * max(STRETCH // step, 1), 0, []
        out = np.zeros((len(ids) * self.longest + 63) // 32 + 2, np.uint32)
        for k in range(0, len(ids), stretch):
            part = ids[k:k + stretch]
            bits = self.bits[part]
            ends = np.cumsum(bits) + total
            starts = ends - bits
            # Each code lies in two 32-bit words at most; codes don't overlap, so sums are unions.
            wide = self.code[part] << (64 - bits - (starts & 31)).astype(np.uint64)
            first = total >> 5
            at = (starts >> 5) - first
            words = np.bincount(at, (wide >> np.uint64(32)).astype(float), int(at[-1]) + 2)
            words += np.bincount(at + 1, (wide & np.uint64(0xFFFFFFFF)).astype(float))
            out[first:first + len(words)] += words.astype(np.uint32)
            checkpoints.append(starts[::step].astype("<u4"))
            total = int(ends[-1])
        words = (total + 63) // 32 + 1 if len(ids) else 1
        return out[:words].astype(">u4").tobytes(), b"".join([c.tobytes() for c in checkpoints])

    def decode(self, payload: bytes, checkpoints: bytes, n: int, step: int = STEP) -> np.ndarray:
        out = np.empty((step, -(-n // step)), np.uint32)
        at = np.frombuffer(checkpoints, "<u4").astype(np.int64)
        words = np.frombuffer(payload, ">u4").astype(np.uint64)
        words = np.concatenate([words, np.zeros(2, np.uint64)])
        pairs = (words[:-1] << np.uint64(32)) | words[1:]
        shift, last = 64 - self.longest, len(pairs) - 1
        mask = np.uint64((1 << self.longest) - 1)
        for k in range(step):
            window = (pairs[np.minimum(at >> 5, last)] >> (shift - (at & 31)).astype(np.uint64)) & mask
            out[k] = self.window_id[window]
            at += self.window_bits[window]
        return out.T.reshape(-1)[:n]


def id_counts(ids: DataFrame) -> DataFrame:
    """How often each id occurs in all documents: summed in each task first."""
    ship(ids.sparkSession)

    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                texts = [_ids(x.as_buffer(), n) for x, n in zip(part.column(0), part.column(1).to_pylist(), strict=True)]
                count = np.bincount(np.concatenate(texts), minlength=len(total))
                count[:len(total)] += total
                total = count
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "count"])

    return (ids.select("ids", "n_tokens").mapInArrow(run, "id long, count long")
            .groupBy("id").agg(F.sum("count").alias("count")))


def _ids(data, n: int) -> np.ndarray:
    return np.frombuffer(data, "<u4" if n and len(data) // n == 4 else "<u2")


# ---------------------------------------------------------------- files

def write_ids(ids: DataFrame, path: str, limit: int = LIMIT) -> None:
    """Write what ``token_ids`` returned; ``ids`` is read twice."""
    spark = ids.sparkSession
    ship(spark)
    counts = id_counts(ids).orderBy("count", "id").toPandas()  # one row per id of the vocabulary
    limit = max(limit, int(np.ceil(np.log2(max(len(counts), 2)))))
    lengths = code_lengths(counts["count"].to_numpy(float), limit)
    book = spark.createDataFrame(list(zip(counts["id"].tolist(), lengths.tolist(), strict=True)), "id long, bits int")
    book.coalesce(1).write.parquet(f"{path}/codebook")
    code = spark.sparkContext.broadcast((counts["id"].to_numpy(), lengths))

    def run(batches):
        codec = Codec(*code.value)
        for batch in batches:
            part, row, before, sizes = (batch.column(batch.schema.get_field_index(c)).to_numpy()
                                        for c in ("part", "row", "before", "n_tokens"))
            data = batch.column(batch.schema.get_field_index("ids"))
            run_of = np.concatenate([[0], np.cumsum((np.diff(part) != 0) | (np.diff(row) != 1))])
            start = 0
            while start < len(part):
                stop = start + int(np.searchsorted(np.cumsum(sizes[start:]), BLOCK_IDS, "right"))
                stop = max(min(stop, int(np.searchsorted(run_of, run_of[start], "right"))), start + 1)
                ids = np.concatenate([_ids(data[k].as_buffer(), int(sizes[k])) for k in range(start, stop)])
                payload, checkpoints = codec.encode(ids)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part[start]]), pa.array([row[start]]), pa.array([before[start]]),
                    pa.array([batch.column(0).slice(start, stop - start).to_pylist()], pa.list_(pa.int64())),
                    pa.array([sizes[start:stop].tolist()], pa.list_(pa.int64())),
                    pa.array([checkpoints], pa.binary()), pa.array([payload], pa.binary())],
                    names=["part", "first_row", "before", "doc_ids", "sizes", "checkpoints", "payload"])
                start = stop

    (ids.select("doc_id", "part", "row", "before", "n_tokens", "ids").mapInArrow(run, BLOCK_SCHEMA)
     .write.option("compression", "uncompressed").parquet(f"{path}/blocks"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit)."""
    ship(spark)
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    book = spark.read.schema("id long, bits int").parquet(f"{path}/codebook").toPandas()  # one row per id
    code = spark.sparkContext.broadcast((book["id"].to_numpy(), book["bits"].to_numpy()))
    # One row per part, and there are as many parts as write_ids had tasks: the ids before each.
    size = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    parts = blocks.groupBy("part").agg(F.sum(size).alias("n")).orderBy("part").toPandas()
    first = spark.sparkContext.broadcast(
        dict(zip(parts["part"].tolist(), (parts["n"].cumsum() - parts["n"]).tolist(), strict=True)))

    def run(batches):
        codec = Codec(*code.value)
        for batch in batches:
            for block in batch.to_pylist():
                sizes = np.array(block["sizes"], np.int64)
                ends = np.cumsum(sizes)
                ids = codec.decode(block["payload"], block["checkpoints"], int(ends[-1]))
                offsets = pa.array(np.concatenate([[0], 4 * ends]), pa.int64())
                data = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(sizes), [None, offsets.buffers()[1], pa.py_buffer(ids.astype("<u4"))])
                start = first.value[block["part"]] + block["before"] + ends - sizes
                yield pa.RecordBatch.from_arrays([
                    pa.array(block["doc_ids"], pa.int64()), pa.array(start), pa.array(sizes),
                    data.cast(pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def op8_token_files(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Ids of every document's whole text, written to files and read back; their place and checksum."""
    import public_tokenizers
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    path = work_dir(spark, "token_files")
    write_ids(cut(token_ids(docs, vocabulary), "token_ids"), path)
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
