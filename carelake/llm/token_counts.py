"""Token counts under a unigram model by trie-shared dynamic programming.

The distinct pre-tokens of a block of documents are put in a trie. The best
score of a pre-token's first characters depends only on those characters, so
the unigram forward score (the greatest sum of piece scores that spells the
prefix) is computed once per trie node, from the nodes of the pieces that can
end there, and each terminal stores its number of pieces. A document's count is the sum over its words.

The pieces and their order come from a public sentencepiece file. Such a BPE file has
ranks rather than probabilities; a piece of rank r gets the Zipf log-probability
``-log(r + 2)``. A character that no piece spells costs its UTF-8 bytes, as
byte fallback does, at ``BYTE_SCORE`` each. Among equal scores fewer pieces win.

Pre-tokens are the words between white space, each with the word mark before
it. Spark deals out the documents; blocks are bounded, and words seen lately
stay in a bounded cache of the Python worker.

Defined cases: a null, empty or blank text has 0 words and 0 tokens; a text
of any length is counted whole; repeated rows each get a row; an empty table
gives an empty table; other columns of the input are not read.
"""

from __future__ import annotations

import math
import os
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .bpe import MAX_VOCABULARY_BYTES
from .common import RecentCache, held, map_blocks, read_table

#: Before each word.
WORD_MARK = "▁"
#: Log-probability of one byte of a character outside the vocabulary.
BYTE_SCORE = -20.0
#: Words that a Python worker remembers (twice as many at most).
CACHE_ENTRIES = 500_000


def piece_scores(path: str) -> dict[str, float]:
    """Piece to score, from a sentencepiece file; control, unknown and byte pieces apart."""
    import sentencepiece
    if (size := os.path.getsize(path)) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has {size} bytes; at most {MAX_VOCABULARY_BYTES} are broadcast")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = [model.id_to_piece(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return {p: -math.log(r + 2) for r, p in enumerate(kept)}


class TrieCounter:
    """Numbers of pieces of the best segmentations."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=0)
        self.ends = {p[-1] for p in scores if p}

    def count(self, words: Iterable[str]) -> dict[str, int]:
        """Tokens of each word. Sorted words are the trie in depth-first order: ``path`` holds the
        forward scores of the nodes from the root to where the walk stands."""
        out: dict[str, int] = {}
        scores, longest, ends = self.scores, self.longest, self.ends
        get = scores.get
        path: list[tuple[float, int]] = [(0.0, 0)]  # (score, minus the pieces) of each prefix
        last = ""
        for word in sorted(words):
            same = min(len(last), len(word))
            shared = same if last[:same] == word[:same] else next(
                k for k in range(same) if last[k] != word[k])
            del path[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                c = word[end - 1]
                best = None
                if c in ends:
                    for start in range(max(0, end - longest), end):
                        s = get(word[start:end])
                        if s is not None:
                            before, pieces = path[start]
                            here = (before + s, pieces - 1)
                            if best is None or here > best:
                                best = here
                if c not in scores:  # only bytes spell it
                    n = len(c.encode("utf-8", "surrogatepass"))
                    before, pieces = path[end - 1]
                    here = (before + n * BYTE_SCORE, pieces - n)
                    if best is None or here > best:
                        best = here
                path.append(best)
            out[word] = -path[-1][1]
            last = word
        return out


def token_counts(docs: DataFrame, scores: dict[str, float]) -> DataFrame:
    """doc_id, n_words, n_tokens of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(scores)
    key = "trie", zlib.crc32(repr(sorted(scores.items())).encode("utf-8", "surrogatepass"))
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def block(batch: pa.RecordBatch, texts: list[str]) -> dict:
        counter, cache = held(key, lambda: (TrieCounter(shared.value), RecentCache(CACHE_ENTRIES)))
        words = [t.split() for t in texts]
        seen: set[str] = set()
        for w in words:
            seen.update(w)
        known = cache.new
        new = cache.missing(seen)
        marked = counter.count([WORD_MARK + w for w in new])
        for w in new:
            known[w] = marked[WORD_MARK + w]
        counts = [sum(map(known.__getitem__, w)) for w in words]
        cache.trim()
        return {"doc_id": batch.column(0), "n_words": np.array([len(w) for w in words], np.int64),
                "n_tokens": np.array(counts, np.int64)}

    return map_blocks(docs.select("doc_id", F.col("text").cast("string").alias("text")), block, schema)


def op5_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Words and tokens of every document's whole text."""
    import public_tokenizers
    scores = piece_scores(vocabulary or public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts(read_table(spark, sf_dir, "documents"), scores)
