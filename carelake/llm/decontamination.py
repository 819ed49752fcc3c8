"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and items are compared in lower case with white space runs as one
space. Each item is covered by windows of ``WINDOW`` characters (a shorter item is one window) and by
shorter ones of ``EXCERPT - STEP + 1``, both every ``STEP`` characters and at its end. So every verbatim
excerpt of ``EXCERPT`` characters or more holds a whole window, wherever it begins, and so does a
stretch of ``WINDOW + STEP - 1`` with its edits. Of a short item three quarters (at least
``LEAST_PART`` characters) are enough; one below ``LEAST`` must be there whole. A window of m characters occurs in a
text with at most k edits only if some diagonal band holds at least
``m + 1 - Q * (k + 1)`` of the window's q-grams (the q-gram lemma). So, per block of texts:

1. all positions' q-grams are hashed and looked up among the windows' q-grams;
2. hits are sorted by text, item, band and place, and counted in each window; bands are ``BAND`` diagonals wide and overlap by half, so any
   ``BAND // 2`` neighbouring diagonals (more than k) lie in one of them;
3. bands that reach the bound are verified: a banded alignment gives the
   window's least edit distance to a stretch of the text there.

A match is a window with at most k edits, k = ``RATE`` of its length (fewer where the lemma asks). The
items' table is broadcast while the items have at most ``MAX_ITEM_CHARS``
characters; a larger benchmark is taken in several parts, each within that.

Defined cases: null and empty texts match nothing; items that are null or
shorter than ``Q`` characters (normalised), a word or two, are no evidence and match
nothing; an empty table on either side gives no match; repeated rows each get
a row, repeated items each their own match; texts are searched whole; other
columns pass through ``mark_contaminated``, replaced where names clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import BLOCK_CHARS, map_blocks, read_table, release

Q = 12
WINDOW = 100
#: Edits allowed, of a window's characters.
RATE = 0.07
#: Diagonals in a band; half of it must be more than the edits of a window.
BAND = 16
#: The shortest verbatim excerpt that is found at any place, and characters from a window to the next.
EXCERPT, STEP = 50, 10
#: Items from here on are also found by a part, of this length at least, with windows every ``PART_STEP`` characters.
LEAST, LEAST_PART, PART_STEP = 24, 20, 3
MAX_ITEM_CHARS = 32_000_000
TABLE_BITS = 22

MATCHES = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("windows", T.IntegerType()),
    T.StructField("edits", T.IntegerType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType())]))


def normalise(text: str) -> str:
    return " ".join(text.lower().split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the Q characters from each position."""
    if len(codes) < Q:
        return np.zeros(0, np.uint64)
    out, length = codes.astype(np.uint64) + np.uint64(1), 1
    base = 0x9E3779B97F4A7C15
    whole, place = None, 0  # Q in binary: joins stretches of 1, 2, 4, ... characters
    for bit in range(Q.bit_length()):
        if Q >> bit & 1:
            part = out[place:]
            whole = part if whole is None else (
                whole[:len(part)] * np.uint64(pow(base, length, 1 << 64)) + part[:len(whole)])
            place += length
        if Q >> (bit + 1):
            out = out[:-length] * np.uint64(pow(base, length, 1 << 64)) + out[length:]
            length *= 2
    return whole ^ (whole >> np.uint64(29))


@dataclass
class Windows:
    codes: np.ndarray    # all items' characters
    starts: np.ndarray   # where each item begins in them, and the end
    start: np.ndarray    # each window's place in them; first the long windows, then the short ones, either in order
    sizes: np.ndarray    # and length
    item: np.ndarray     # item id of each window
    edits: np.ndarray    # k
    least: np.ndarray    # shared q-grams that k edits leave
    n_long: int
    grams: np.ndarray    # sorted hashes of all items' q-grams
    place: np.ndarray    # and the place of each
    table: np.ndarray    # by the hash's upper bits: whether a q-gram has them

    @property
    def text(self) -> list[np.ndarray]:
        return [self.codes[s:s + m] for s, m in zip(self.start, self.sizes, strict=True)]


def excerpt_of(n: int) -> int:
    """The length from which verbatim excerpts of an item of n characters are found, at any place."""
    return min(EXCERPT, max(-(-3 * n // 4), LEAST_PART)) if n >= LEAST else n


def _starts(n: int, size: int, step: int) -> list[int]:
    starts = list(range(0, n - size + 1, step))
    return starts if starts[-1] + size == n else [*starts, n - size]


def windows_of(items: list[tuple[int, str | None]]) -> Windows:
    item, texts, long, short = [], [], [], []
    begin = 0
    for item_id, text in items:
        codes = _codes(normalise(text or ""))
        n = len(codes)
        if n < Q:
            continue
        size = min(n, WINDOW)
        long += [(begin + s, size, len(item)) for s in _starts(n, size, STEP)]
        step = STEP if excerpt_of(n) == EXCERPT else PART_STEP
        size = excerpt_of(n) - step + 1
        if n >= LEAST:
            short += [(begin + s, size, len(item)) for s in _starts(n, size, step)]
        item.append(item_id)
        texts.append(codes)
        begin += n
    start, sizes, of = np.array(long + short, np.int64).reshape(-1, 3).T
    edits = np.minimum((sizes * RATE).astype(np.int64), np.maximum(sizes // Q - 1, 0))
    grams = [gram_hashes(t) for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
    flat = np.concatenate([np.zeros(0, np.uint64), *grams])
    place = np.concatenate([np.zeros(0, np.int32), *[np.arange(a, a + len(g), dtype=np.int32) for a, g in zip(starts, grams)]])
    order = np.argsort(flat, kind="stable")
    table = np.zeros(1 << TABLE_BITS, bool)
    table[flat >> np.uint64(64 - TABLE_BITS)] = True
    return Windows(np.concatenate([np.zeros(0, "<u4"), *texts]), starts, start.astype(np.int32), sizes.astype(np.int32),
                   np.array(item, np.int64)[of], edits.astype(np.int16), (sizes + 1 - Q * (edits + 1)).astype(np.int16),
                   len(long), flat[order], place[order], table)


def find(texts: list[str], w: Windows) -> list[tuple[int, int, int, int, int]]:
    """(text, window, start, end, edits) of every window that occurs, in normalised characters."""
    codes = [_codes(normalise(t)) for t in texts]
    sizes = np.array([len(c) for c in codes], np.int64)
    starts = np.cumsum(sizes) - sizes
    whole = np.concatenate([np.zeros(0, "<u4"), *codes])
    hashes = gram_hashes(whole)
    at = np.flatnonzero(w.table[hashes >> np.uint64(64 - TABLE_BITS)])
    low = np.searchsorted(w.grams, hashes[at], "left")
    count = np.searchsorted(w.grams, hashes[at], "right") - low
    at, low, count = at[count > 0], low[count > 0], count[count > 0]
    text = np.searchsorted(starts, at, "right") - 1 if len(at) else at
    inside = at + Q <= (starts + sizes)[text]  # not across two texts
    at, low, count, text = at[inside], low[inside], count[inside], text[inside]
    if not len(at):
        return []
    # Every hit once for each place of the q-gram in the items.
    gram = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
    at, text = np.repeat(at, count), np.repeat(text, count)
    place = w.place[gram].astype(np.int64)
    item = np.searchsorted(w.starts, place, "right") - 1
    diagonal = at - starts[text] - (place - w.starts[item])
    half = BAND // 2
    band = diagonal // half
    # A hit counts in the two bands that hold its diagonal.
    key = np.stack([np.tile(text, 2), np.tile(item, 2), np.concatenate([band, band - 1]), np.tile(place, 2), np.tile(diagonal, 2)])
    key = key[:, np.lexsort(key[3::-1])]
    new = np.concatenate([[True], (np.diff(key[:3]) != 0).any(0)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], key.shape[1]) - 1
    span = len(w.codes) + 1
    spot = (np.cumsum(new) - 1) * span + key[3]  # rises
    out = []
    for a, b in ((0, w.n_long), (w.n_long, len(w.start))):
        # The windows that the q-grams of a group reach into, and how many of them each holds.
        begin, end = w.starts[key[1, first]], w.starts[key[1, first] + 1]
        from_ = np.searchsorted(w.start[a:b], np.maximum(begin, key[3, first] - (WINDOW - Q)), "left")
        to = np.searchsorted(w.start[a:b], np.minimum(end - 1, key[3, last]), "right")
        n = np.maximum(to - from_, 0)
        group = np.repeat(np.arange(len(first)), n)
        window = a + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(from_, n)
        here = group * span + w.start[window]
        low = np.searchsorted(spot, here, "left")
        kept = np.searchsorted(spot, here + w.sizes[window] - Q, "right") - low >= w.least[window]
        low, window = low[kept], window[kept]
        out += _aligned(codes, *key[:3, low], key[4, low], window, w)
    return out


def _aligned(codes, text, item, band, diagonal, window, w: Windows) -> list[tuple[int, int, int, int, int]]:
    """``diagonal``: the one of a hit, where a verbatim copy is looked for first."""
    out, rest = [], []
    begin = w.start[window] - w.starts[item]  # the window's place in its item
    for j, (t, k, s, m) in enumerate(zip(text.tolist(), window.tolist(), (begin + diagonal).tolist(),
                                         w.sizes[window].tolist(), strict=True)):
        if s >= 0 and np.array_equal(codes[t][s:s + m], w.codes[w.start[k]:w.start[k] + m]):
            out.append((t, k, s, s + m, 0))
        else:
            rest.append(j)
    text, window, low = text[rest], window[rest], (band * (BAND // 2) + begin)[rest]
    for start in range(0, len(text), 512):
        part = slice(start, start + 512)
        patterns = [w.codes[w.start[k]:w.start[k] + w.sizes[k]] for k in window[part]]
        edits, ends = banded_edits(patterns, [codes[t] for t in text[part]], low[part], BAND)
        ok = edits <= w.edits[window[part]]
        for t, k, e, end, m in zip(text[part][ok], window[part][ok], edits[ok], ends[ok], w.sizes[window[part]][ok], strict=True):
            out.append((int(t), int(k), max(int(end - m), 0), int(end), int(e)))
    return out


def banded_edits(patterns: list[np.ndarray], texts: list[np.ndarray], diagonal: np.ndarray,
                 band: int) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of each pattern against any stretch of its text that begins on a diagonal from
    ``diagonal`` to ``diagonal + band``, and where the best stretch ends. Paths may leave that range by
    ``band`` diagonals to either side."""
    n, longest = len(patterns), max(map(len, patterns))
    width = 3 * band + 1
    lo = diagonal - band  # the diagonal of column 0
    pattern = np.zeros((n, longest), np.uint32)
    sizes = np.array([len(p) for p in patterns])
    field = np.full((n, longest + width), 0xFFFFFFFF, np.uint32)  # the text from lo on; outside it nothing matches
    for k, (p, t) in enumerate(zip(patterns, texts, strict=True)):
        pattern[k, :len(p)] = p
        a, b = max(lo[k], 0), min(lo[k] + longest + width, len(t))
        if a < b:
            field[k, a - lo[k]:b - lo[k]] = t[a:b]
    columns = np.arange(width)
    far = 1 << 20
    # Row i, column c: the first i characters against stretches that end at lo + i + c.
    inside = (lo[:, None] + columns >= 0) & (lo[:, None] + columns <= np.array([len(t) for t in texts])[:, None])
    here = np.where(inside & (columns >= band) & (columns <= 2 * band), 0, far)
    result, ends = np.full(n, far), np.zeros(n, np.int64)
    lengths = np.array([len(t) for t in texts])[:, None]
    for i in range(longest):
        step = here + (field[:, i:i + width] != pattern[:, i:i + 1])
        skip = np.concatenate([here[:, 1:] + 1, np.full((n, 1), far)], axis=1)
        here = np.minimum(step, skip)
        here = np.minimum.accumulate(here - columns, axis=1) + columns
        place = lo[:, None] + i + 1 + columns
        here = np.where((place >= 0) & (place <= lengths), here, far)
        done = sizes == i + 1
        if done.any():
            best = here[done].argmin(1)
            result[done] = here[done][np.arange(len(best)), best]
            ends[done] = place[done][np.arange(len(best)), best]
    return result, ends


def original_places(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of the normalised text as spans of the text."""
    places = []
    for k, c in enumerate(text):
        if c.isspace():
            if places and places[-1][1]:
                places.append((k, False))
        else:
            places += [(k, True)] * len(c.lower())
    return [(places[min(a, len(places) - 1)][0], places[min(b, len(places)) - 1][0] + 1) for a, b in spans]


# ---------------------------------------------------------------- Spark

def _benchmark_parts(benchmark: DataFrame) -> list[list[tuple[int, str]]]:
    """The items, in parts of at most MAX_ITEM_CHARS characters (or one longer item)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // MAX_ITEM_CHARS) or 1
    if n == 1:
        return [sorted((r["item_id"] if r["item_id"] is not None else -1, r["text"]) for r in items.collect())]
    part = F.pmod(F.xxhash64("text"), F.lit(2 * n))
    return [[(r["item_id"] if r["item_id"] is not None else -1, r["text"]) for r in items.where(part == k).collect()]
            for k in range(2 * n)]


def mark_contaminated(docs: DataFrame, benchmark: DataFrame, chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with ``matches``: an array of (item_id, windows found, least edits, start, end in the text).

    A task looks at texts of about ``chars`` characters at a time (or one longer text)."""
    out = docs.drop("matches").withColumn("text", F.col("text").cast("string"))
    found = []
    for k, items in enumerate(_benchmark_parts(benchmark)):
        found.append(f"_matches{k}")
        out = _mark(out, items, found[-1], chars)
    return out.withColumn("matches", F.concat(*found)).drop(*found)


def _mark(docs: DataFrame, items: list[tuple[int, str]], name: str, chars: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(windows_of(items))
    schema = T.StructType(docs.schema.fields + [T.StructField(name, MATCHES)])
    from pyspark.sql.pandas.types import to_arrow_type
    kind = to_arrow_type(MATCHES)

    def block(batch: pa.RecordBatch, texts: list[str]) -> dict:
        w = shared.value
        release()  # of what other stages left in the worker
        matches: list[list[dict]] = [[] for _ in texts]
        by_text: dict[int, dict[int, list]] = {}
        for t, k, start, end, edits in find(texts, w) if len(w.item) else []:
            by_text.setdefault(t, {}).setdefault(int(w.item[k]), []).append((k, start, end, edits))
        for t, by_item in by_text.items():
            for item, rows in sorted(by_item.items()):
                span = min(r[1] for r in rows), max(r[2] for r in rows)
                (start, end), = original_places(texts[t], [span])
                matches[t].append({"item_id": item, "windows": len({r[0] for r in rows}),
                                   "edits": min(r[3] for r in rows), "start": start, "end": end})
        return {n: batch.column(i) for i, n in enumerate(batch.schema.names)} | {name: pa.array(matches, kind)}

    return map_blocks(docs, block, schema, chars)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for every document and benchmark item of which it holds a passage."""
    marked = mark_contaminated(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                               read_table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")
