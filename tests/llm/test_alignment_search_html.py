"""Token alignment, ranked search and HTML extraction against brute force and hand-made pages."""

import collections
import hashlib
import random
import re
from html import unescape

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import regex
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from carelake.llm import html_extraction, queries, ranked_search, token_alignment, token_files
from test_operators import ODD, empty

SF = "/root/testdata/sf0.001"
BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ODD + [(11, " \n  x\t\x1f \x85  y<|endoftext|> <s> 漢字 🙂🙂 ẞ q"), (12, "has ▁ in it"),
               (13, "  two <|endoftext|> <0x41> don't we'll 123 \n\n x "), (14, "漢字かな 🙂 ͸ ’s “q” «x» "), (15, "\n"), (16, " "),
               (17, "a" * 3000)]


def table(spark, rows, columns="doc_id long, text string"):
    return spark.createDataFrame(rows, columns)


def clashing(df, *names):
    for n in names:
        df = df.withColumn(n, F.lit("x"))
    return df


# ---------------------------------------------------------------- alignment

@pytest.fixture(scope="module")
def a_ids():
    t = Tokenizer.from_file(BYTE)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def brute_alignment(rows, a_ids):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    tok = token_alignment.Tokenizers(open(BYTE, "rb").read(), open(PIECE, "rb").read())
    seen, counts = [], collections.Counter()
    for i, text in rows:
        a, b, want = a_ids(" " + (text or "")), sp.encode(text or ""), (" " + (text or "")).encode()
        ab, bb = [tok.a_bytes[x] for x in a], [tok.b_bytes[x] for x in b]
        if not text or b"".join(ab) != want or b"".join(bb) != want:
            seen.append((i, [], [], [], []))
            continue
        ae, be = np.cumsum([len(x) for x in ab]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        links, groups, x, y = [], [], 0, 0
        while x < len(a) and y < len(b):
            links.append((a[x], b[y]))
            ends = ae[x], be[y]
            x, y = x + (ends[0] <= ends[1]), y + (ends[1] <= ends[0])
        x = y = 0
        for c in sorted(set(ae) & set(be)):
            ga, gb = [], []
            while x < len(a) and ae[x] <= c:
                ga.append(a[x])
                x += 1
            while y < len(b) and be[y] <= c:
                gb.append(b[y])
                y += 1
            groups.append((ga, gb))
        seen.append((i, a, b, groups, links))
        counts.update(set(links))
    best = collections.defaultdict(int)
    for (x, _), c in counts.items():
        best[x] = max(best[x], c)
    out = []
    for i, a, b, groups, links in seen:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, len(a), len(b), len(groups), len(links), sum(len(x) * len(y) for x, y in groups),
                    sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return sorted(out, key=str)


def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def test_alignment_digests_match_brute_force(spark, a_ids, monkeypatch):
    rows = documents(spark)[:120] + TEXTS
    monkeypatch.setattr(token_alignment, "SLICE", 1000)  # texts over several slices
    df = clashing(table(spark, rows).repartition(3), "block", "a", "links", "count")
    got = token_alignment.alignment_digests(df, BYTE, PIECE, block_chars=20_000)
    assert sorted(map(tuple, got.collect()), key=str) == brute_alignment(rows, a_ids)
    assert token_alignment.alignment_digests(empty(spark), BYTE, PIECE).count() == 0


def test_alignment_query_matches_brute_force(spark, a_ids):
    got = queries.QUERIES["op11_token_alignment"](spark, SF)
    assert sorted(map(tuple, got.collect()), key=str) == brute_alignment(documents(spark), a_ids)


def test_aligned_links_share_their_bytes(spark):
    rows = [(1, "Ein überlanges Wort, 漢字 and the rest"), (2, None)]
    out = {r.doc_id: r for r in token_alignment.align(table(spark, rows), BYTE, PIECE, shared=True).collect()}
    r = out[1]
    tok = token_alignment.Tokenizers(open(BYTE, "rb").read(), open(PIECE, "rb").read())
    assert sum(x["bytes"] for x in r.links) == len((" " + rows[0][1]).encode())
    assert {(x["a"], x["b"]) for x in r.links} <= {(x["a"], x["b"]) for x in r.shared_links}
    assert {(x["a"], x["b"]) for x in r.shared_links} == {
        (x, y) for x in range(len(r.a)) for y in range(len(r.b)) if r.a_group[x] == r.b_group[y]}
    assert b"".join(tok.a_bytes[i] for i in r.a) == b"".join(tok.b_bytes[i] for i in r.b)
    assert not out[2].a and not out[2].links


def test_gustavson_products_equal_dense_ones():
    rng = np.random.default_rng(3)
    for _ in range(30):
        n, m, k = rng.integers(1, 9, 3)
        dense = [rng.integers(0, 3, s) for s in ((n, m), (m, k))]
        sparse = [token_alignment.merged(*np.nonzero(d), d[np.nonzero(d)], *d.shape) for d in dense]
        out = token_alignment.gustavson(*sparse)
        full = np.zeros((n, k), int)
        full[out.row_of(), out.indices] = out.data
        assert (full == dense[0] @ dense[1]).all()
        assert (token_alignment.products(*sparse) == (dense[0] > 0) @ (dense[1] > 0).sum(1)).all()


@pytest.mark.parametrize("plain", [True, False])
def test_library_encoder_equals_the_library(spark, plain):
    t = Tokenizer.from_file(BYTE)
    t.encode_special_tokens = plain
    texts = [x or "" for _, x in documents(spark) + TEXTS]
    encoder = token_files.LibraryEncoder(open(BYTE, "rb").read(), plain)
    encoder.known.size = 500  # entries come and go
    got = [x for k in range(0, len(texts), 40) for x in encoder(texts[k:k + 40])]
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [
        e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_pieces_are_the_matches_of_the_pattern_and_share_calls():
    """Pieces of common characters are the pattern's matches, those of other texts whole matches put together; what
    begins with a space does not go to the library alone."""
    rng = np.random.default_rng(4)
    common, odd = [*"'strevmlda1 ._\n\té漢", " ", " ", "'s"], ["\xa0", "\u3000", "\u2028", "\u200b", "\u180e", "😀", "²", "\x1c", "a", " ", "'", "\n"]
    for signs in (common, common + odd):
        texts = ["", *["".join(rng.choice(signs, rng.integers(0, 12))) for _ in range(3000)], ""]
        pieces, ends = token_files.piece_column(texts)
        for t, a, b in zip(texts, ends, ends[1:], strict=False):
            matches, cut = regex.findall(public_tokenizers.PATTERN, t), pieces[a:b].to_pylist()
            assert "".join(cut) == t
            if signs is common:
                assert cut == matches
            assert set(np.cumsum([len(x) for x in cut])) <= set(np.cumsum([len(x) for x in matches]))
    assert token_files.piece_column(["", ""])[1].tolist() == [0, 0, 0]
    t, encoder, alone = Tokenizer.from_file(BYTE), token_files.LibraryEncoder(open(BYTE, "rb").read()), []
    library = encoder._library
    encoder._library = lambda x: alone.extend(x) or library(x)
    text = "one 1 22 -- (two) word's word, 333"
    assert np.frombuffer(encoder([text])[0], "<u2").tolist() == t.encode(text, add_special_tokens=False).ids
    assert sorted(alone) == ["'s", ")", ",", "one", "two"]


def test_distinct_pieces_of_a_block_are_learned_once_and_kept_in_bounds(monkeypatch):
    """A block is cut some texts at a time, but its distinct words go to the model once, by themselves; what is
    remembered stays within the bound or one block's pieces."""
    rng = np.random.default_rng(8)
    signs = [*"'strevmlda1 ._\n\té漢", " ", " ", "'s", "\xa0", "\u200b", "😀", "²", "<|endoftext|>"]
    blocks = [["", *["".join(rng.choice(signs, rng.integers(0, 40))) for _ in range(400)], ""] for _ in range(4)] + [[], ["", ""]]
    monkeypatch.setattr(token_files, "CUT_CHARS", 700)
    t, encoder, learned = Tokenizer.from_file(BYTE), token_files.LibraryEncoder(open(BYTE, "rb").read(), entries=300), []
    words, most = encoder._words, 300
    encoder._words = lambda x: learned.extend(x.to_pylist()) or words(x)
    for texts in blocks:
        learned.clear()
        got = encoder(texts)
        assert [np.frombuffer(x, "<u2").tolist() for x in got] == [
            e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
        assert len(learned) == len(set(learned)) and all(w[0] == " " and not w[1:].count(" ") for w in learned)
        pieces = token_files.piece_column(["" if "<|endoftext|>" in x else x for x in texts])[0]
        most = max(most, len(pieces.unique()))
        assert len(encoder.known.pieces) == len(encoder.known.ids) <= most


# ---------------------------------------------------------------- search

def oracle(docs, items):
    con = duckdb.connect()
    for name, rows, key in (("documents", docs, "doc_id"), ("benchmark", items, "item_id")):
        con.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        if rows:
            con.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    return sorted(con.execute(ranked_search.SQL).fetchall(), key=str)


def found(spark, tmp_dir, docs, items, **options):
    chars = options.pop("shard_chars", 3000)
    df = clashing(table(spark, docs).repartition(3), "shard", "term", "score", "rank")
    index = ranked_search.build_index(df, f"{tmp_dir}/index", shard_chars=chars)
    again = ranked_search.open_index(spark, index.path)
    assert again == index
    out = ranked_search.search(spark, again, clashing(table(spark, items, "item_id long, text string"), "terms"), **options)
    return sorted(map(tuple, out.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_search_equals_sql_over_shards_ties_and_odd_texts(spark, tmp_dir, monkeypatch):
    rng = random.Random(5)
    words = ["w%d" % min(int(rng.expovariate(0.05)), 400) for _ in range(4000)]
    docs = [(k, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for k in range(600)]
    docs += [(k, "same words here") for k in range(700, 760)] + docs[:5] + [(None, "w1 w2 same"), (None, "w1 w2 same")]
    docs += [(900, None), (901, ""), (902, " ,. "), (903, "W1 w1-W2É é ÉÉ"), (904, "w1 " * 20_000)]
    items = [(k, " ".join(rng.choices(words, k=rng.randint(1, 25)))) for k in range(40)]
    items += [(50, "same here w1"), (51, None), (52, "zzz unknown"), (52, "w1"), (52, "w1"), (None, "w2 w2 é"), (53, "  ")]
    monkeypatch.setattr(ranked_search, "BLOCK", 4)
    want = oracle(docs, items)
    assert found(spark, tmp_dir, docs, items) == want
    assert found(spark, tmp_dir + "x", docs, items, part_items=7, shard_chars=10**9) == want


def test_search_of_empty_tables(spark, tmp_dir):
    assert found(spark, tmp_dir, [], [(1, "a")]) == []
    assert found(spark, tmp_dir + "b", [(1, "a"), (2, None)], []) == []
    assert found(spark, tmp_dir + "c", [(1, None), (2, "")], [(1, "a")]) == []


def test_blocks_are_rejected_before_they_are_decompressed():
    """A document found by a rare term needs one block of the common term only."""
    n = 1000
    norm = np.full(n, 100, np.int64)

    def postings(places, counts):
        gap = np.diff(places, prepend=0)
        data, ends = ranked_search.pack(np.stack([gap, counts], 1).reshape(-1))
        gain = ranked_search.SCALE * counts // (1000 * counts + 12 * norm[places])
        tails = np.append(np.arange(127, len(places) - 1, 128), len(places) - 1)
        heads = np.concatenate([[0], tails[:-1] + 1])
        return ranked_search._List(int(gain.max()), places[tails], ends[2 * tails + 1],
                                   np.maximum.reduceat(gain, heads), data.tobytes(), norm)

    common = postings(np.arange(n), np.ones(n, np.int64))
    rare = postings(np.array([500, 700]), np.array([5, 4]))
    place, score = ranked_search.max_score([(10, common), (5000, rare)], n, 1)
    assert place.tolist() == [500] and common.whole is None and list(common.blocks) == [3]
    assert score[0] == 5000 * rare.all()[1][0] + 10 * common.all()[1][500]


def test_packed_numbers_come_back():
    values = np.array([0, 1, 127, 128, 300, 1 << 20, 1 << 35, 5])
    assert ranked_search.unpack(ranked_search.pack(values)[0].tobytes()).tolist() == values.tolist()


# ---------------------------------------------------------------- pages

def test_given_pages_give_their_articles(spark):
    rows = html_extraction.op13_html_extraction(spark, SF).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S).group(1)
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"<!--.*?-->|</?b>", "", article).replace("<br>", " "))
        assert r.text == "\n".join(t for t in (" ".join(unescape(b).split()) for b in blocks) if t)
        assert r.n_chars == len(r.text)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>The site</h1><nav><ul><li><a href="/">Home</a></li></ul></nav></header><div class="cookie-notice">We use cookies.</div>
%s
<aside><p>Latest news, which is long enough to look like text. Really, it is.</p></aside>
<div id="comments"><p>I think that this is a very long comment, and it has punctuation. Yes!</p></div>
<form action="/"><p>Subscribe, please.</p><input name=q></form><footer>&copy; all of us</footer></body></html>"""
LONG = "A long paragraph of text, with commas; and it goes on for quite some time. There is more."

PAGES = [
    (PAGE % f"<article><h1>Head</h1><p>{LONG}</p><p>ok</p><div class='ad'>Buy now.</div></article>", f"Head\n{LONG}\nok"),
    (PAGE % f"<div id='content'><h2>Head</h2><p>{LONG}</p><p>ok</p><ul><li>one</li><li>two</li></ul><p>{LONG}</p></div>",
     f"Head\n{LONG}\nok\none\ntwo\n{LONG}"),
    (PAGE % f"<main><header><h1>Head</h1></header><p>{LONG} <a href='x>y'>a <b>link</b></a> &lt;i&gt; caf&eacute;\n\t x</p></main>",
     f"Head\n{LONG} a link <i> café x"),
    (f"<form id=all><div class=nav>x y</div><main><h1>T</h1><p>{LONG}</p></main></form>", f"T\n{LONG}"),
    (f"<form id=all><div><p>{LONG}</p></div></form>", LONG),
    (f"<table><tr><td><a>one</a><br><a>two</a></td><td><h1>Head</h1>{LONG}<p>{LONG}</td></tr></table>", f"Head\n{LONG}\n{LONG}"),
    (f"<div><a>Home</a> | <a>News</a> | <a>Contact</a></div><div><h1>Title</h1><div><p>{LONG}</p><p>ok</p><p>{LONG}</p></div></div>",
     f"Title\n{LONG}\nok\n{LONG}"),
    (f"<article><p>{LONG}<section class='comments-area'><p>{LONG}</p></section><p class='notice'>n</p><p>x</p></article>",
     f"{LONG}\nx"),
    (f"<article><p>a<b>b</b>c <span class=ad>BUY</span>d<p hidden>h</p><p style='display: none'>h</p></article>", "abc d"),
    ("", ""), (None, ""), ("<p></p><div> </div>", ""), ("just text. here", "just text. here"), ("<p>x<!-- open <p>y", "x"),
    ("<script>var a='</p>'", ""), ("5 < 6 and 7 > 3", "5 < 6 and 7 > 3"),
]


def test_pages_of_many_layouts(spark):
    df = spark.createDataFrame([(k, h, "old") for k, (h, _) in enumerate(PAGES)], "page_id long, html string, text string")
    got = html_extraction.extract(df).orderBy("page_id").collect()
    assert [r.text for r in got] == [t for _, t in PAGES]
    assert [r.n_chars for r in got] == [len(t) for _, t in PAGES]
    assert got[0].html == PAGES[0][0] and "article/p" in got[0].content_paths[-1]
    assert html_extraction.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("html", ["<p " * 30_000, "<a title=\"x" * 30_000, "<div>" * 30_000 + "t" + "</x>" * 30_000,
                                  "<b>" * 20_000 + "<p>x</p>y" * 5_000, "<li><b>" * 20_000, "<!" * 30_000])
def test_broken_pages_cost_no_more_than_long_ones(html):
    import time
    start = time.time()
    html_extraction.main_text(html)
    assert time.time() - start < 20
