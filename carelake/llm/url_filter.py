"""URL filter: rules first, then logistic regression on hashed character n-grams.

A URL's host and path are cut out with DataFrame functions. A rule (host,
path, verdict) fits its host and all subdomains where the URL's path starts
with the rule's; the longest rule wins (ties: the first in order of text). URLs without
a rule are judged by a logistic regression on character n-grams of 3 to 5 of
host and path, hashed into ``2 ** BITS`` weights and fitted by gradient steps on a small
labelled URL table (at most ``MAX_LABELLED`` rows).

Defined cases: a null url, or one without ``://``, has an empty host and path and
is judged by the regression's constant; repeated pages each get a row; an
empty table gives an empty table; an empty labelled table allows everything;
columns other than url pass through ``judge_urls``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import read_table, ship

BITS = 16
MAX_LABELLED = 100_000
GRAMS = (3, 4, 5)
ROUNDS, STEP, PENALTY = 400, 1.0, 1e-3
THRESHOLD = 0.5

#: (host, path, verdict)
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]

# The small labelled table: hosts that advertise or lure, and plain ones, with paths of every kind under both.
_LURES = ("casino-win", "casino-royal", "best-casino", "free-bets", "sport-bets", "bet-now", "cheap-pills",
          "pills-shop", "buy-pills", "ads-track", "ad-tracker", "track-ads", "spam-farm", "link-farm", "spam-mail",
          "adult-x", "adult-video", "xxx-cam", "porn-tube", "free-porn", "lottery-win", "poker-win", "loan-cheap",
          "slots-free", "click-ads")
_PLAIN = ("news", "library", "garden", "science", "travel", "weather", "school", "museum", "history", "recipes",
          "forum", "music", "university", "photo", "health", "thether", "onenand", "reading", "thaning", "entrest",
          "tionth", "ingther", "thatere", "ndthe", "erthan")
_SHAPES = ("https://www.{}.example.com/en/{}", "http://{}.example.net/de/{}.html", "https://m.{}.example.net/fr/{}/",
           "http://blog.{}.example.com/es/{}?page=2&ref=x")


def labelled_urls() -> list[tuple[str, int]]:
    """url, 1 to block."""
    return [(shape.format(name, 7 * k + 13 * j), label)
            for label, names in ((1, _LURES), (0, _PLAIN)) for k, name in enumerate(names)
            for j, shape in enumerate(_SHAPES)]


def _fold_case(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: up to ``/``, ``?``, ``#`` or the end, and from there up to ``?``, ``#`` or the end."""
    at = F.locate("://", url)
    after = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(_fold_case(host), F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(host: Column, path: Column, rules: Iterable[tuple[str, str, str]]) -> Column:
    """A struct of the rule's text and verdict, null where none fits."""
    out = F.lit(None)
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1]), reverse=False):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def gram_ids(host: str, path: str, bits: int = BITS) -> list[int]:
    """Distinct hashed n-grams; host and path count apart."""
    found = set()
    for kind, text in (("h", f"^{host}$" if host else ""), ("p", f"^{path}$" if path else "")):
        for n in GRAMS:
            found.update(kind + text[k:k + n] for k in range(len(text) - n + 1))
    return sorted({zlib.crc32(g.encode("utf-8", "surrogatepass")) & ((1 << bits) - 1) for g in found})


def fit_urls(rows: list[tuple[str, str, int]], bits: int = BITS) -> np.ndarray:
    """Weights of the n-grams and, last, the constant; rows: host, path, 1 to block."""
    if len(rows) > MAX_LABELLED:
        raise ValueError(f"{len(rows)} labelled URLs; at most {MAX_LABELLED} are fitted")
    w = np.zeros((1 << bits) + 1)
    if not rows:
        w[-1] = -1.0
        return w
    grams = [np.array([*gram_ids(h, p, bits), 1 << bits]) for h, p, _ in rows]
    at, of = np.concatenate(grams), np.repeat(np.arange(len(rows)), [len(g) for g in grams])
    scale = (1 / np.sqrt([len(g) for g in grams]))[of]
    y = np.array([label for *_, label in rows], float)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.bincount(of, w[at] * scale, len(rows))))
        w -= STEP * (np.bincount(at, (p - y)[of] * scale, len(w)) / len(rows) * 10 + PENALTY * w)
    return w


def url_scores(w: np.ndarray, hosts: list[str], paths: list[str]) -> np.ndarray:
    bits = (len(w) - 1).bit_length() - 1
    out = np.empty(len(hosts))
    for k, (h, p) in enumerate(zip(hosts, paths, strict=True)):
        ids = gram_ids(h, p, bits)
        out[k] = (w[ids].sum() + w[-1]) / np.sqrt(len(ids) + 1)
    return 1 / (1 + np.exp(-out))


def judge_urls(pages: DataFrame, weights: np.ndarray, rules=RULES, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict and score (of the regression)."""
    spark = pages.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(weights)  # 2 ** BITS numbers
    host, path = host_and_path(F.col(url).cast("string"))

    @F.pandas_udf("double")
    def score(h, p):
        import pandas as pd
        return pd.Series(url_scores(shared.value, h.tolist(), p.tolist()))

    parts = pages.withColumn("_host", host).withColumn("_path", path)
    parts = parts.withColumn("_rule", longest_rule(F.col("_host"), F.col("_path"), rules))
    parts = parts.withColumn("_score", score("_host", "_path"))
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in ("host", "path", "rule", "verdict", "score")]
    return parts.select(*kept, F.col("_host").alias("host"), F.col("_path").alias("path"),
                        F.col("_rule.rule").alias("rule"),
                        F.coalesce(F.col("_rule.verdict"), F.when(F.col("_score") >= THRESHOLD, "block")
                                   .otherwise("allow")).alias("verdict"), F.col("_score").alias("score"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    labelled = spark.createDataFrame(labelled_urls(), "url string, block int")
    host, path = host_and_path(F.col("url"))
    weights = fit_urls([tuple(r) for r in labelled.select(host, path, "block").collect()])
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, weights).select("page_id", "host", "path", "rule", "verdict", "score")
