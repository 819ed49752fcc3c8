"""Secret scan with a trigram inverted index, in DataFrame functions alone.

1. ``trigram_query`` derives from each rule's regular expression which trigrams
   every match must hold: an OR over alternatives of an AND of trigrams (lower case).
2. ``build_index`` writes the postings: a row (trigram, doc_id) for each
   document and trigram of the rules' queries that its lower-case text holds.
3. ``candidates`` intersects the postings: trigrams are bits, a document's bits
   are united, and a rule's candidates are the documents that have all bits of an alternative.
4. ``scan`` verifies: the regular expressions of indexed rules run over their
   candidates' texts alone; rules without a mandatory trigram run over every text.

Spans are in code points, end exclusive: leftmost matches that don't overlap,
per rule; matches whose deciding group is too short are dropped after they
have been consumed. Place in a document is the sum of the lengths of the gaps and matches
before it.

Defined cases: null and empty texts have no spans; rows that share a doc_id
(or have none) are each scanned, their postings are united, which only adds
candidates; repeated rows each get a row; an empty table gives an empty table; texts are scanned
whole; other columns pass through ``scan``, replaced where names clash.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from carelake.session import work_dir

from .common import read_table

try:
    from re import _constants as sre, _parser as sre_parser
except ImportError:  # Python before 3.11
    import sre_constants as sre
    import sre_parse as sre_parser


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0       # its length decides
    least: int = 1       # characters of that group
    ignore_case: str = ""  # the part of the pattern in which letters are of either case


#: The rules of the base, in order.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 6, "password|passwd|secret|token|api_?key"),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: Rules beyond the base.
EXTRA = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[0-9A-Za-z_-]+", 0, 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
)
RULES = BASE + EXTRA
#: Alternatives that literal parts are multiplied out to.
MAX_ALTERNATIVES = 64


# ---------------------------------------------------------------- trigram queries

def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives of which a matching text holds all trigrams of one, in lower case; [] if nothing is mandatory."""
    best: list[frozenset[str]] = []
    for strings in _literal_runs(sre_parser.parse(pattern)):
        sets = [frozenset(s[k:k + 3].lower() for k in range(len(s) - 2)) for s in strings]
        # Of several mandatory parts, the one whose shortest alternative has most trigrams.
        if all(sets) and min(map(len, sets)) > min(map(len, best), default=0):
            best = sorted({a for a in sets if not any(b < a for b in sets)}, key=sorted)
    return best


def _exact(node) -> list[str] | None:
    """All strings that the node matches, if they are few."""
    op, arg = node
    if op is sre.LITERAL:
        return [chr(arg)]
    if op is sre.IN:
        out = []
        for kind, value in arg:
            if kind is sre.LITERAL:
                out.append(chr(value))
            elif kind is sre.RANGE and value[1] - value[0] < 8:
                out += map(chr, range(value[0], value[1] + 1))
            else:
                return None
        return out if len(out) <= 8 else None
    if op is sre.SUBPATTERN:
        return _product(arg[-1])
    if op is sre.BRANCH:
        parts = [_product(b) for b in arg[1]]
        return None if None in parts else [s for p in parts for s in p]
    if op is sre.MAX_REPEAT and arg[1] <= 8:
        inner = _product(arg[2])
        return None if inner is None or len(inner) * arg[1] > 16 else sorted(
            {"".join(p) for n in range(arg[0], arg[1] + 1) for p in product(inner, repeat=n)})
    return None


def _product(nodes) -> list[str] | None:
    out = [""]
    for node in nodes:
        strings = _exact(node)
        if strings is None or len(out) * len(strings) > MAX_ALTERNATIVES:
            return None
        out = [a + b for a in out for b in strings]
    return out


def _literal_runs(nodes) -> list[list[str]]:
    """For each stretch of the pattern that matches few strings, these strings."""
    runs, here = [], [""]
    for node in nodes:
        strings = _exact(node)
        if strings is not None and len(here) * len(strings) <= MAX_ALTERNATIVES:
            here = [a + b for a in here for b in strings]
        else:
            runs.append(here)
            here = [""]
            if strings is not None:
                here = strings
    return [*runs, here]


# ---------------------------------------------------------------- index

def vocabulary(rules=RULES) -> list[str]:
    return sorted({t for r in rules for alternative in trigram_query(r.pattern) for t in alternative})


def build_index(docs: DataFrame, path: str, rules=RULES) -> DataFrame:
    """Postings (trigram, doc_id) of the rules' trigrams, written to ``path``."""
    low = docs.select(F.col("doc_id").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains(F.col("low"), F.lit(t)), F.lit(t)) for t in vocabulary(rules)]))
    postings = low.where("low is not null").select("doc_id", F.explode(held).alias("trigram")).select("trigram", "doc_id")
    postings.write.parquet(path)
    return docs.sparkSession.read.schema(postings.schema).parquet(path)


def candidates(postings: DataFrame, rules=RULES) -> DataFrame:
    """doc_id and the kinds whose trigram queries its postings meet."""
    bit = {t: (k // 63, 1 << k % 63) for k, t in enumerate(vocabulary(rules))}
    words = max((w for w, _ in bit.values()), default=-1) + 1
    by_word = [F.bit_or(_bits(bit, k)).alias(f"b{k}") for k in range(words)]
    if not by_word:
        return postings.select("doc_id", F.array(F.lit("")).alias("kinds")).limit(0)
    united = postings.groupBy("doc_id").agg(*by_word)

    def met(alternative) -> Column:
        masks = [sum(b for t in alternative for w, b in [bit[t]] if w == k) for k in range(words)]
        parts = [F.col(f"b{k}").bitwiseAND(F.lit(m).cast("long")) == F.lit(m).cast("long") for k, m in enumerate(masks) if m]
        out = parts[0]
        for p in parts[1:]:
            out = out & p
        return out

    kinds = []
    for r in rules:
        if query := trigram_query(r.pattern):
            any_met = met(query[0])
            for alternative in query[1:]:
                any_met = any_met | met(alternative)
            kinds.append(F.when(any_met, F.lit(r.kind)))
    return united.select("doc_id", F.array_compact(F.array(*kinds)).alias("kinds")).where(F.size("kinds") > 0)


def _bits(bit: dict, word: int) -> Column:
    pairs = [x for t, (w, b) in bit.items() if w == word for x in (F.lit(t), F.lit(b).cast("long"))]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col("trigram")), F.lit(0).cast("long"))


# ---------------------------------------------------------------- verification

def java_pattern(rule: Rule) -> str:
    """For the engine, whose (?i) is ASCII's."""
    return rule.pattern.replace(rule.ignore_case, f"(?i:{rule.ignore_case})", 1) if rule.ignore_case else rule.pattern


def _long_runs(rule: Rule) -> str | None:
    """For a repeated class: the pattern of the runs that are long enough; the same spans."""
    if rule.group == 0 and re.fullmatch(r"\[[^\]]*\]\+", rule.pattern):
        return f"{rule.pattern[:-1]}{{{rule.least},}}"
    return None


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def spans_of(rule: Rule, number: int, text: str = "text") -> Column:
    """Array of (start, number, end) of the rule's matches that are long enough."""
    p = _long_runs(rule) or java_pattern(rule)
    t, q = f"`{text}`", _quoted(p)
    return F.expr(f"""
        aggregate(
            arrays_zip(split({t}, {q}, -1), regexp_extract_all({t}, {q}, 0), regexp_extract_all({t}, {q}, {rule.group})),
            named_struct('at', 0, 'found', cast(array() as array<struct<start:int,kind:int,end:int>>)),
            (a, x) -> named_struct(
                'at', a.at + length(x['0']) + coalesce(length(x['1']), 0),
                'found', if(coalesce(length(x['2']), 0) >= {rule.least},
                    array_append(a.found, named_struct('start', a.at + length(x['0']), 'kind', {number},
                                                       'end', a.at + length(x['0']) + length(x['1']))), a.found)),
            a -> a.found)""")


def scan(docs: DataFrame, index_path: str | None = None, rules=RULES) -> DataFrame:
    """``docs`` with ``spans``: array of (start, kind, end), kind the rule's number, in order."""
    spark = docs.sparkSession
    path = index_path or work_dir(spark, "trigram_index")
    postings = build_index(docs, path, rules)
    found_path = f"{path}-candidates"
    candidates(postings, rules).write.parquet(found_path)
    # Read back, so that the planner knows their size before it picks the join.
    found = spark.read.parquet(found_path).withColumnRenamed("doc_id", "_doc").withColumnRenamed("kinds", "_kinds")
    docs = docs.drop("spans")
    joined = docs.join(found, docs["doc_id"].eqNullSafe(found["_doc"]), "left")
    empty = F.expr("cast(array() as array<struct<start:int,kind:int,end:int>>)")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    joined = joined.withColumn("_text", text)
    parts = []
    for k, rule in enumerate(rules):
        if trigram_query(rule.pattern):
            meets = F.coalesce(F.array_contains("_kinds", rule.kind), F.lit(False))
        elif _long_runs(rule):
            meets = F.col("_text").rlike(_long_runs(rule))
        else:
            meets = F.lit(True)
        parts.append(F.when(meets, spans_of(rule, k, "_text")).otherwise(empty))
    return joined.withColumn("spans", F.sort_array(F.concat(*parts))).drop("_doc", "_kinds", "_text")


def redact(scanned: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """What ``scan`` returned, with every stretch of text that spans cover replaced by ``mark``."""
    return scanned.withColumn("text", F.when(F.size("spans") == 0, F.col("text")).otherwise(F.expr(f"""
        aggregate(spans, named_struct('at', 0, 'text', ''),
            (a, x) -> named_struct(
                'at', greatest(a.at, x.end),
                'text', if(x.end <= a.at, a.text, concat(a.text,
                    if(x.start >= a.at, concat(substring(text, a.at + 1, x.start - a.at), {_quoted(mark)}), '')))),
            a -> concat(a.text, substring(text, a.at + 1, length(text))))""")))


def _joined(spans: str, rules=RULES) -> Column:
    names = ", ".join(_quoted(r.kind) for r in rules)
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', array({names})[x.kind], "
                  f"cast(x.start as string), cast(x.end as string))), ',')")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document's whole text."""
    found = scan(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")
    count = [F.expr(f"cast(size(filter(spans, x -> x.kind = {k})) as long)").alias(f"n_{r.kind}")
             for k, r in enumerate(BASE)]
    return found.select("doc_id", *count, F.sha2(_joined(f"filter(spans, x -> x.kind < {len(BASE)})"), 256)
                        .alias("base_sha256"), _joined("spans").alias("spans"))


# ---------------------------------------------------------------- the same in DuckDB

def _either_case(pattern: str) -> str:
    return re.sub(r"[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", pattern)


def _duck(rule: Rule, number: int) -> str:
    p = _long_runs(rule) or (rule.pattern.replace(rule.ignore_case, _either_case(rule.ignore_case), 1)
                             if rule.ignore_case else rule.pattern)
    q = "'" + p.replace(r"\x20", " ").replace("'", "''") + "'"
    lengths = f"list_transform(regexp_extract_all(t, {q}, 0), lambda x: length(x))"
    return f"""
    select row, {number} as kind, '{rule.kind}' as name, list_sum(g[1:i]) + coalesce(list_sum(m[1:i - 1]), 0) as first, m[i] as size, d[i] as decides
    from (select row, list_transform(string_split_regex(t, {q}), lambda x: length(x)) as g, {lengths} as m,
                 list_transform(regexp_extract_all(t, {q}, {rule.group}), lambda x: length(x)) as d, unnest(generate_series(1, len({lengths}))) as i
          from docs) where decides >= {rule.least}"""


SQL = f"""
with docs as (select row_number() over () as row, doc_id, coalesce(text, '') as t from documents),
spans as ({" union all ".join(_duck(r, k) for k, r in enumerate(RULES))}),
texts as (select *, name || ':' || cast(cast(first as bigint) as varchar) || ':' || cast(cast(first + size as bigint) as varchar) as span from spans)
select any_value(d.doc_id) as doc_id,
       {", ".join(f"cast(count(*) filter (s.kind = {k}) as bigint) as n_{r.kind}" for k, r in enumerate(BASE))},
       sha256(coalesce(string_agg(span, ',' order by first, kind) filter (s.kind < {len(BASE)}), '')) as base_sha256,
       coalesce(string_agg(span, ',' order by first, kind), '') as spans
from docs d left join texts s on d.row = s.row group by d.row
"""
