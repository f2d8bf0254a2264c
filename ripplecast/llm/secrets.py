"""Secret scans (operator 10), with DataFrame functions only.

Every rule's regex is turned into a Boolean trigram query: alternatives (OR) of
trigrams that a match must hold (AND). The trigram index holds, per document, a
bitmap of the query trigrams in it, i.e. the posting lists, kept partitioned by
document so that they never travel. Intersecting postings is a bit test. Only
documents that pass a rule's query are verified with its regex; rules without
mandatory trigrams (the hex run) scan every text.

Spans come from the texts between matches: `split` gives the gaps,
`regexp_extract_all` the matches, and running lengths the places in code points.

Defined results: null or empty text has no span (digest of the empty string); rows are
scanned one by one, also with a null or repeated doc_id; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as C
from re import _parser as parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplecast.llm.tables import read


@dataclass(frozen=True)
class Rule:
    kind: str
    regex: str  # valid for Python (analysis) and Java (matching)
    least: int = 0  # least length of `group`; shorter matches are dropped
    group: int = 0
    any_case: bool = False  # the letters of the trigrams may have either case


# The three base kinds, in order. A run of `{32,}` is the maximal run of 32 or more.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        8, 2, True,
    ),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
#: Kinds beyond the base.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
)
#: Trigrams kept of each alternative, those with the fewest small letters first (any subset is still mandatory).
KEPT_TRIGRAMS = 2
#: Largest number of alternatives a query may have; beyond it a part counts as unknown.
ALTERNATIVES = 64


def _literals(tree) -> list[tuple[str, ...]]:
    """Alternatives of literal runs that any match of `tree` holds, as ("", run, "", ...).

    A tuple of runs is what is certain; runs in one tuple are apart by unknown text.
    """
    out = [("",)]
    for op, arg in tree:
        if op is C.LITERAL:
            part = [(chr(arg),)]
        elif op is C.SUBPATTERN:
            part = _literals(arg[3])
        elif op is C.BRANCH:
            part = [x for branch in arg[1] for x in _literals(branch)]
        elif op is C.IN and all(k is C.LITERAL for k, _ in arg) and len(arg) <= 8:
            part = [(chr(v),) for _, v in arg]
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
            low, high, body = arg
            inner = _literals(body)
            if (low, high) == (0, 1) and all(len(x) == 1 for x in inner):
                part = [("",), *inner]
            elif low and low == high and low <= 8 and len(inner) == 1:
                part = _join([inner] * low)
            elif low:  # at least one, then unknown
                part = [(*x, "") for x in inner]
            else:
                part = [("", "")]
        else:
            part = [("", "")]
        joined = _join([out, part])
        out = joined if len(joined) <= ALTERNATIVES else [(*x, "") for x in out]
    return out


def _join(parts: list[list[tuple[str, ...]]]) -> list[tuple[str, ...]]:
    out = parts[0]
    for part in parts[1:]:
        out = list(dict.fromkeys((*a[:-1], a[-1] + b[0], *b[1:]) for a in out for b in part))
    return out


def trigram_query(regex: str) -> list[frozenset[str]]:
    """OR of ANDs of trigrams; empty: the regex has no mandatory trigram."""
    query = []
    for runs in _literals(parser.parse(regex)):
        grams = frozenset(run[i : i + 3] for run in runs for i in range(len(run) - 2))
        if not grams:
            return []
        query.append(grams)
    query = [q for q in dict.fromkeys(query) if not any(p < q for p in query)]
    rare = [sorted(q, key=lambda g: (sum(c.islower() for c in g), g)) for q in query]
    return list(dict.fromkeys(frozenset(q[:KEPT_TRIGRAMS]) for q in rare))


def trigram_bitmap(text: Column, grams: list[tuple[str, bool]]) -> Column:
    """Bit i: the text holds grams[i] = (trigram, either case)."""
    lower = F.lower(text)
    bits = [
        F.when(F.contains(lower if fold else text, F.lit(g)), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
        for i, (g, fold) in enumerate(grams)
    ]
    out = F.lit(0).cast("long")
    for b in bits:
        out = out.bitwiseOR(b)
    return out


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """array<struct<s, k, e>> of a rule's spans in code points."""
    regex = F.lit(rule.regex)
    found = F.regexp_extract_all(text, regex, F.lit(0))
    tested = F.regexp_extract_all(text, regex, F.lit(rule.group)) if rule.least else found
    items = F.arrays_zip(
        F.transform(F.split(text, rule.regex, -1), lambda x: F.char_length(x)).alias("gap"),
        F.transform(found, lambda x: F.char_length(x)).alias("size"),
        F.transform(tested, lambda x: F.char_length(x) >= rule.least).alias("ok"),
    )
    one = "array<struct<s:int,k:int,e:int>>"
    state = F.struct(F.lit(0).alias("at"), F.array().cast(one).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + F.coalesce(x["size"], F.lit(0))
        span = F.struct(begin.alias("s"), F.lit(order).alias("k"), end.alias("e"))
        return F.struct(
            end.alias("at"), F.when(F.coalesce(x["ok"], F.lit(False)), F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out")
        )

    return F.aggregate(items, state, step, lambda acc: acc["out"])


def scan_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, base: int = len(BASE),
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, text, and `found`: sorted spans (start, rule number, end) of all rules."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    queries = [trigram_query(r.regex) for r in rules]
    wanted = sorted({(g.lower() if r.any_case else g, r.any_case) for r, q in zip(rules, queries, strict=True) for a in q for g in a})
    if len(wanted) > 63:
        raise ValueError("one bitmap holds at most 63 query trigrams")
    bit = {g: 1 << i for i, g in enumerate(wanted)}
    indexed = docs.withColumn("held", trigram_bitmap(F.col("text"), wanted))
    parts = []
    for k, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        candidate = F.lit(not query)
        for grams in query:
            need = sum(bit[(g.lower() if rule.any_case else g, rule.any_case)] for g in grams)
            candidate = candidate | (F.col("held").bitwiseAND(F.lit(need).cast("long")) == F.lit(need).cast("long"))
        # Verified by the regex: texts without a match never reach the span arithmetic.
        hit = candidate & F.col("text").rlike(rule.regex)
        empty = F.array().cast("array<struct<s:int,k:int,e:int>>")
        parts.append(F.when(hit, _spans(F.col("text"), rule, k)).otherwise(empty).alias(f"r{k}"))
    spans = indexed.select("doc_id", "text", *parts)
    return spans.select("doc_id", "text", F.sort_array(F.concat(*(F.col(f"r{k}") for k in range(len(rules))))).alias("found"))


def _written(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ","
    )


def secret_report(docs: DataFrame, **options) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans."""
    rules, n = BASE + MORE, len(BASE)
    found = scan_secrets(docs, rules, n, **options).select("doc_id", "found")
    count = lambda k: F.size(F.filter("found", lambda x: x["k"] == k)).cast("long")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE)),
        F.sha2(_written(F.filter("found", lambda x: x["k"] < n), rules), 256).alias("base_sha256"),
        _written(F.col("found"), rules).alias("spans"),
    )


def mask_secrets(docs: DataFrame, mark: str = "[secret]", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with every span of every rule replaced in its text; other columns and rows as they are.

    Overlapping spans become one mark. Null texts stay null.
    """
    text = F.col("text")

    def step(acc: Column, x: Column) -> Column:
        gap = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), F.lit(mark))
        return F.struct(
            F.greatest(acc["at"], x["e"]).alias("at"), F.when(x["s"] >= acc["at"], gap).otherwise(acc["out"]).alias("out")
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text)))
    masked = F.when(F.size("found") > 0, F.aggregate("found", start, step, rest)).otherwise(F.col("_row")[text_col])
    whole = docs.select(F.struct(*docs.columns).alias("_row"))
    rows = whole.select(F.col("_row").alias("doc_id"), F.col("_row")[text_col].alias("text"))
    found = scan_secrets(rows).withColumnRenamed("doc_id", "_row")
    return found.select(*(masked.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(read(spark, sf_dir, "documents"))


assert all(re.compile(r.regex) for r in BASE + MORE)
