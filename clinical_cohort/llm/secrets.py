r"""Secret scan over a trigram inverted index, in DataFrame functions only.

1. Each rule's regex is turned into a Boolean trigram query: a conjunction of
   disjunctions of trigram sets that every match must contain (`trigram_query`).
2. One scan posts ``(trigram, key)`` for the query trigrams that a lower-cased
   text contains; postings are intersected by grouping (`candidates`).
3. Candidates are verified by the regex itself on the whole text. Rules that
   have no mandatory trigram (a bare character class) scan every text.

Spans are code points, end exclusive, leftmost and non-overlapping per rule.
Spark has no function for match positions; they are the running sum of the
lengths of the pieces between matches and of the matches.

Null text is read as empty: no span. Very long texts are scanned whole. Repeated
rows, also of one key, each get their own spans (the index only widens the
candidates). Spans of equal start are in the rules' order. A null key is a key of
its own. An empty table gives an empty result. Other input columns are not read by
`scan` and are kept by `redact`, whatever their names.
"""

from __future__ import annotations

import itertools
import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let


@dataclass(frozen=True)
class Rule:
    """``pattern`` (Java syntax); a match counts if ``group`` has ``min_length`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    min_length: int = 0


#: The three base kinds, in the order that breaks ties of start.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
#: A PEM or PGP key reaches from its BEGIN line over key headers and key text to its END line; key text is base64
#: with line breaks (also escaped ones) and the marks of quoting or diffs, so prose in between, with its full stops
#: and commas, is no key. Without an END line it reaches over the base64 text that follows; a BEGIN line that
#: neither follows is a span by itself. Only single characters are repeated without bound: Java recurses for
#: repeated groups.
_KEY_BEGIN = r"-{4,5}\x20?BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?\x20?-{4,5}"
_KEY_HEADS = r"""(?:[\x20\x09-\x0D\\">+nr-]*[A-Z][A-Za-z-]*:[^\n]*?(?:\n|\\n)){0,6}"""
_KEY_WHOLE = _KEY_HEADS + r"""[A-Za-z0-9+/=\x20\x09-\x0D\\">#|-]*?""" + _KEY_BEGIN.replace("BEGIN", "END")
_KEY_CUT = _KEY_HEADS + r"""[\x20\x09-\x0D\\">+nr-]*[A-Za-z0-9+/=]{20,}[A-Za-z0-9+/=\x20\x09-\x0D\\">-]*"""
#: Added kinds: published prefixes of service keys, key files, tokens and addresses with a password.
ADDED = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}"),
    Rule("private_key", _KEY_BEGIN + "(?:" + _KEY_WHOLE + "|" + _KEY_CUT + ")?"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("url_password", r"://[^\x20\x09-\x0D:@/]*:[^\x20\x09-\x0D:@/]+@"),
)
RULES = BASE + ADDED

#: A class or repetition with more variants than this ends a literal.
MAX_VARIANTS = 16

Query = list[list[frozenset[str]]]


def _grams(s: str) -> frozenset[str]:
    return frozenset(s[i:i + 3] for i in range(len(s) - 2))


def _variants(op, arg) -> list[str] | None:
    """All strings that a node can match, or None if they are many or unknown."""
    if op is sre.LITERAL:
        return [chr(arg)]
    if op is sre.IN:
        out = []
        for kind, a in arg:
            if kind is sre.LITERAL:
                out.append(chr(a))
            elif kind is sre.RANGE and a[1] - a[0] < MAX_VARIANTS:
                out += [chr(c) for c in range(a[0], a[1] + 1)]
            else:
                return None
        return out if len(out) <= MAX_VARIANTS else None
    if op is sre.SUBPATTERN:
        return _strings(arg[3])
    if op is sre.BRANCH:
        parts = [_strings(x) for x in arg[1]]
        return None if any(p is None for p in parts) else [s for p in parts for s in p]
    if op is sre.MAX_REPEAT and arg[1] <= 1:
        one = _strings(arg[2])
        return None if one is None else one + [""] * (arg[0] == 0)
    return None


def _strings(nodes) -> list[str] | None:
    out = [""]
    for op, arg in nodes:
        v = _variants(op, arg)
        if v is None or len(out) * len(v) > MAX_VARIANTS:
            return None
        out = [a + b for a, b in itertools.product(out, v)]
    return out


def trigram_query(pattern: str) -> Query:
    """Conjunction of disjunctions of trigram sets, over lower-cased text.

    Runs of nodes with few variants give a disjunction over the run's strings;
    a run in which some string is shorter than three characters gives nothing.
    An empty conjunction means that the rule has no mandatory trigram.
    """
    def walk(nodes) -> Query:
        query: Query = []
        run = [""]

        def flush():
            nonlocal run
            sets = {_grams(s.lower()) for s in run}
            if frozenset() not in sets:
                query.append(sorted(sets, key=sorted))
            run = [""]

        for op, arg in nodes:
            v = _variants(op, arg)
            if v is not None and len(run) * len(v) <= MAX_VARIANTS:
                run = [a + b for a, b in itertools.product(run, v)]
                continue
            flush()
            if v is not None:
                run = v
            elif op is sre.SUBPATTERN:
                query.extend(walk(arg[3]))
            elif op is sre.MAX_REPEAT and arg[0] >= 1:
                query.extend(walk(arg[2]))
        flush()
        return query

    return walk(sre_parser.parse(pattern))


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key`` and the ``kinds`` whose trigram query the texts of that key satisfy.

    The table of query terms holds a few trigrams per rule, so it is bounded by
    the rules and broadcast. Postings are grouped by key and term, with a partial
    sum before the shuffle; no group grows with the data.
    """
    spark = docs.sparkSession
    terms, needed = [], []
    for r in rules:
        query = trigram_query(r.pattern)
        if query:
            needed.append((r.kind, len(query)))
        for d, sets in enumerate(query):
            for a, grams in enumerate(sets):
                terms += [(g, r.kind, d, a, len(grams)) for g in sorted(grams)]
    grams = sorted({t[0] for t in terms})
    term_table = spark.createDataFrame(terms, "gram string, kind string, part int, alt int, n_grams int")
    need_table = spark.createDataFrame(needed, "kind string, n_parts int")

    low = F.lower(F.col(text))
    present = let(low, lambda t: F.filter(F.array(*[F.lit(g) for g in grams]), lambda g: F.contains(t, g)))
    postings = docs.select(F.col(key).alias("k"), F.explode(present).alias("gram"))
    met = (postings.join(F.broadcast(term_table), "gram")
           .groupBy("k", "kind", "part", "alt", "n_grams").agg(F.count_distinct("gram").alias("n"))
           .where("n = n_grams")
           .groupBy("k", "kind").agg(F.count_distinct("part").alias("n"))
           .join(F.broadcast(need_table), "kind").where("n = n_parts"))
    return met.groupBy("k").agg(F.collect_set("kind").alias("kinds"))


def _matches(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, order, end) of the rule's matches, by start."""
    def place(pieces: Column, whole: Column, value: Column) -> Column:
        empty = F.array().cast("array<struct<start:int,ord:int,end:int>>")
        step = lambda acc, i: let(acc["pos"] + F.length(F.get(pieces, i)), lambda s: let(
            s + F.length(F.get(whole, i)), lambda e: F.struct(
                e.alias("pos"),
                F.when(F.length(F.get(value, i)) >= rule.min_length, F.array_append(
                    acc["out"], F.struct(s.alias("start"), F.lit(order).alias("ord"), e.alias("end"))))
                .otherwise(acc["out"]).alias("out"))))
        return F.aggregate(F.sequence(F.lit(0), F.size(whole) - 1),
                           F.struct(F.lit(0).alias("pos"), empty.alias("out")), step, lambda acc: acc["out"])

    pattern = F.lit(rule.pattern)
    none = F.array().cast("array<struct<start:int,ord:int,end:int>>")
    found = let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda whole: F.when(F.size(whole) == 0, none).otherwise(
        let(F.split(text, rule.pattern, -1), lambda pieces: let(
            F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda value: place(pieces, whole, value)))))
    return found


def spans(text: Column, kinds: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Array of (start, ord, end) over all rules, sorted; ``ord`` is the rule's place in ``rules``.

    ``kinds`` names the candidates' rules; rules without mandatory trigrams always run.
    """
    parts = []
    for i, r in enumerate(rules):
        m = _matches(text, r, i)
        if trigram_query(r.pattern):
            m = F.when(F.array_contains(kinds, r.kind), m).otherwise(
                F.array().cast("array<struct<start:int,ord:int,end:int>>"))
        parts.append(m)
    return F.array_sort(F.concat(*parts))


def _found(docs: DataFrame, rules: tuple[Rule, ...], text: str, key: str) -> DataFrame:
    """All rows packed as struct ``row``, with ``found``, the sorted spans."""
    rows = docs.select(F.struct("*").alias("row"))
    cand = candidates(docs, rules, text, key)
    joined = rows.join(cand, rows["row"][key].eqNullSafe(cand["k"]), "left")
    t = F.coalesce(F.col("row")[text], F.lit(""))
    kinds = F.coalesce(F.col("kinds"), F.array().cast("array<string>"))
    return joined.select("row", let(t, lambda t: let(kinds, lambda k: spans(t, k, rules))).alias("found"))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key and ``found``, an array of (start, end, kind)."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    found = _found(docs.select(key, text), rules, text, key)
    return found.select(F.col("row")[key].alias(key), F.transform("found", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.get(names, s["ord"]).alias("kind"))).alias("found"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", key: str = "doc_id",
           mask: str = "[secret]") -> DataFrame:
    """The documents with every span, overlapping ones as one, replaced by ``mask``; all columns stay."""
    found = _found(docs, rules, text, key)
    t = F.col("row")[text]
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("end"))
    step = lambda acc, s: F.when(s["start"] >= acc["end"], F.struct(
        F.concat(acc["out"], F.substring(t, acc["end"] + 1, s["start"] - acc["end"]), F.lit(mask)).alias("out"),
        s["end"].alias("end"))).otherwise(F.struct(
            acc["out"].alias("out"), F.greatest(acc["end"], s["end"]).alias("end")))
    masked = F.aggregate("found", start, step, lambda acc: F.concat(
        acc["out"], F.substring(t, acc["end"] + 1, F.length(t))))
    new = F.when(F.size("found") == 0, t).otherwise(masked)
    return found.select(*[(new if c == text else F.col("row")[c]).alias(c) for c in docs.columns])
