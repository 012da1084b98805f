"""Quality rules: a threshold table compiled into one Spark projection.

Every metric is a built-in expression over one text, so a verdict needs no
shuffle and no user function. Null and blank texts have no words: all metrics
are 0, the word-count rule rejects them. Very long texts are measured whole. Repeated
rows get equal verdicts. An empty table gives an empty result. Other columns are
not read by `judge` and are kept by `keep`, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let, words

#: Symbols that count as markup or noise.
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Frequent function words of English, German, French, Spanish.
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "with", "on", "are", "as",
           "by", "be", "this", "an", "from", "or", "at"],
    "de": ["der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "ist", "für", "ein", "eine",
           "nicht", "als", "auf", "er", "im", "dem"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "est", "pour", "dans", "au", "sur",
           "par", "pas"],
    "es": ["el", "los", "las", "por", "con", "una", "del", "se", "y", "su", "al", "lo", "no"],
}


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high`` for texts of ``min_words`` or more words.

    Without a denominator the numerator itself is compared.
    """

    name: str
    numerator: str
    denominator: str | None = None
    low: float | None = None
    high: float | None = None
    min_words: int = 0


#: The default table; thresholds leave every ordinary text of the four languages in.
RULES = (
    Rule("length", "n_words", low=10),
    Rule("repeats", "n_repeat_words", "n_words", high=0.2),
    Rule("word_length", "word_chars", "n_words", low=1.5, high=25),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("stop_words", "n_stop_words", "n_words", low=0.01, min_words=50),
    Rule("line_repeats", "n_dup_lines", "n_lines", high=0.5, min_words=50),
)
#: The rules that the contract calls base; the others are this library's own.
BASE_RULES = ("length", "repeats")


def _repeat_words(w: Column) -> Column:
    """Words inside a window of five words that occurs at least twice.

    Windows are compared by XXH64 over their five words. Only texts with a
    repeated window pay for the sort that finds the positions.
    """
    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
            return F.transform(
                F.filter(s, lambda x, i: F.when(i == 0, F.lit(False)).otherwise(same(x, i - 1)) | same(x, i + 1)),
                lambda x: x["i"])

        start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        return F.aggregate(
            F.array_sort(let(pairs, repeated)), start,
            lambda acc, p: F.struct((p + WINDOW).alias("end"),
                                    (acc["n"] + F.least(F.lit(WINDOW), p + WINDOW - acc["end"])).alias("n")),
            lambda acc: acc["n"])

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered(hashes))

    hashes = F.transform(F.sequence(F.lit(1), F.size(w) - WINDOW + 1), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
    return F.when(F.size(w) < WINDOW, F.lit(0)).otherwise(let(hashes, count))


def metrics(text: Column, stop_words: dict[str, list[str]] = STOP_WORDS) -> Column:
    """A struct of long counts over one text."""
    t = F.coalesce(text, F.lit(""))
    stops = sorted({w for ws in stop_words.values() for w in ws})
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != "")

    def build(w: Column) -> Column:
        long = lambda c, name: c.cast("long").alias(name)
        return F.struct(
            long(F.size(w), "n_words"),
            long(F.length(F.translate(t, SPACE, "")), "word_chars"),
            long(F.length(t) - F.length(F.translate(t, SYMBOLS, "")), "n_symbols"),
            long(let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))), "n_dup_lines"),
            long(F.size(lines), "n_lines"),
            long(_repeat_words(w), "n_repeat_words"),
            long(F.size(F.filter(w, lambda x: x.isin(stops))), "n_stop_words"),
        )
    return let(words(t), build)


def _passes(rule: Rule, m: Column) -> Column:
    """The rule as a condition; ratios are compared by exact decimal products, so no division by zero."""
    base = F.lit(1) if rule.denominator is None else m[rule.denominator]
    ok = F.lit(True)
    if rule.low is not None:
        ok = ok & (m[rule.numerator] >= base * F.lit(Decimal(str(rule.low))))
    if rule.high is not None:
        ok = ok & (m[rule.numerator] <= base * F.lit(Decimal(str(rule.high))))
    return ok if not rule.min_words else (m["n_words"] < rule.min_words) | ok


def verdict(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct of the failed rules' names and the verdict."""
    failed = F.filter(F.array(*[F.when(~_passes(r, m), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    return let(failed, lambda f: F.struct(f.alias("failed"), (F.size(f) == 0).alias("kept")))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, metrics, ``failed`` (rule names) and ``kept``.

    Other input columns are not read, so their names cannot clash.
    """
    m = docs.select(F.col(key), metrics(F.col(text)).alias("m"))
    v = m.select(key, "m", verdict(F.col("m"), rules).alias("v"))
    return v.select(key, "m.*", "v.*")


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The documents that pass every rule, with all their columns."""
    return docs.where(let(metrics(F.col(text)), lambda m: verdict(m, rules))["kept"])
