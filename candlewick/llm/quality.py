"""Quality rules as one compiled projection.

A threshold table (name, numerator, denominator, bounds) is compiled into
boolean columns of a single Spark projection; no user functions. Counts are
exact over whole texts:

* words are runs of anything but ASCII white space;
* ``n_dup_lines``: ``\\n``-split lines with a word that equal an earlier line;
* ``n_repeat_words``: word positions covered by a three-word window that occurs
  at least twice in the text (first occurrence included, positions counted once).

Null or empty texts have no words and fail the base rule; rows are judged one by
one, so repeats and ties need no rule; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import let, table, without

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
SYMBOLS = r"[#*$%&|<>]"

# Stop words of the four languages served, in lower case.
STOP_WORDS = (
    "the be to of and that have with is in it for was on are as at by this from "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine "
    "de la que el en y a los del se las por un para con no una su al lo "
    "le les et des est dans qui au pour pas sur du une par ce il avec").split()


@dataclass(frozen=True)
class Rule:
    """Keep a text when ``low <= numerator / denominator <= high``."""
    name: str
    numerator: str
    denominator: str | None = None
    low: float | None = None
    high: float | None = None


# Thresholds: length, symbol, stop-word and line ratios.
RULES = (
    Rule("words", "n_words", None, 50, None),
    Rule("word_length", "word_chars", "n_words", 3, 12),
    Rule("symbols", "n_symbols", "n_words", None, 0.1),
    Rule("stop_words", "n_stop_words", "n_words", 0.02, None),
    Rule("dup_lines", "n_dup_lines", "n_lines", None, 0.4),
    Rule("repeat_words", "n_repeat_words", "n_words", None, 0.4),
    Rule("letters", "n_letters", "word_chars", 0.7, None),
    Rule("capitals", "n_capitals", "n_letters", None, 0.3),
    Rule("end_marks", "n_marks", "n_words", None, 0.4),
)


def _repeat_words(words: Column) -> Column:
    """Word positions inside a 3-word window that occurs twice or more.

    Windows become longs (32 hash bits above a 30-bit position), which sort
    fast; neighbours less than 2^30 apart are candidates and hold every repeat.
    Candidates alone are sorted again by their full 64-bit hash and kept when a
    neighbour's is equal. n log n in the text's words."""
    unit = 1 << 30

    def window(w, i):
        return F.xxhash64(w[i], w[i + 1], w[i + 2])

    def packed(w):
        return F.sort_array(F.transform(
            F.slice(w, 1, F.size(w) - 2),
            lambda x, i: F.xxhash64(x, w[i + 1], w[i + 2]).bitwiseAND(F.lit((1 << 32) - 1)) * unit + i))

    def candidates(w):
        near = let(packed(w), lambda s: F.filter(
            s, lambda x, j: (x - F.get(s, j - 1) < unit) | (F.get(s, j + 1) - x < unit)))
        return F.sort_array(F.transform(near, lambda x: let((x % unit).cast("int"), lambda i: F.struct(
            window(w, i).alias("h"), i.alias("i")))))

    def repeated(s):
        return F.sort_array(F.transform(
            F.filter(s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])),
            lambda x: x["i"]))

    def covered(r):
        # Sorted positions: a window adds the words that the one before it lacks.
        return F.aggregate(r, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
                           lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n")),
                           lambda a: a["n"])

    found = let(words, lambda w: F.when(F.size(w) < 4, F.array().cast("array<struct<h:bigint,i:int>>"))
                .otherwise(candidates(w)))
    return let(found, lambda s: covered(repeated(s)))


COUNTS = frozenset("n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_stop_words n_letters n_capitals "
                   "n_marks".split())


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts the rules use; columns of their names are replaced."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    own = [c for c in df.columns if c.lower() not in COUNTS]
    d = df.select(*(F.col(f"`{c}`") for c in own), t.alias("__t"), words.alias("__w"), lines.alias("__l"))
    t = F.col("__t")
    w, ln = F.col("__w"), F.col("__l")
    counts = {
        "n_words": F.size(w),
        "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": F.length(t) - F.length(F.regexp_replace(t, SYMBOLS + "+", "")),
        "n_lines": F.size(ln),
        "n_dup_lines": F.size(ln) - F.size(F.array_distinct(ln)),
        "n_repeat_words": _repeat_words(w),
        "n_stop_words": F.size(F.filter(w, lambda x: F.lower(x).isin(*dict.fromkeys(STOP_WORDS)))),
        "n_letters": F.length(t) - F.length(F.regexp_replace(t, r"\p{L}+", "")),
        "n_capitals": F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}+", "")),
        "n_marks": F.length(t) - F.length(F.regexp_replace(t, r"[.!?]+", "")),
    }
    return d.select(*(F.col(f"`{c}`") for c in own), *(c.cast("long").alias(n) for n, c in counts.items()))


def compile_rules(rules=RULES) -> dict[str, Column]:
    """Name -> boolean column (true: passes). A rule whose denominator is zero
    passes; the length rule catches such texts."""
    out = {}
    for r in rules:
        v = F.col(r.numerator).cast("double")
        if r.denominator:
            v = v / F.nullif(F.col(r.denominator), F.lit(0))
        ok = F.lit(True)
        if r.low is not None:
            ok = ok & (v >= r.low)
        if r.high is not None:
            ok = ok & (v <= r.high)
        out[r.name] = F.coalesce(ok, F.lit(True))
    return out


def judge(df: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """All counts, ``base_failed``, ``failed_rules`` and ``kept``; columns of
    these names are replaced."""
    m = measure(without(df, "base_failed", "failed_rules", "kept"), text)
    checks = compile_rules(rules)
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT)
    failed = F.filter(F.array(*(F.when(~c, F.lit(n)) for n, c in checks.items())), lambda x: x.isNotNull())
    return m.select("*", base.alias("base_failed"), failed.alias("failed_rules"),
                    (~base & (F.size(failed) == 0)).alias("kept"))


def keep_good(df: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows that pass, with their own columns."""
    named = df.select(F.struct("*").alias("__row"), F.col(text).alias("__text"))
    # The non-deterministic column holds the filter above the counts; pushed
    # below them it would repeat every count for every rule that uses it.
    judged = judge(named, "__text", rules).select("__row", "kept", F.monotonically_increasing_id().alias("__n"))
    return judged.where("kept AND __n >= 0").select("__row.*")


def op8_quality_rules(spark, sf_dir) -> DataFrame:
    """Counts and verdict for every document."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(d).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           "base_failed", "kept")


def _sql_rule(r: Rule) -> str:
    v = f"CAST({r.numerator} AS DOUBLE)" + (f" / nullif({r.denominator}, 0)" if r.denominator else "")
    bounds = [f"{v} >= {r.low}"] * (r.low is not None) + [f"{v} <= {r.high}"] * (r.high is not None)
    return f"coalesce({' AND '.join(bounds)}, TRUE)"


_STOP_LIST = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
SQL = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), a AS (
  SELECT doc_id, t,
         list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM t
), g AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM a)
), r AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
        FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1)
  GROUP BY doc_id
), m AS (
  SELECT a.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(list_filter(w, lambda x: lower(x) IN ({_STOP_LIST}))) AS n_stop_words,
         length(t) - length(regexp_replace(t, '\p{{L}}', '', 'g')) AS n_letters,
         length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) AS n_capitals,
         length(t) - length(regexp_replace(t, '[.!?]', '', 'g')) AS n_marks
  FROM a LEFT JOIN r USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words)
         AND {" AND ".join(_sql_rule(r) for r in RULES)} AS kept
FROM m
"""
