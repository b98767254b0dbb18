"""Quality rules: a threshold table compiled into one projection of built-in functions.

A rule bounds one measure, or one measure as a share of another, in whole hundredths:
``low * of <= 100 * measure <= high * of``. The same table compiles to Spark columns and to SQL text.

Words are runs of characters other than ASCII space; lines are split at newlines and count if they
have a word. Defined results: null and empty texts have zero for every measure and fail the base rule.
Extra columns do not matter; rows with equal ids are scored each on their own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Least share of stop words among the words.
STOP_PERCENT = 4
#: Frequent function words of the corpus languages (fixed values).
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "with"],
    "de": ["der", "die", "und", "das", "zu", "den", "mit", "von"],
    "fr": ["de", "la", "le", "les", "et", "des", "que", "pour"],
    "es": ["de", "la", "el", "los", "que", "y", "en", "por"],
}


@dataclass(frozen=True)
class Rule:
    name: str
    measure: str
    of: str | None = None
    low: int | None = None
    high: int | None = None


#: Fails of the contract's base, then what the method adds.
BASE = (Rule("too_short", "n_words", low=2000), Rule("repeats_itself", "n_repeat_words", "n_words", high=30))
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", low=200, high=2000),
    Rule("symbols_per_word", "n_symbols", "n_words", high=50),
    Rule("stop_words", "n_stop_words", "n_words", low=STOP_PERCENT),
    Rule("copied_lines", "n_dup_lines", "n_lines", high=60),
    Rule("unfinished_lines", "n_ellipsis_lines", "n_lines", high=60),
    Rule("long_lines_only_symbols", "n_symbols", "word_chars", high=20),
)


def fails(rule: Rule) -> Column:
    of = F.col(rule.of) if rule.of else F.lit(1)
    value, bad = 100 * F.col(rule.measure), F.lit(False)
    if rule.low is not None:
        bad = bad | (value < rule.low * of)
    if rule.high is not None:
        bad = bad | (value > rule.high * of)
    return bad


def fails_sql(rule: Rule) -> str:
    of = rule.of or "1"
    bad = []
    if rule.low is not None:
        bad.append(f"100 * {rule.measure} < {rule.low} * {of}")
    if rule.high is not None:
        bad.append(f"100 * {rule.measure} > {rule.high} * {of}")
    return f"({' OR '.join(bad)})"


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words covered by windows of that many words that occur twice or more in the array."""
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - window), lambda i: F.xxhash64(F.slice(words, i + 1, window)))

    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def marked(p: Column) -> Column:
            same = lambda j, k: F.coalesce(F.get(p, j)["x"] == F.get(p, k)["x"], F.lit(False))
            hit = F.filter(p, lambda _, j: same(j, j - 1) | same(j, j + 1))
            return F.sort_array(F.transform(hit, lambda s: s["i"]))

        def total(at: Column) -> Column:
            steps = F.transform(at, lambda i, k: F.least(F.lit(window), F.coalesce(F.get(at, k + 1) - i, F.lit(window))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, s: a + s)

        return bind(bind(pairs, marked), total)

    return F.when(F.size(words) < window, F.lit(0).cast("long")).otherwise(
        bind(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))
    )


def bind(value: Column, body) -> Column:
    """body(value) with value computed once: a lambda over a one-element array."""
    return F.get(F.transform(F.array(value), body), 0)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_ellipsis_lines", "n_stop_words", "n_repeat_words")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _stop_words() -> list[str]:
    return sorted({w for x in STOP_WORDS.values() for w in x})


def measures(df: DataFrame, text_col: str = "text", replaced: tuple[str, ...] = ()) -> DataFrame:
    """df with every measure that rules use; columns of these names, and replaced ones, give way."""
    names = [c for c in df.columns if c == text_col or c not in (*MEASURES, *replaced)]
    # the input's columns go into one struct, so that none clashes with those used here
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, WORD_BREAK), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    rows = df.select(F.struct(*names).alias("row"), text.alias("_text"), words.alias("_words"), lines.alias("_lines"))
    size = lambda c: F.size(c).cast("long")
    found = {
        "n_words": size("_words"),
        "word_chars": F.length(F.translate("_text", SPACES, "")).cast("long"),
        "n_symbols": (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long"),
        "n_lines": size("_lines"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_ellipsis_lines": size(F.filter("_lines", lambda x: F.rtrim(x).endswith("..."))),
        "n_stop_words": size(F.filter("_words", lambda w: F.translate(w, _UPPER, _LOWER).isin(*_stop_words()))),
        "n_repeat_words": repeated_words(F.col("_words")),
    }
    rows = rows.select("row", F.struct(*(v.alias(k) for k, v in found.items())).alias("measured"))
    return rows.select(*(F.col(f"row.`{c}`").alias(c) for c in names), "measured.*")


def judge(df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """df with the measures, base_failed, failed_rules (names) and kept."""
    df = measures(df, text_col, ("base_failed", "failed_rules", "kept"))
    base, more = ([F.when(fails(r), F.lit(r.name)) for r in x] for x in (BASE, rules))
    df = df.withColumn("base_failed", F.size(F.array_compact(F.array(*base))) > 0)
    df = df.withColumn("failed_rules", F.array_compact(F.array(*base, *more)))
    return df.withColumn("kept", F.size("failed_rules") == 0)


def sql(table: str = "documents") -> str:
    stop = ", ".join(f"'{w}'" for w in _stop_words())
    base, more = (" OR ".join(map(fails_sql, x)) for x in (BASE, RULES))
    return rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM {table}),
w AS (SELECT doc_id, x, list_filter(regexp_split_to_array(x, '{WORD_BREAK}'), lambda v: v <> '') AS ws,
  list_filter(string_split(x, chr(10)), lambda v: regexp_matches(v, '[^\x20\x09-\x0D]')) AS ls FROM t),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW})))::BIGINT AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM r) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
  (length(x) - length(regexp_replace(x, '[{SYMBOLS}]', '', 'g')))::BIGINT AS n_symbols,
  len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
  len(list_filter(ls, lambda v: rtrim(v) LIKE '%...'))::BIGINT AS n_ellipsis_lines,
  len(list_filter(ws, lambda v: translate(v, '{_UPPER}', '{_LOWER}') IN ({stop})))::BIGINT AS n_stop_words,
  coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN c ON w.doc_id = c.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({base}) AS base_failed, NOT ({base} OR {more}) AS kept FROM m"""
