"""Quality rules: a threshold table compiled into one Spark projection.

Everything is a built-in expression; no function of ours runs on the executors and
nothing is shuffled. Metrics are counts of the whole text, rules are ratios of two
metrics with a lower and an upper bound.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import whole_text

SPACE, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
#: Languages with listed function words, and their frequent function words (fixed values).
STOP_LANGS = ("en", "de", "fr", "es")
STOP_WORDS = ("the of and to in a is that for it was on are as with be this by from or an at not "
              "der die das und ist von zu mit den ein eine auf für nicht sich des im dem als "
              "le la les des et de du un une est dans que pour qui sur pas au avec par "
              "el los las y en por con para se del una no al lo como").split()


@dataclass(frozen=True)
class Rule:
    name: str
    metric: str
    per: str
    least: float | None = None
    most: float | None = None
    langs: tuple[str, ...] | None = None    # the rule holds for texts of these languages only


RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.25),
    Rule("exclamations", "n_exclaims", "n_words", None, 0.5),
    Rule("stop_words", "n_stop_words", "n_words", 0.02, None, STOP_LANGS),
    Rule("duplicate_lines", "n_dup_chars", "n_line_chars", None, 0.3),
)
METRICS = ("n_words", "word_chars", "n_symbols", "n_exclaims", "n_stop_words", "n_lines", "n_dup_lines", "n_line_chars",
           "n_dup_chars", "n_repeat_words")
#: The base rules of the contract.
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 50, 50, 3
_INDEX_BITS = 20


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " ", -1), "")


def _neighbours(sorted_keys: Column, key) -> Column:
    """Elements of a sorted array whose key is also that of an element beside it."""
    return F.filter(sorted_keys, lambda x, i: (key(x) == key(F.get(sorted_keys, i + 1)))
                    | ((i > 0) & (key(x) == key(F.get(sorted_keys, i - 1)))))


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Window hashes, cut to 44 bits and packed with the position, are sorted as
    longs; only windows whose cut hash repeats are compared as text. Texts of 2^20
    words or more skip the packed step. Covered words are counted from the sorted
    positions: each window adds as many words as lie before the next one, three at
    most.
    """
    def window(i):
        return F.concat_ws(" ", *[F.get(words, i + k) for k in range(WINDOW)])

    def covered(places: Column) -> Column:
        return let(F.sort_array(places), lambda p: F.coalesce(F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)).cast("int"))),
            F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long")))

    def verified(places: Column) -> Column:
        pairs = F.sort_array(F.transform(places, lambda i: F.struct(window(i.cast("int")).alias("w"), i.alias("i"))))
        return let(pairs, lambda p: covered(F.transform(_neighbours(p, lambda x: x["w"]), lambda x: x["i"])))

    size = F.size(words)
    at = F.sequence(F.lit(0), size - WINDOW)
    low = F.lit((1 << _INDEX_BITS) - 1)
    packed = F.sort_array(F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
                                      .bitwiseAND(F.bitwise_not(low.cast("long"))).bitwiseOR(i.cast("long"))))
    by_hash = let(packed, lambda p: F.transform(_neighbours(p, lambda x: F.shiftright(x, _INDEX_BITS)),
                                                lambda x: x.bitwiseAND(low)))
    return (F.when(size < WINDOW, F.lit(0).cast("long"))
            .when(size < (1 << _INDEX_BITS), let(by_hash, lambda c: F.when(F.size(c) == 0, F.lit(0).cast("long")).otherwise(verified(c))))
            .otherwise(verified(F.transform(at, lambda i: i.cast("long")))))


def _count_of(text: Column, characters: str) -> Column:
    left = text
    for c in characters:
        left = F.replace(left, F.lit(c), F.lit(""))
    return (F.char_length(text) - F.char_length(left)).cast("long")


def _metrics(text: Column, words: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    stop = F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))
    def size(ls: Column) -> Column:
        return F.char_length(F.array_join(ls, "")).cast("long")

    return let(lines, lambda ls: let(F.array_distinct(ls), lambda once: F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        _count_of(text, SYMBOLS).alias("n_symbols"), _count_of(text, "!").alias("n_exclaims"),
        F.size(stop).cast("long").alias("n_stop_words"), F.size(ls).cast("long").alias("n_lines"),
        (F.size(ls) - F.size(once)).cast("long").alias("n_dup_lines"),
        size(ls).alias("n_line_chars"), (size(ls) - size(once)).alias("n_dup_chars"),
        _repeat_words(words).alias("n_repeat_words"))))


def compile_rules(metrics: Column, rules=RULES, lang: Column | None = None) -> Column:
    """True where every rule holds; a ratio over nothing counts as zero. A rule of some
    languages holds for every text whose language is another one or not known."""
    spoken = F.lit(None).cast("string") if lang is None else F.split(F.lower(F.trim(lang.cast("string"))), "[-_]", -1)[0]
    ok = F.lit(True)
    for r in rules:
        bound = F.lit(True)
        ratio = F.when(metrics[r.per] > 0, metrics[r.metric] / metrics[r.per]).otherwise(F.lit(0.0))
        if r.least is not None:
            bound = bound & (ratio >= r.least)
        if r.most is not None:
            bound = bound & (ratio <= r.most)
        ok = ok & (bound if r.langs is None else bound | ~F.coalesce(spoken.isin(*r.langs), F.lit(False)))
    return ok


def verdict(text: Column, rules=RULES, lang: Column | None = None) -> Column:
    """Struct of the metrics, base_failed and kept, for a text column and that of its language."""
    def judged(m: Column) -> Column:
        failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
        return F.struct(*[m[n].alias(n) for n in METRICS], failed.alias("base_failed"),
                        (~failed & compile_rules(m, rules, lang)).alias("kept"))

    return let(text, lambda t: let(_words(t), lambda w: let(_metrics(t, w), judged)))


def _lang(docs: DataFrame) -> Column | None:
    return F.col("lang") if "lang" in docs.columns else None


def score_quality(docs: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, the metrics, base_failed, kept: one row per row of ``docs``.

    Null and empty texts have no words and fail the base rule. Repeated rows each
    keep a row; other columns than ``lang`` (where there is one) are ignored.
    """
    judged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), verdict(whole_text(), rules, _lang(docs)).alias("q"))
    return judged.select("doc_id", "q.*")


def keep_good(docs: DataFrame, rules=RULES) -> DataFrame:
    """The rows of ``docs`` whose text is kept, all columns as they are."""
    return docs.filter(verdict(whole_text(), rules, _lang(docs))["kept"])


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, string_split_regex(lower(trim(lang)), '[-_]')[1] AS spoken,
    list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')) AS ls
  FROM documents),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY doc_id),
m AS (SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    length(t) - length(replace(t, '!', '')) AS n_exclaims,
    len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS n_stop_words, len(ls) AS n_lines,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, length(array_to_string(ls, '')) AS n_line_chars,
    length(array_to_string(ls, '')) - length(array_to_string(list_distinct(ls), '')) AS n_dup_chars,
    coalesce(c.n, 0) AS n_repeat_words, spoken
  FROM d LEFT JOIN c ON d.doc_id = c.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {rules} AS kept
FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
"""


def oracle_sql(rules=RULES) -> str:
    parts = []
    for r in rules:
        ratio = f"(CASE WHEN {r.per} > 0 THEN {r.metric}::DOUBLE / {r.per} ELSE 0 END)"
        bounds = [f"{ratio} >= {r.least}"] if r.least is not None else []
        bounds += [f"{ratio} <= {r.most}"] if r.most is not None else []
        held = " AND ".join(bounds)
        if r.langs is not None:
            listed = ", ".join(f"'{x}'" for x in r.langs)
            held = f"({held} OR NOT coalesce(spoken IN ({listed}), false))"
        parts.append(held)
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    return ORACLE.replace("{stop}", stop).replace("{rules}", " AND ".join(parts))
