"""Quality rules: a table of thresholds, compiled into one Spark projection without user functions.

A rule bounds one ratio of two measures, in thousandths, so that every verdict is
integer arithmetic.  The measures are counted with built-in functions over whole
texts: words are ``[^\\x20\\x09-\\x0D]+``, lines are parted by ``\\n`` and count
when they hold a word, characters are code points.

``n_repeat_words`` counts the words that lie in an eight-word window found twice or
more in the text.  Windows are compared by one hash first, which is all that a
text without repeats costs; where a hash comes twice, the windows are sorted by
two hashes and neighbours are compared word by word.

Defined results: null and empty texts have no words, so they fail the base rules;
a ratio over an empty whole breaks no rule (``0 <= 0``); repeated rows and ties
are separate rows with equal results; ids may be null; an empty table gives an
empty result; ``quality_rules`` ignores extra columns and ``select_by_rules`` keeps
them, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Frequent function words of the four languages.
STOP_WORDS = (
    "the", "be", "to", "of", "and", "that", "have", "with", "in", "is", "it", "for", "on", "was", "as", "are",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "sich", "des", "auf", "für", "ist", "im", "nicht", "ein", "eine",
    "le", "la", "les", "de", "et", "des", "en", "un", "une", "du", "que", "est", "pour", "dans", "par", "qui",
    "el", "los", "las", "y", "del", "por", "con", "se", "no", "para", "una", "es", "al",
)


@dataclass(frozen=True)
class Rule:
    """``least <= 1000 * part / whole <= most``; ``whole`` None stands for one."""

    name: str
    part: str
    whole: str | None = None
    least: int | None = None
    most: int | None = None

    def broken(self) -> Column:
        part = 1000 * F.col(self.part)
        whole = F.col(self.whole) if self.whole else F.lit(1).cast("long")
        tests = [part < self.least * whole] if self.least is not None else []
        tests += [part > self.most * whole] if self.most is not None else []
        return tests[0] if len(tests) == 1 else tests[0] | tests[1]


#: What every document has to pass.
BASE_RULES = (
    Rule("few words", "n_words", least=20_000),
    Rule("repeated words", "n_repeat_words", "n_words", most=300),
)

#: The method's own verdict.
RULES = (
    Rule("word length", "word_chars", "n_words", least=2_000, most=14_000),
    Rule("symbols", "n_symbols", "n_words", most=100),
    Rule("stop words", "n_stop_words", "n_words", least=20),
    Rule("repeated lines", "n_dup_lines", "n_lines", most=500),
    Rule("bullet lines", "n_bullet_lines", "n_lines", most=900),
    Rule("cut lines", "n_cut_lines", "n_lines", most=300),
    Rule("capital lines", "n_capital_lines", "n_lines", most=500),
)


def stop_forms() -> list[str]:
    """The stop words as they stand in texts: small, capitalised and in capitals."""
    return sorted({f for w in STOP_WORDS for f in (w, w.capitalize(), w.upper())})


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _windows(n: Column) -> Column:
    """Numbers of the windows' first words, from 0."""
    return F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW)).otherwise(F.array().cast("array<int>"))


def _window(i: Column) -> Column:
    return F.slice(F.col("_words"), i + 1, WINDOW)


def _like(a: Column, b: Column) -> Column:
    """Whether two sorted entries are one window; the words decide."""
    return (a["h"] == b["h"]) & (a["g"] == b["g"]) & (_window(a["i"]) == _window(b["i"]))


def _repeats(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``_words``) and ``n_repeat_words``."""
    hashed = rows.withColumn("_hashes", F.transform(_windows(F.size("_words")), lambda i: F.xxhash64(_window(i))))
    entries = F.sort_array(F.transform(F.col("_hashes"), lambda h, i: F.struct(
        h.alias("h"), F.xxhash64(F.lit(WINDOW), _window(i)).alias("g"), i.alias("i"))))
    twice = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    sorted_ = hashed.withColumn("_sorted", F.when(twice, entries)).drop("_hashes")

    def repeated(x: Column, k: Column) -> Column:
        return F.coalesce(_like(x, F.get("_sorted", k - 1)), F.lit(False)) | F.coalesce(_like(x, F.get("_sorted", k + 1)), F.lit(False))

    firsts = F.sort_array(F.transform(F.filter("_sorted", repeated), lambda x: x["i"]))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def covered(acc: Column, i: Column) -> Column:
        return F.struct((i + WINDOW).alias("end"), (acc["n"] + i + WINDOW - F.greatest(i, acc["end"])).alias("n"))

    n = F.aggregate(firsts, start, covered, lambda acc: acc["n"])
    return sorted_.withColumn("n_repeat_words", F.coalesce(n, F.lit(0)).cast("long")).drop("_sorted")


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``_row`` (the row of ``docs``) and the measures of its text."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), text.alias("_text"))
    rows = rows.withColumn("_words", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)))
    rows = rows.withColumn("_lines", F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(WORD)))
    rows = _repeats(rows)

    def count(items: str, test) -> Column:
        return F.size(F.filter(items, test)).cast("long")

    return rows.select(
        "_row",
        F.size("_words").cast("long").alias("n_words"),
        F.length(_without(F.col("_text"), BLANKS)).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(_without(F.col("_text"), SYMBOLS))).cast("long").alias("n_symbols"),
        count("_words", lambda w: w.isin(stop_forms())).alias("n_stop_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        count("_lines", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•]")).alias("n_bullet_lines"),
        count("_lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$")).alias("n_cut_lines"),
        count("_lines", lambda x: x.rlike("[A-Z]") & ~x.rlike("[a-z]")).alias("n_capital_lines"),
        "n_repeat_words",
    )


def _names(rules: Sequence[Rule]) -> Column:
    """The names of the broken rules, comma-joined."""
    return F.concat_ws(",", *[F.when(r.broken(), F.lit(r.name)) for r in rules])


def judged(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES,
           base: Sequence[Rule] = BASE_RULES) -> DataFrame:
    """:func:`measured` rows with ``base_failed``, ``kept`` and ``failed``, the names of the broken rules."""
    rows = measured(docs, text_col).withColumn("failed", _names([*base, *rules]))
    return rows.withColumn("base_failed", _names(base) != "").withColumn("kept", F.col("failed") == "")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The base counts, the verdict and the broken rules of every row of ``docs``."""
    rows = judged(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("t")), "t", rules)
    return rows.select(F.col("_row.id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "kept", "failed")


def select_by_rules(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that break no rule, all columns as they were."""
    return judged(docs, text_col, rules).filter("kept").select("_row.*")


def rules_sql() -> str:
    """The registered query as DuckDB SQL, from the same tables of rules."""

    def broken(r: Rule) -> str:
        whole = r.whole or "1"
        tests = [f"1000 * {r.part} < {r.least} * {whole}"] if r.least is not None else []
        tests += [f"1000 * {r.part} > {r.most} * {whole}"] if r.most is not None else []
        return f"CASE WHEN {' OR '.join(tests)} THEN '{r.name}' END"

    stops = ", ".join(f"'{w}'" for w in stop_forms())
    blank = "translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')"
    names = {k: f"concat_ws(',', {', '.join(broken(r) for r in v)})" for k, v in (("base", BASE_RULES), ("every", (*BASE_RULES, *RULES)))}
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '{WORD}') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l FROM d),
win AS (SELECT r, p, w[p:p + {WINDOW - 1}] AS x FROM (SELECT r, w, unnest(generate_series(1, len(w) - {WINDOW - 1})) AS p FROM w)),
twice AS (SELECT r, unnest(ps) AS p FROM (SELECT r, list(p) AS ps FROM win GROUP BY r, x HAVING count(*) > 1)),
rep AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(generate_series(p, p + {WINDOW - 1})) AS q FROM twice) GROUP BY r),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length({blank}) AS BIGINT) AS word_chars,
             CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
             len(list_filter(w, lambda x: x IN ({stops}))) AS n_stop_words, len(l) AS n_lines,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             len(list_filter(l, lambda x: regexp_matches(x, '^[\\x20\\x09-\\x0D]*[-*•]'))) AS n_bullet_lines,
             len(list_filter(l, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$'))) AS n_cut_lines,
             len(list_filter(l, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_capital_lines,
             coalesce(rep.n, 0) AS n_repeat_words
      FROM w LEFT JOIN rep ON w.r = rep.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {names['base']} <> '' AS base_failed,
       {names['every']} = '' AS kept, {names['every']} AS failed
FROM m
"""
