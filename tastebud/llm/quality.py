"""Quality rules: a threshold table compiled into one projection.

Every metric is a built-in expression (length, symbols, stop words, lines), a
rule is a row of ``RULES`` (metric, smallest, largest), and ``quality_rules``
compiles the rows into the projection that gives each row its verdict.  No
user function runs and nothing is shuffled.

Defined results: a null or empty text has no words, so it fails ``min_words``;
a ratio over nothing is null, and a null metric fails no rule; repeated rows
and null ids each keep their own row; columns of the input that clash with a
metric name stay untouched because metrics live in one struct.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_GAP = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    name: str
    metric: str
    smallest: float | None = None
    largest: float | None = None


#: The contract's own failures: a base rule can not be relaxed by the others.
BASE_RULES = (
    Rule("min_words", "n_words", smallest=50),
    Rule("repeats", "repeat_excess", largest=0),
)

#: Thresholds of the method (fixed values; pass others as ``rules``).
RULES = (
    Rule("short_words", "chars_per_word", smallest=2.0),
    Rule("long_words", "chars_per_word", largest=15.0),
    Rule("symbols", "symbols_per_word", largest=0.5),
    Rule("stop_words", "stop_word_ratio", smallest=0.02),
    Rule("duplicate_lines", "dup_line_ratio", largest=0.5),
    Rule("bullet_lines", "bullet_line_ratio", largest=0.9),
    Rule("ellipsis_lines", "ellipsis_line_ratio", largest=0.3),
)

#: An upper length, for callers that want one: no rule above rejects a text for its length.
MAX_WORDS = Rule("max_words", "n_words", largest=100_000)

#: Frequent function words of English, German, French, Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "on", "was", "as", "with", "be", "by", "at",
    "this", "are", "from", "or", "an",
    "der", "die", "das", "und", "ist", "von", "den", "zu", "mit", "ein", "eine", "nicht", "im", "auf",
    "le", "la", "les", "de", "des", "et", "un", "une", "est", "que", "qui", "dans", "en", "pour", "du", "au",
    "el", "los", "las", "y", "del", "se", "con", "por", "su", "no", "una", "es",
)


def _let(value: Column, body) -> Column:
    """Bind ``value`` once for use in ``body`` (a lambda argument is evaluated a single time)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(w: Column) -> Column:
    """How many words lie in a 3-word window that occurs twice or more."""
    keyed = F.when(F.size(w) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))))

    def covered(s: Column) -> Column:
        same = lambda k, x: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        twice = F.filter(s, lambda x, k: (same(k + 1, x)) | ((k > 0) & same(F.greatest(k - 1, F.lit(0)), x)))
        at = F.sort_array(F.transform(twice, lambda x: x["i"]))
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        step = lambda acc, i: F.struct((acc["n"] + i + 3 - F.greatest(i, acc["end"])).alias("n"), (i + 3).alias("end"))
        return F.aggregate(at, zero, step, lambda acc: acc["n"])

    return F.coalesce(_let(F.sort_array(keyed), covered), F.lit(0))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Set column ``name`` to ``value``, evaluated once per row.

    A generator of one row: the optimizer neither merges it with later
    projections nor pushes a filter on ``name`` below it, either of which would
    evaluate ``value`` again for each of its uses.
    """
    return df.select(*[c for c in df.columns if c != name], F.explode(F.array(value)).alias(name))


def with_metrics(df: DataFrame, text: str = "text", metrics: str = "metrics") -> DataFrame:
    """Add the struct ``metrics`` of all counts and ratios."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(HAS_WORD))
    two = _once(df, metrics, F.struct(F.array_remove(F.split(t, WORD_GAP, -1), "").alias("w"), lines.alias("l")))
    w, ln = F.col(f"{metrics}.w"), F.col(f"{metrics}.l")
    bullets = F.filter(ln, lambda x: x.rlike("^[\\x20\\x09]*[-*•]"))
    dots = F.filter(ln, lambda x: x.rlike("(\\.\\.\\.|…)[\\x20\\x09]*$"))
    counts = _once(two, metrics, F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(t, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size(ln).cast("long").alias("n_lines"),
        (F.size(ln) - F.size(F.array_distinct(ln))).cast("long").alias("n_dup_lines"),
        F.size(bullets).cast("long").alias("n_bullet_lines"),
        F.size(dots).cast("long").alias("n_ellipsis_lines"),
        F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        repeated_words(w).cast("long").alias("n_repeat_words")))
    m = lambda name: F.col(f"{metrics}.{name}")
    per = lambda a, b: F.when(m(b) > 0, m(a) / m(b))
    return counts.withColumn(metrics, F.struct(
        f"{metrics}.*",
        (100 * m("n_repeat_words") - 50 * m("n_words")).alias("repeat_excess"),
        per("word_chars", "n_words").alias("chars_per_word"),
        per("n_symbols", "n_words").alias("symbols_per_word"),
        per("n_stop_words", "n_words").alias("stop_word_ratio"),
        per("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        per("n_bullet_lines", "n_lines").alias("bullet_line_ratio"),
        per("n_ellipsis_lines", "n_lines").alias("ellipsis_line_ratio")))


def broken(rule: Rule, metrics: str = "metrics") -> Column:
    """One row of the threshold table as a Boolean expression."""
    value, tests = F.col(f"{metrics}.{rule.metric}"), []
    if rule.smallest is not None:
        tests.append(value < F.lit(rule.smallest))
    if rule.largest is not None:
        tests.append(value > F.lit(rule.largest))
    out = tests[0]
    for x in tests[1:]:
        out = out | x
    return F.coalesce(out, F.lit(False))


def quality_rules(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES,
                  base: tuple[Rule, ...] = BASE_RULES, out: str = "quality") -> DataFrame:
    """Add the struct ``out``: all metrics, ``base_failed``, ``failed`` (names of broken rules), ``kept``."""
    measured = with_metrics(df, text, out)
    failed = F.filter(F.array(*[F.when(broken(r, out), F.lit(r.name)) for r in (*base, *rules)]),
                      lambda x: x.isNotNull())
    base_failed = broken(base[0], out)
    for r in base[1:]:
        base_failed = base_failed | broken(r, out)
    judged = measured.withColumn(out, F.struct(f"{out}.*", base_failed.alias("base_failed"), failed.alias("failed")))
    return _once(judged, out, F.struct(f"{out}.*", (F.size(F.col(f"{out}.failed")) == 0).alias("kept")))


def kept_rows(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES,
              base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Rows of ``df`` that break no rule."""
    return quality_rules(df, text, rules, base, "_quality").where("_quality.kept").select(*df.columns)
