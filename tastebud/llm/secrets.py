"""Secret scans through a trigram inverted index.

``trigram_query`` derives from each rule's regular expression a Boolean query:
a conjunction of alternatives, each a set of trigrams that must all occur in
any text with a match.  ``build_index`` stores, for every trigram that a query
mentions, its posting list (partitioned by trigram); the lists of each
alternative are intersected, and only candidates are verified with the regular
expression.  Rules without mandatory trigrams scan every text.

All of it runs on built-in functions.  Matches and the text between them are
split with the same expression, so the code-point spans follow from lengths.

Defined results: null and empty texts have no spans; ids may be null or repeat
(candidates are looked up null-safely and every row is verified by itself);
an empty table gives no rows; extra columns are left alone.
"""

from __future__ import annotations

import re._constants as C
import re._parser as parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import stored, unused


@dataclass(frozen=True)
class SecretRule:
    """``pattern`` finds leftmost non-overlapping matches; a match whose ``group`` is shorter than
    ``min_length`` characters is dropped."""

    kind: str
    pattern: str
    min_length: int = 0
    group: int = 0


#: The contract's kinds, in the order in which spans at the same start are listed (fixed values).
BASE_RULES = (
    SecretRule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    SecretRule("access", r"AKIA[A-Z0-9]+", 16),
    SecretRule("hex", r"[0-9a-f]+", 32),
)

#: Further kinds of the method (fixed values: public token formats).
MORE_RULES = (
    SecretRule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    SecretRule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("google", r"AIza[A-Za-z0-9_-]{35}"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    SecretRule("stripe", r"sk_live_[A-Za-z0-9]{16,}"),
    SecretRule("url", r"://[^/\s:@]{1,64}:[^/\s:@]{3,64}@"),
)

RULES = BASE_RULES + MORE_RULES
#: More alternatives than this fall back to no condition for that part.
MAX_WORDS = 32
#: Code points of the pieces into which a text is cut to be redacted.
PIECE = 1024


def _words(tree) -> list[tuple[set[str] | None, bool]]:
    """Parts of a parsed expression: the few literal strings a part can match, or None; and whether it is mandatory."""
    parts: list[tuple[set[str] | None, bool]] = []
    for op, arg in tree:
        if op is C.LITERAL:
            parts.append(({chr(arg).lower()}, True))
        elif op is C.SUBPATTERN:
            parts.extend(_words(arg[3]))
        elif op is C.BRANCH:
            found: set[str] | None = set()
            for branch in arg[1]:
                words = _joined(branch)
                found = None if found is None or words is None else found | words
            parts.append((found, True))
        elif op is C.IN and all(x[0] is C.LITERAL for x in arg):
            parts.append(({chr(x[1]).lower() for x in arg}, True))
        elif op is C.MAX_REPEAT and arg[0] == 0 and arg[1] == 1 and (w := _joined(arg[2])) is not None:
            parts.append((w | {""}, True))
        elif op is C.MAX_REPEAT and arg[0] >= 1:
            parts.extend(_words(arg[2]))
            parts.append((None, False))
        else:
            parts.append((None, False))
    return parts


def _joined(tree) -> set[str] | None:
    out = {""}
    for words, _ in _words(tree):
        if words is None:
            return None
        out = {a + b for a in out for b in words}
        if len(out) > MAX_WORDS:
            return None
    return out


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """Conjunction of alternatives of trigram sets that every match (lower-cased) satisfies; [] if none is mandatory."""
    query: list[list[frozenset[str]]] = []

    def close(run: set[str]) -> None:
        if run and min(map(len, run)) >= 3:
            sets = {frozenset(w[i:i + 3] for i in range(len(w) - 2)) for w in run}
            # a set that holds another one adds nothing to their disjunction
            query.append(sorted((x for x in sets if not any(y < x for y in sets)), key=sorted))

    run = {""}
    for words, _ in _words(parser.parse(pattern)):
        if words is None or len(run) * len(words) > MAX_WORDS:
            close(run)
            run = {""} if words is None else words
        else:
            run = {a + b for a in run for b in words}
    close(run)
    return query


def build_index(df: DataFrame, trigrams: list[str], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Posting lists (trigram, id) of the given trigrams over lower-cased texts, stored by trigram."""
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    held = F.array_compact(F.array(*[F.when(F.contains(F.col("t"), F.lit(x)), F.lit(i)) for i, x in enumerate(trigrams)]))
    postings = df.select(F.col(id_col).alias("id"), low.alias("t")).select("id", F.explode(held).alias("trigram"))
    return stored(postings.select("trigram", "id"), "trigrams", ("trigram",))


def candidates(index: DataFrame, trigrams: list[str], queries: dict[int, list[list[frozenset[str]]]]) -> DataFrame:
    """Ids with the rules whose Boolean query their postings satisfy: (id, rules)."""
    number = {x: i for i, x in enumerate(trigrams)}
    rows = [(rule, k, a, len(alt), number[x]) for rule, query in queries.items()
            for k, clause in enumerate(query) for a, alt in enumerate(clause) for x in sorted(alt)]
    clauses = index.sparkSession.createDataFrame(rows, "rule int, clause int, alt int, need long, trigram int")
    whole = {rule: len(query) for rule, query in queries.items()}
    size = F.create_map(*[F.lit(v) for kv in whole.items() for v in kv])
    # intersection of an alternative's lists: an id that stands in all of them
    met = (index.join(F.broadcast(clauses), "trigram").groupBy("id", "rule", "clause", "alt")
           .agg(F.countDistinct("trigram").alias("n"), F.max("need").alias("need")).where("n = need"))
    every = met.groupBy("id", "rule").agg(F.countDistinct("clause").alias("n")).where(F.col("n") == size[F.col("rule")])
    return every.groupBy("id").agg(F.collect_set("rule").alias("rules"))


def _with(value: Column, use) -> Column:
    """``use`` applied to a value that is computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def running(values: Column, join) -> Column:
    """Running totals of an array under the associative ``join``, by doubling distances: n log n steps."""
    far = F.array(*[F.lit(1 << k) for k in range(31)])

    def step(acc, d):
        return F.transform(acc, lambda x, i: F.when(i >= d, join(F.get(acc, i - d), x)).otherwise(x))

    return _with(values, lambda v: F.aggregate(F.filter(far, lambda d: d < F.size(v)), v, step))


def spans(text: Column, rule: SecretRule, number: int) -> Column:
    """Kept matches of one rule as array<struct<start, kind, end>> in code points."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    between = F.transform(F.split(text, rule.pattern, -1), F.length)
    measured = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    # split gives one part more than there are matches
    sized = F.arrays_zip(F.slice(between, 1, F.size(between) - 1).alias("gap"),
                         F.transform(found, F.length).alias("len"), F.transform(measured, F.length).alias("own"))

    def placed(parts):
        ends = running(F.transform(parts, lambda x: x["gap"] + x["len"]), lambda x, y: x + y)
        every = F.zip_with(parts, ends, lambda x, end: F.struct(
            (end - x["len"]).alias("start"), F.lit(number).alias("kind"), end.alias("end"), x["own"].alias("own")))
        kept = F.filter(every, lambda x: x["own"] >= rule.min_length)
        return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))

    return _with(sized, placed)


def scan(df: DataFrame, id_col: str = "doc_id", text: str = "text", rules: tuple[SecretRule, ...] = RULES,
         out: str = "secrets") -> DataFrame:
    """Add ``out``: array<struct<start, kind, end>>, sorted by start, then by the rules' order; it replaces a column of that name."""
    queries = {i: q for i, r in enumerate(rules) if (q := trigram_query(r.pattern))}
    trigrams = sorted({x for q in queries.values() for clause in q for alt in clause for x in alt})
    index = build_index(df, trigrams, id_col, text)
    row_id, row_rules = unused(f"{out}_id", df), unused(f"{out}_rules", df)
    found = candidates(index, trigrams, queries).select(F.col("id").alias(row_id), F.col("rules").alias(row_rules))
    joined = df.join(found, F.col(id_col).eqNullSafe(F.col(row_id)), "left")
    t = F.coalesce(F.col(text), F.lit(""))
    none = F.filter(F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("kind"), F.lit(0).alias("end"))),
                    lambda x: F.lit(False))
    per_rule = []
    for i, rule in enumerate(rules):
        may = F.array_contains(row_rules, i) if i in queries else F.lit(True)
        # a full scan first asks for one long enough match, which most texts lack
        if i not in queries and rule.pattern.endswith("+") and rule.min_length:
            may = t.rlike(f"{rule.pattern[:-1]}{{{rule.min_length}}}")
        per_rule.append(F.when(F.coalesce(may, F.lit(False)), spans(t, rule, i)).otherwise(none))
    return joined.withColumn(out, F.array_sort(F.concat(*per_rule))).drop(row_id, row_rules)


def render(found: Column, rules: tuple[SecretRule, ...] = RULES) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(df: DataFrame, text: str = "text", found: str = "secrets", mark: str = "[SECRET]") -> DataFrame:
    """Replace every span of ``found`` in ``text`` by ``mark`` (overlapping spans by one).

    The text is cut into pieces of ``PIECE`` code points once, so what stands between two spans
    costs its own length and two pieces, wherever it stands.
    """
    pieces = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def between(cut, a, b):
        first = F.floor(a / PIECE).cast("int")
        held = F.slice(cut, first + 1, F.floor(b / PIECE).cast("int") - first + 1)
        return F.substring(F.array_join(held, ""), a - first * PIECE + 1, b - a)

    def kept(both):
        cut, reach = both["cut"], both["reach"]
        before = lambda i: F.when(i > 0, F.get(reach, i - 1)).otherwise(0)
        heads = F.filter(F.transform(found, lambda x, i: F.struct(before(i).alias("a"), x["start"].alias("b"))),
                         lambda x: x["b"] >= x["a"])
        gaps = F.transform(heads, lambda x: between(cut, x["a"], x["b"]))
        last = between(cut, F.element_at(reach, -1), both["n"])
        return F.array_join(F.concat(gaps, F.array(last)), mark)

    ends = running(F.transform(found, lambda x: x["end"]), F.greatest)
    clean = _with(F.struct(pieces.alias("cut"), ends.alias("reach"), F.length(text).alias("n")), kept)
    return df.withColumn(text, F.when(F.size(found) > 0, clean).otherwise(F.col(text)))
