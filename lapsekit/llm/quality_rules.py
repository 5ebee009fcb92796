"""Quality rules as a short-circuit cascade (DataFrame functions only).

Each rule is a boolean Column over the text: true rejects the document. Before the
full pass the rules are timed on a sample (cost: each row judged ``REPEATS`` times in one
job, the quickest of ``RUNS`` jobs, less the time of a job without a rule) and the sets of
rules that reject a row are counted (selectivity). The next rule is that of most rejections
per cost among the rows that no earlier rule rejects; the pass tests them in this order
in one CASE expression, so that most rejected documents leave after a cheap rule.
The order changes only the cost, never the verdict: a document is kept if no rule
rejects it.

Null text counts as empty. Repeated rows are judged one by one; an empty table
gives an empty result. Input columns other than the text are not read.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsekit.llm.common import drop_stored, let, n_words, stored, without_space, words

SYMBOLS = "#*$%&|<>"


def word_chars(text: Column) -> Column:
    """Code points in words."""
    return F.length(without_space(text)).cast("long")


def n_symbols(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    return (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    full = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.length(without_space(x)) > 0)
    return let(full, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(text: Column) -> Column:
    """Words within a window of three words that occurs twice or more in the text.

    Windows are compared by their 64-bit hash within the one document. Sorting
    (hash, position) brings equal windows together, so the cost is n log n in the
    words of the document, however often a window repeats.
    """
    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                           lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def repeated(s: Column) -> Column:  # s: sorted structs of hash and position
        twice = F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        state = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(p, state, lambda a, i: F.struct(
            (a["n"] + i + 3 - F.greatest(i, a["end"])).alias("n"), (i + 3).alias("end")), lambda a: a["n"])

    def count(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(pairs, lambda s: covered(repeated(s))))

    return let(words(text), lambda w: F.when(F.size(w) < 3, F.lit(0)).otherwise(let(windows(w), count))).cast("long")


@dataclass(frozen=True)
class Rule:
    """``rejects(text)`` is the condition from the text alone; ``from_features`` is the same
    from the columns of :func:`with_features`, where these are wanted anyway."""

    name: str
    rejects: Callable[[Column], Column]
    from_features: Callable[[], Column]
    base: bool = False


MIN_WORDS, MAX_REPEAT_PERCENT, MAX_SYMBOL_PERCENT = 50, 50, 10
MEAN_WORD_CHARS, MAX_DUP_LINE_PERCENT = (2, 15), 50


def _lines(text: Column) -> Column:
    return F.size(F.split(F.coalesce(text, F.lit("")), "\n", -1))


def _rule(name: str, cond: Callable[..., Column], *features: str, base: bool = False) -> Rule:
    return Rule(name, lambda t: cond(*(FEATURES[f](t) for f in features)),
                lambda: cond(*(F.col(f) for f in features)), base)


#: What the rules look at, each a Column of the text.
FEATURES: dict[str, Callable[[Column], Column]] = {
    "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines,
    "n_repeat_words": n_repeat_words, "n_lines": _lines}

RULES: tuple[Rule, ...] = (
    _rule("few_words", lambda n: n < MIN_WORDS, "n_words", base=True),
    _rule("repeated_words", lambda r, n: 100 * r > MAX_REPEAT_PERCENT * n, "n_repeat_words", "n_words", base=True),
    _rule("symbols", lambda s, n: 100 * s > MAX_SYMBOL_PERCENT * n, "n_symbols", "n_words"),
    _rule("word_length", lambda c, n: (c < MEAN_WORD_CHARS[0] * n) | (c > MEAN_WORD_CHARS[1] * n),
          "word_chars", "n_words"),
    _rule("repeated_lines", lambda d, k: 100 * d > MAX_DUP_LINE_PERCENT * k, "n_dup_lines", "n_lines"),
)

SAMPLE_ROWS = 2000  # the sample on which cost and selectivity are estimated; it decides the order only
REPEATS, RUNS = 2, 2
LEAST_SECONDS = 1e-3  # costs below this are not told apart


def _seconds(sample: DataFrame, condition: Column) -> float:
    """The quickest of ``RUNS`` jobs that evaluate the condition ``REPEATS`` times a row."""
    rows = sample.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))

    def once() -> float:
        job = rows.agg(F.count_if(condition))  # a new plan each time: one run again would reuse its shuffle
        began = time.monotonic()
        job.collect()  # one number
        return time.monotonic() - began

    return min(once() for _ in range(RUNS))


def best_order(costs: Sequence[float], rejected: Mapping[tuple[bool, ...], int]) -> list[tuple[int, float]]:
    """(rule's number, share of the rows it rejects among those that reach it), most rejections per cost first.

    ``rejected`` counts the rows by which rules reject them.
    """
    left, out = dict(rejected), []
    open_rules = list(range(len(costs)))
    while open_rules:
        hits = {k: sum(n for which, n in left.items() if which[k]) for k in open_rules}
        best = max(open_rules, key=lambda k: (hits[k] / max(costs[k], LEAST_SECONDS), -costs[k], -k))
        out.append((best, hits[best] / max(1, sum(left.values()))))
        left = {which: n for which, n in left.items() if not which[best]}
        open_rules.remove(best)
    return out


def measured_order(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text",
                   sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected of what reaches it) on about ``sample_rows`` random rows, in the order to test."""
    total = docs.count()
    if not total:
        return [(r, 0.0, 0.0) for r in rules]
    share = min(1.0, sample_rows / total)
    sample = stored(docs.select(F.col(text).alias("t")).sample(False, share, seed), "quality-sample")
    t = F.col("t")
    found = [_seconds(sample, r.rejects(t)) for r in rules]
    empty = _seconds(sample, F.length(t) < 0)  # last, when the session is as warm as it gets
    costs = [max(0.0, x - empty) for x in found]
    flags = [F.coalesce(r.rejects(t), F.lit(False)).alias(f"r{k}") for k, r in enumerate(rules)]
    counted = sample.select(*flags).groupBy(*(f"r{k}" for k in range(len(rules)))).count().collect()  # at most the sample's rows
    drop_stored(sample)
    return [(rules[k], costs[k], hit) for k, hit in best_order(costs, {tuple(r[:-1]): r["count"] for r in counted})]


def first_failed(ordered: Sequence[Rule], condition: Callable[[Rule], Column]) -> Column:
    """The name of the first rule that rejects, else null; later rules are not evaluated."""
    out = F.lit(None).cast("string")
    for r in reversed(ordered):
        out = F.when(condition(r), F.lit(r.name)).otherwise(out)
    return out


def filter_documents(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns as they are."""
    order = [r for r, _, _ in measured_order(docs, rules, text)]
    return docs.filter(first_failed(order, lambda r: r.rejects(F.col(text))).isNull())


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, the features, base_failed, failed_rule (first in the measured order) and kept."""
    order = [r for r, _, _ in measured_order(docs, rules, text)]
    f = docs.select(F.col(doc_id).alias("doc_id"), *(fn(F.col(text)).alias(k) for k, fn in FEATURES.items()))
    base = first_failed([r for r in rules if r.base], lambda r: r.from_features())
    failed = first_failed(order, lambda r: r.from_features())
    return f.withColumns({"base_failed": base.isNotNull(), "failed_rule": failed, "kept": failed.isNull()})
