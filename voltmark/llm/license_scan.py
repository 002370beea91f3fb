"""Licences that a text names or quotes, by ordered signatures.

Every signature has a keyword; only where a text holds a keyword are the few signatures of that word tried, on the words around.
Detections that lie inside a better one are dropped. All of it is SQL expressions over one row: no Python runs
on the executors, and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmark.llm.license_rules import WORDS_AHEAD, WORDS_ON, Rule, all_rules

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RESULTS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "licenses")


def scanned(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with what is found in each text:

    * ``n_words long``: runs of digits, letters and characters outside ASCII, after A-Z became lower case.
    * ``n_base long``, ``first_word long``, ``last_word long``, ``base_labels string``: places where a base phrase stands,
      the smallest and largest first word of these (counted from 0; null if there is none), and their labels.
    * ``licenses array<struct<start, stop, label, kind>>``: detections by all signatures, as words from ``start`` to before
      ``stop``, in the order of the text. One that lies inside another of higher priority, or inside a longer one of the same, is
      left out; of two with the same words and priority the earlier rule counts.
    * ``labels string``: labels of those and the base labels; ``score double``: how sure the surest of them is, 0 if none.

    Labels are distinct, sorted by their bytes and joined by commas. A null text is an empty one: no words, nothing found.
    Every row is answered by itself, so repeated rows, repeated and null ids do no harm. Columns of ``docs`` stay;
    one that is named like a result gives way to it, and ``keep_text=False`` leaves the text out.

    Work on a text grows with its length: one pass over its words, and for each keyword a fixed number of words around.
    """
    rules = list(rules if rules is not None else all_rules())
    kept = [c for c in docs.columns if c not in RESULTS and (keep_text or c != text)]
    # The row is one column here, so that no name of its own can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), _words(f"`{text}`").alias("words"))
    rows = rows.select("row", F.size("words").cast("long").alias("n_words"), F.expr(_spots(rules)).alias("spots"))
    rows = rows.select("row", "n_words", F.expr(_found(rules)).alias("found"))
    rows = rows.select("row", "n_words", F.expr("filter(flatten(found), d -> d.base)").alias("base"), F.expr(_best()).alias("best"))
    fields = [F.col("row").getField(c).alias(c) for c in kept]
    return rows.select(
        *fields,
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.expr("cast(array_min(base.start) as long)").alias("first_word"),
        F.expr("cast(array_max(base.start) as long)").alias("last_word"),
        F.expr(_joined("base.label")).alias("base_labels"),
        F.expr(_joined("concat(base.label, best.label)")).alias("labels"),
        F.expr("coalesce(array_max(concat(base.weight, best.weight)), 0D)").alias("score"),
        F.expr("transform(best, d -> named_struct('start', d.start, 'stop', d.stop, 'label', d.label, 'kind', d.kind))").alias("licenses"),
    )


def _words(text: str):
    lower = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lower, GAP), "")


def _joined(labels: str) -> str:
    return f"array_join(array_sort(array_distinct({labels})), ',')"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _count(words: str) -> str:
    return f"(length({words}) - length(replace({words}, ' ', '')) + 1)"


def _spots(rules: list[Rule]) -> str:
    """Where a text holds a keyword, with the words ahead of it and those from it on."""
    keywords = ", ".join(sorted({_quoted(r.keyword) for r in rules}))
    return f"""
      transform(
        filter(if(size(words) = 0, array(), sequence(0, size(words) - 1)), p -> words[p] IN ({keywords})),
        p -> named_struct(
          'at', p,
          'word', words[p],
          'ahead', array_join(slice(words, greatest(p - {WORDS_AHEAD}, 0) + 1, least(p, {WORDS_AHEAD})), ' '),
          'on', concat(array_join(slice(words, p + 1, {WORDS_ON}), ' '), ' ')))"""


def _found(rules: list[Rule]) -> str:
    """The detections at each spot that has any."""
    numbered = sorted(enumerate(rules), key=lambda x: (x[1].keyword, x[0]))
    cases = " ".join(
        f"WHEN {_quoted(keyword)} THEN array({', '.join(_tried(i, r) for i, r in group)})"
        for keyword, group in groupby(numbered, key=lambda x: x[1].keyword)
    )
    return f"""
      filter(transform(spots, s ->
        transform(
          filter(CASE s.word {cases} END, h -> h.on <> '' AND (NOT h.needed OR h.ahead <> '')),
          h -> named_struct(
            'start', s.at - if(h.needed, {_count("h.ahead")}, 0),
            'stop', s.at + {_count("h.on")},
            'base', h.priority = 0, 'priority', h.priority, 'rule', h.rule, 'label', h.label, 'kind', h.kind, 'weight', h.weight))),
        f -> size(f) > 0)"""


def _tried(number: int, rule: Rule) -> str:
    """A signature tried at a spot: the words that it matches on either side, empty where it doesn't."""
    ahead = "''"
    if rule.ahead:
        ahead = f"if(s.on RLIKE {_quoted(f'^(?:{rule.on}) ')}, regexp_extract(s.ahead, {_quoted(f'(?:^| )({rule.ahead})$')}, 1), '')"
    return (
        f"named_struct('rule', {number}, 'priority', {rule.priority}, 'label', {_quoted(rule.label)}, 'kind', {_quoted(rule.kind)}, "
        f"'weight', {float(rule.weight)!r}D, 'needed', {str(bool(rule.ahead)).lower()}, 'ahead', {ahead}, "
        f"'on', regexp_extract(s.on, {_quoted(f'^({rule.on}) ')}, 1))"
    )


def _best() -> str:
    """Detections that no better one contains. One that does has its keyword within a signature's length of
    words, so it is among so many spots on either side."""
    near = WORDS_AHEAD + WORDS_ON
    return f"""
      flatten(transform(
        if(size(found) = 0, array(), sequence(0, size(found) - 1)),
        j -> filter(found[j], d -> NOT exists(
          flatten(slice(found, greatest(j - {near}, 0) + 1, {2 * near + 1})),
          e -> e.start <= d.start AND e.stop >= d.stop
            AND struct(e.priority, e.stop - e.start, -e.rule) > struct(d.priority, d.stop - d.start, -d.rule)))))"""
