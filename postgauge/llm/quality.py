"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule is a condition on a document that rejects it. The rules form one CASE expression,
so a document is tested only until the first rule that rejects it. The order comes from a
sample: each rule's cost is its measured time on the sample, its selectivity the share of
sample documents it rejects, and rules with the most rejections per cost come first. The
verdict is a conjunction, so it does not depend on the order; only the work does.

Defined cases: a null text is an empty one, has no words and is rejected as too short.
Repeated rows get a verdict each; null ids stay null. Columns other than the id and the
text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgauge.session import settle

#: Documents in the sample from which rule order is derived, about.
SAMPLE_ROWS = 2_000

_SPACE = r"[\x20\x09-\x0D]+"


def _repeated_at(windows: str) -> Column:
    """Positions of windows that equal a neighbour in the sorted array of (window, at)."""

    def equals_neighbour(x: Column, i: Column) -> Column:
        before = x["window"] == F.get(windows, i - 1)["window"]
        after = x["window"] == F.get(windows, i + 1)["window"]
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    return F.sort_array(F.transform(F.filter(windows, equals_neighbour), lambda x: x["at"]))


def with_measure(frame: DataFrame, name: str) -> DataFrame:
    """Add measure ``name``, computed from the text in ``body``, unless it is there already.

    ``n_repeat_words`` counts words covered by three-word windows that occur at least twice.
    Windows are sorted inside the row together with their positions, so equal ones are
    neighbours; no document is exploded or shuffled.
    """
    if name in frame.columns:
        return frame
    body = F.col("body")
    if name == "words":
        return frame.withColumn(name, F.filter(F.split(body, _SPACE), lambda w: w != ""))
    if name == "lines":
        filled = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return frame.withColumn(name, filled)
    if name == "word_chars":
        return frame.withColumn(name, F.char_length(F.regexp_replace(body, _SPACE, "")).cast("long"))
    if name == "n_symbols":
        symbols = F.regexp_replace(body, r"[^#*$%&|<>]+", "")
        return frame.withColumn(name, F.char_length(symbols).cast("long"))
    if name == "n_words":
        return with_measure(frame, "words").withColumn(name, F.size("words").cast("long"))
    if name == "n_lines":
        return with_measure(frame, "lines").withColumn(name, F.size("lines").cast("long"))
    if name == "n_dup_lines":
        repeats = F.size("lines") - F.size(F.array_distinct("lines"))
        return with_measure(frame, "lines").withColumn(name, repeats.cast("long"))
    if name == "n_repeat_words":
        size = F.size("words")
        windows = F.transform(
            F.sequence(F.lit(0), size - 3),
            lambda i: F.struct(
                F.concat_ws(
                    " ", F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)
                ).alias("window"),
                i.alias("at"),
            ),
        )
        steps = F.transform(
            "window_at",
            lambda p, i: F.least(F.lit(3), F.coalesce(F.get("window_at", i + 1) - p, F.lit(3))),
        )
        covered = F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)
        return (
            with_measure(frame, "words")
            .withColumn("windows", F.sort_array(F.when(size >= 3, windows)))
            .withColumn("window_at", _repeated_at("windows"))
            .withColumn(name, F.coalesce(covered, F.lit(0)))
            .drop("windows", "window_at")
        )
    raise ValueError(f"no measure {name!r}")


def _bodies(docs: DataFrame, text: str, **columns: Column) -> DataFrame:
    return docs.select(
        *(column.alias(name) for name, column in columns.items()),
        F.coalesce(F.col(text), F.lit("")).alias("body"),
    )


@dataclass(frozen=True)
class Rule:
    """A document is rejected where ``rejects`` holds over the measures in ``needs``."""

    name: str
    rejects: str
    needs: tuple[str, ...]


RULES = (
    Rule("few_words", "n_words < 50", ("n_words",)),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words", ("n_words", "n_repeat_words")),
    Rule("symbols", "10 * n_symbols > n_words", ("n_words", "n_symbols")),
    Rule("repeated_lines", "100 * n_dup_lines > 30 * n_lines", ("n_lines", "n_dup_lines")),
    Rule(
        "word_length",
        "word_chars < 2 * n_words OR word_chars > 12 * n_words",
        ("n_words", "word_chars"),
    ),
)
#: The rules whose failure is reported as ``base_failed``.
BASE = ("few_words", "repeated_words")


def order_rules(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> list[Rule]:
    """Rules by rejections per second on a sample of about ``sample_rows`` documents.

    The sample only decides the order in which rules are tried, never a verdict.
    """
    total = docs.count()
    if not total:
        return list(rules)
    sample = settle(_bodies(docs, text).sample(min(1.0, sample_rows / total), seed=7))
    rated = []
    for rule in rules:
        measured = sample
        for name in rule.needs:
            measured = with_measure(measured, name)
        began = time.perf_counter()
        rejected = measured.select(F.count_if(F.expr(rule.rejects))).first()[0]
        rated.append((-rejected / (time.perf_counter() - began), rule.name, rule))
    return [rule for _, _, rule in sorted(rated, key=lambda r: r[:2])]


def first_rejection(rules: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects, or null; later rules are then not evaluated."""
    chain = None
    for rule in rules:
        condition = F.coalesce(F.expr(rule.rejects), F.lit(False))
        chain = F.when(condition, rule.name) if chain is None else chain.when(condition, rule.name)
    return F.lit(None).cast("string") if chain is None else chain


def keep_clean(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The documents no rule rejects, with their own columns.

    Rules are tried in turn: once a rule rejects a document its text and words become null,
    so nothing further is computed for it. The rejected rows leave at the end through
    ``inline``; a filter would be pushed below the measures and repeat them.
    """
    frame = _bodies(docs, text, row=F.struct("*")).withColumn("alive", F.lit(True))
    for rule in order_rules(docs, rules, text):
        for name in rule.needs:
            frame = with_measure(frame, name)
        rejected = F.coalesce(F.expr(rule.rejects), F.lit(False))
        frame = frame.withColumn("alive", F.col("alive") & ~rejected)
        for name in {"body", "words", "lines"} & set(frame.columns):
            frame = frame.withColumn(name, F.when(F.col("alive"), F.col(name)))
    return frame.select(F.inline(F.when(F.col("alive"), F.array("row"))))


def judge(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Measures of every document, ``base_failed`` and ``kept`` (no rule rejects)."""
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
    frame = _bodies(docs, text, doc_id=F.col(id_column))
    for name in measures:
        frame = with_measure(frame, name)
    base = [rule for rule in rules if rule.name in BASE]
    verdicts = (
        first_rejection(base).isNotNull().alias("base_failed"),
        first_rejection(order_rules(docs, rules, text)).isNull().alias("kept"),
    )
    # As in keep_clean: what a caller filters must not be pushed below the measures.
    return frame.select(F.inline(F.array(F.struct("doc_id", *measures, *verdicts))))
