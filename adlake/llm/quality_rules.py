"""Learned decision lists over text statistics (operator 4), native.

Statistics of every whole text come from SQL functions.  Rules are learned by
sequential covering on labelled rows: a rule grows by the threshold condition
with the largest FOIL gain on two thirds of the rows, and is pruned back to
the prefix that does best on the last third; the rows it covers leave, and
the next rule is learned, until a rule no longer pays.  The list becomes one
ordered conditional expression; the first rule that holds rejects a text, no
rule keeps it.

Thresholds are quantiles of each feature.  Labelled rows are first counted by
their vector of quantile bins, so a growth step is one small aggregate: rows
(at most features x bins) come to the driver, never the rows of the corpus.
``max_labelled`` bounds the labelled rows that are learned from (least hash
of the id first).

Defined results: a null or empty text has zeros and fails the base rule; equal
texts have equal results; without labels of both classes the list is empty and
the base rule alone decides; a null label is not learned from; extra columns
pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import SPACES, stage, unstage

SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_digits", "n_lines", "n_distinct")

#: The features that rules are made of: shares, so that a rule means the same for any length.
FEATURES = {
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "words": "cast(n_words as double)",
}
BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


def _count_of(text: Column, others: str) -> Column:
    """Characters left of ``text`` without the runs of ``others``."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def with_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` and a column ``__stats``: a struct of COUNTS for each text.

    Words are runs of anything but the six separators.  ``n_repeat_words`` is
    the number of words inside 3-word windows that occur at least twice:
    windows are sorted by hash, and the flagged starts in order of place give
    ``min(3, distance to the next)`` words each.
    """
    # The caller's columns travel in a struct, so their names can't clash with the counts.
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(F.struct(*docs.columns).alias("__own"), text.alias("__text")).withColumn("__trim", F.btrim("__text", F.lit(SPACES)))
    own = ["__own"]
    d = d.select(
        *own,
        F.when(F.col("__trim") == "", F.array().cast("array<string>")).otherwise(F.split("__trim", SPACE_RUN)).alias("__words"),
        _count_of(F.col("__text"), SPACE_RUN).alias("word_chars"),
        _count_of(F.col("__text"), f"[^{SYMBOLS}]+").alias("n_symbols"),
        _count_of(F.col("__text"), "[^A-Z]+").alias("n_upper"),
        _count_of(F.col("__text"), "[^!?]+").alias("n_marks"),
        _count_of(F.col("__text"), "[^0-9]+").alias("n_digits"),
        F.filter(F.split("__text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("__lines"),
    )
    counts = ("word_chars", "n_symbols", "n_upper", "n_marks", "n_digits")
    d = d.select(
        *own,
        *counts,
        F.size("__words").cast("long").alias("n_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("__words")).cast("long").alias("n_distinct"),
        F.expr("if(size(__words) < 3, cast(array() as array<bigint>), transform(slice(__words, 1, size(__words) - 2), (w, i) -> xxhash64(w, __words[i + 1], __words[i + 2])))").alias("__windows"),
    )
    counts = (*counts, "n_words", "n_lines", "n_dup_lines", "n_distinct")
    d = d.select(*own, *counts, F.expr("case when size(array_distinct(__windows)) < size(__windows) then sort_array(transform(__windows, (h, i) -> struct(h, i))) end").alias("__sorted"))
    d = d.select(
        *own,
        *counts,
        F.expr("sort_array(filter(transform(__sorted, (x, j) -> if(x.h = get(__sorted, j - 1).h or x.h = get(__sorted, j + 1).h, x.i, null)), x -> x is not null))").alias("__starts"),
    )
    d = d.select(*own, *counts, F.expr("coalesce(aggregate(transform(__starts, (p, j) -> least(3, coalesce(get(__starts, j + 1) - p, 3))), 0L, (a, x) -> a + x), 0L)").alias("n_repeat_words"))
    return d.select("__own.*", F.struct(*COUNTS).alias("__stats"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def expression(self) -> str:
        return f"({FEATURES[self.feature]}) {'>' if self.above else '<='} {self.threshold!r}D"

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def rule_expression(rule: Rule) -> str:
    return " and ".join(f"({c.expression()})" for c in rule)


def list_expression(rules: list[Rule]) -> Column:
    """Number of the first rule that holds (from 1), or null, over columns named as in COUNTS."""
    if not rules:
        return F.lit(None).cast("int")
    return F.expr("case " + " ".join(f"when {rule_expression(r)} then {i}" for i, r in enumerate(rules, 1)) + " end")


def learn_rules(labelled: DataFrame, label_col: str, bins: int = 24, max_rules: int = 12, max_conditions: int = 4, min_cover: int = 8, max_labelled: int = 200_000, id_col: str = "doc_id") -> list[Rule]:
    """The decision list that rejects rows whose label is 0; ``labelled`` has
    the columns of COUNTS, an id and the label."""
    rows = labelled.where(F.col(label_col).isin(0, 1))
    rows = rows.select(F.xxhash64(F.col(id_col).cast("string")).alias("h"), (F.col(label_col) == 0).alias("bad"), *[F.expr(e).cast("double").alias(n) for n, e in FEATURES.items()])
    rows = stage(rows.orderBy("h").limit(max_labelled), "quality-labelled")
    points = [i / bins for i in range(1, bins)] + [0.99, 0.995]
    cuts = rows.agg(*[F.percentile_approx(n, points, 10_000).alias(n) for n in FEATURES]).first()
    cut = {n: sorted(set(cuts[n] or [])) for n in FEATURES}
    code = {n: F.expr(f"size(filter(cast(array({', '.join(f'{x!r}D' for x in cut[n])}) as array<double>), c -> c < {n}))") for n in FEATURES}
    grow = F.pmod("h", F.lit(3)) < 2
    one = F.lit(1)
    table = stage(
        rows.select("bad", grow.alias("grow"), *[c.alias(n) for n, c in code.items()])
        .groupBy(*FEATURES)
        .agg(*[F.count(F.when((F.col("bad") == b) & (F.col("grow") == g), one)).alias(f"{'p' if b else 'n'}{'g' if g else 't'}") for b in (True, False) for g in (True, False)]),
        "quality-bins",
    )
    rules: list[Rule] = []

    def covers(rule: Rule) -> Column:
        held = F.lit(True)
        for c in rule:
            at = cut[c.feature].index(c.threshold)
            held = held & ((F.col(c.feature) > at) if c.above else (F.col(c.feature) <= at))
        return held

    left = table
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.col(n).cast("int").alias("bin")) for n in FEATURES]))
    while len(rules) < max_rules:
        rule: Rule = ()
        while len(rule) < max_conditions:
            counts = left.where(covers(rule)).select("pg", "ng", pairs.alias("x")).groupBy("x.f", "x.bin").agg(F.sum("pg").alias("p"), F.sum("ng").alias("n")).collect()
            best = _best_condition([(r["f"], r["bin"], r["p"], r["n"]) for r in counts], cut, min_cover)
            if best is None:
                break
            rule = (*rule, best)
        if not rule:
            break
        sums = left.agg(*[F.coalesce(F.sum(F.when(covers(rule[: i + 1]), F.col(x))), F.lit(0)).alias(f"{x}{i}") for i in range(len(rule)) for x in ("pg", "ng", "pt", "nt")]).first()
        worth = [_worth(sums[f"pt{i}"], sums[f"nt{i}"]) for i in range(len(rule))]
        keep = max(range(len(rule)), key=lambda i: (worth[i], -i))
        right, wrong = sums[f"pt{keep}"] + sums[f"pg{keep}"], sums[f"nt{keep}"] + sums[f"ng{keep}"]
        if worth[keep] <= 0.6 or right < min_cover or wrong > right // 4:
            break
        rules.append(rule[: keep + 1])
        left = left.where(~covers(rules[-1]))
    unstage(rows, table)
    return rules


def _worth(p: int, n: int) -> float:
    return (p - n) / (p + n) if p + n else -1.0


def _best_condition(counts: list[tuple], cut: dict[str, list[float]], min_cover: int) -> Condition | None:
    """The condition of the largest FOIL gain, from counts by feature and bin."""
    import math

    best, found = 1e-9, None
    for feature, cuts in cut.items():
        p, n = [0] * (len(cuts) + 1), [0] * (len(cuts) + 1)
        for f, b, x, y in counts:
            if f == feature:
                p[b] += x
                n[b] += y
        all_p, all_n = sum(p), sum(n)
        if not all_p or not all_n:
            continue
        low_p = low_n = 0
        for i, c in enumerate(cuts):
            low_p, low_n = low_p + p[i], low_n + n[i]
            for above, x, y in ((False, low_p, low_n), (True, all_p - low_p, all_n - low_n)):
                if x < min_cover or x + y == all_p + all_n:
                    continue
                gain = x * (math.log2(x / (x + y)) - math.log2(all_p / (all_p + all_n)))
                if gain > best:
                    best, found = gain, Condition(feature, above, c)
    return found


def judged(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """``stats`` (columns of COUNTS among others) with base_failed, rule and kept."""
    return stats.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("rule", list_expression(rules)).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def quality_filter(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """The rows of ``docs`` that a list learned from their labelled rows keeps.

    Statistics are written once, without texts, by id and hash of the text,
    for learning and for the verdicts (a filter straight on their expressions
    would be pushed below them, and compute them once for each mention).
    """
    key = [F.col(id_col).alias("__id"), F.xxhash64(F.col(text_col).cast("string")).alias("__hash")]
    rows = with_stats(docs.select(*key, F.col(text_col).alias("__body")), "__body")
    stats = stage(rows.select("__id", "__hash", "__stats.*"), "quality-stats")
    marked = labels.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(label_col).alias("__label"))
    rules = learn_rules(stats.join(marked, "__id"), "__label", id_col="__id")
    kept = judged(stats, rules).where("kept").select("__id", "__hash").distinct()
    same = docs[id_col].eqNullSafe(kept["__id"]) & (F.xxhash64(docs[text_col].cast("string")) == kept["__hash"])
    return docs.join(kept, same, "left_semi")
