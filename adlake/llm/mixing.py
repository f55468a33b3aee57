"""Soft-membership mixing to target weights (operator 2), native.

*Posteriors.*  Domains are classes of the labelled documents.  A classifier
over binned features (shares of signs, capitals and repeated words, and the
number of words of each domain's lexicon) gives every document the posterior
of each domain: naive Bayes with smoothed counts.  The bins of a text are one
small number, its code, and posteriors and rates belong to codes.  Lexicons
(every word whose document counts differ by a root of the log-likelihood ratio
of ``MIN_Z``) and counts come from at most ``max_labelled`` labelled documents,
those with the least hashes of their ids.

*Rates.*  With ``n_d`` tokens and posteriors ``p_dk``, the expected tokens of
domain k are ``sum_d r_d n_d p_dk``.  Nonnegative document rates ``r`` minimise

    sum_k (expected_k - target_k)^2 / (2 share_k) + ridge/2 sum_d n_d (r_d - 1)^2

(in parts of all tokens) by accelerated projected gradient steps: a step is
one aggregate of the expected totals (one row) and one projection of the rates
at zero.  Each document's gradient is taken over its token count, which keeps
the step size the same for all; the shares as weights make the problem as well
conditioned for rare domains.  Rates are kept with the posteriors in the
shared folder every few steps, which bounds the plan and cuts its lineage.

Defined results: null and empty texts have no tokens, the posterior of their
features and the rate of such a posterior; equal texts have equal rates; a
domain without labelled documents has posterior 0; without labels every
posterior is equal; a domain with no expected tokens can't be filled and is
left out of the fit; an empty table gives an empty result; null labels are not
learned from.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import SPACES, stage, unstage

SPACE_RUN = r"[\x20\x09-\x0D]+"
DOMAINS = ("high", "low", "toxic")
#: Target share of the tokens of each domain.
TARGETS = {"high": 0.85, "low": 0.10, "toxic": 0.05}
BINS = 6
#: Root of the log-likelihood ratio from which a word marks a domain.
MIN_Z = 4


def domain_of(quality: str = "quality", toxic: str = "toxic") -> Column:
    return F.when(F.col(toxic) == 1, "toxic").when(F.col(quality) == 0, "low").when(F.col(quality) == 1, "high")


def _words(text: Column) -> Column:
    trimmed = F.btrim(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def _literal(word: str) -> str:
    """The word as an SQL string; signs by their code points."""
    return "'" + "".join(c if c.isalnum() else f"\\u{ord(c):04x}" if ord(c) < 1 << 16 else f"\\U{ord(c):08x}" for c in word) + "'"


def _features(rows: DataFrame, lexicons: dict[str, list[str]]) -> DataFrame:
    """``rows`` (with ``__text``) and the count of tokens and the features of each text."""
    own = [c for c in rows.columns if c != "__text"]
    kept = lambda others: F.length(F.regexp_replace("__text", others, ""))
    d = rows.select(
        *own,
        F.length("__text").alias("__chars"),
        kept(r"[^#*$%&|<>!]+").alias("__signs"),
        kept("[^A-Z]+").alias("__capitals"),
        _words(F.col("__text")).alias("__words"),
    )
    size = F.greatest(F.col("__chars"), F.lit(1))
    d = d.select(
        *own,
        (F.col("__signs") / size).alias("f_signs"),
        (F.col("__capitals") / size).alias("f_capitals"),
        F.size("__words").cast("long").alias("n_tokens"),
        F.array_distinct("__words").alias("__words"),
    )
    # A list of constants is a hash set in the plan: one look per word, however long the lexicon.
    hits = [F.expr(f"cast(size(filter(__words, w -> w in ({', '.join(map(_literal, words))}))) as double)" if words else "0D").alias(f"f_{k}") for k, words in lexicons.items()]
    return d.select(*own, "n_tokens", "f_signs", "f_capitals", (1 - F.size("__words") / F.greatest(F.col("n_tokens"), F.lit(1))).alias("f_repeats"), *hits)


def _lexicons(sample: DataFrame) -> dict[str, list[str]]:
    """All words that mark each domain; differing texts only, so copies weigh once."""
    words = sample.dropDuplicates(["__text"]).select("domain", F.explode(F.array_distinct(_words(F.col("__text")))).alias("word"))
    table = stage(words.groupBy("word").pivot("domain", list(DOMAINS)).count().na.fill(0), "mixing-words")
    whole = table.agg(*[F.sum(k).alias(k) for k in DOMAINS]).first()
    total = sum(whole[k] or 0 for k in DOMAINS)
    out = {}
    for k in DOMAINS:
        inside = whole[k] or 0
        if not inside or inside == total:
            out[k] = []
            continue
        mine, others = F.col(k), sum((F.col(x) for x in DOMAINS if x != k), F.lit(0))
        both = mine + others
        part = lambda n, share: F.when(n > 0, n * F.log(n / (both * F.lit(share)))).otherwise(0.0)
        ratio = F.sqrt(F.greatest(2 * (part(mine, inside / total) + part(others, 1 - inside / total)), F.lit(0.0)))
        rows = table.select("word", ratio.alias("z"), (mine / both).alias("share")).where((F.col("share") > inside / total) & (F.col("z") >= MIN_Z)).select("word").orderBy("word").collect()
        out[k] = [r["word"] for r in rows]
    unstage(table)
    return out


@dataclass(frozen=True)
class Classifier:
    """Naive Bayes over binned features.  The bins of a text are one number,
    its ``code``; posteriors are a function of the code."""

    lexicons: dict[str, list[str]]
    #: Upper ends of the bins of each feature, but the last.
    cuts: dict[str, list[float]]
    #: For each domain that has documents: its log share, and the log shares of the bins of each feature.
    shares: dict[str, tuple[float, dict[str, list[float]]]]

    def code(self) -> Column:
        """At most 8 * 8 * 8 * 5 * 5 * 5 = 64,000 codes."""
        terms, place = [], 1
        for n, cuts in self.cuts.items():
            if cuts:
                terms.append(f"{place} * (case " + " ".join(f"when {n} <= {c!r}D then {i}" for i, c in enumerate(cuts)) + f" else {len(cuts)} end)")
            place *= len(cuts) + 1
        return F.expr(" + ".join(terms) if terms else "0").cast("int")

    def rows(self, docs: DataFrame, keep: list[str], body: Column) -> DataFrame:
        """``keep`` columns, ``n_tokens`` and ``code`` of every row."""
        return _features(docs.select(*keep, body.alias("__text")), self.lexicons).select(*keep, "n_tokens", self.code().alias("code"))

    def posteriors(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with ``code``) and ``p_<domain>``."""
        score: dict[str, Column] = {}
        for k, (prior, bins) in self.shares.items():
            score[k], place = F.lit(prior), 1
            for n, cuts in self.cuts.items():
                if cuts:
                    score[k] = score[k] + F.get(F.lit(bins[n]), F.floor(F.col("code") / place).cast("int") % (len(cuts) + 1))
                else:
                    score[k] = score[k] + F.lit(bins[n][0])
                place *= len(cuts) + 1
        own = rows.columns
        d = rows.select(*own, *[x.alias(f"s_{k}") for k, x in score.items()])
        d = d.withColumn("__top", F.greatest(*[F.col(f"s_{k}") for k in score]) if len(score) > 1 else F.col(f"s_{next(iter(score))}"))
        d = d.select(*own, *[F.exp(F.col(f"s_{k}") - F.col("__top")).alias(f"e_{k}") for k in score])
        norm = sum((F.col(f"e_{k}") for k in score), F.lit(0.0))
        return d.select(*own, *[(F.round(F.col(f"e_{k}") / norm, 12) if k in score else F.lit(0.0)).alias(f"p_{k}") for k in DOMAINS])


def learn_classifier(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", domain: Column | None = None, max_labelled: int = 20_000) -> Classifier:
    """From at most ``max_labelled`` labelled rows, those with the least hashes of their ids."""
    marks = labels.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id"), (domain_of() if domain is None else domain).alias("domain")).where("domain is not null")
    marks = marks.orderBy(F.xxhash64("__id"), "__id").limit(max_labelled)
    sample = stage(docs.select(F.col(id_col).alias("__id"), _body(text_col).alias("__text")).join(F.broadcast(marks), "__id").select("domain", "__text"), "mixing-labelled")
    lexicons = _lexicons(sample)
    known = stage(_features(sample, lexicons), "mixing-features")
    names = [c for c in known.columns if c.startswith("f_")]
    points = [i / BINS for i in range(1, BINS)] + [0.95, 0.99]
    found = known.agg(*[F.percentile_approx(n, points, 10_000).alias(n) for n in names]).first()
    cuts = {n: sorted(set(found[n] or [])) for n in names}
    for k in lexicons:
        cuts[f"f_{k}"] = [0.0, 1.0, 2.0, 4.0]
    bin_of = {n: F.expr("case " + " ".join(f"when {n} <= {c!r}D then {i}" for i, c in enumerate(cuts[n])) + f" else {len(cuts[n])} end" if cuts[n] else "0") for n in names}
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("f"), b.alias("bin")) for n, b in bin_of.items()]))
    counted = {(r["domain"], r["f"], r["bin"]): r["count"] for r in known.select("domain", pairs.alias("x")).groupBy("domain", "x.f", "x.bin").count().collect()}
    unstage(sample, known)
    size = {k: sum(c for (d, f, _), c in counted.items() if d == k and f == names[0]) for k in DOMAINS}
    total = sum(size.values())
    shares = {}
    for k in DOMAINS:
        if total and not size[k]:
            continue
        # Half a document in each bin: no bin is impossible.  Without labels all domains are alike.
        bins = {n: [math.log((counted.get((k, n, b), 0) + 0.5) / (size[k] + 0.5 * (len(cuts[n]) + 1))) if total else 0.0 for b in range(len(cuts[n]) + 1)] for n in names}
        shares[k] = (math.log(size[k] / total) if total else 0.0, bins)
    return Classifier(lexicons, cuts, shares)


def _body(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def domain_posteriors(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", domain: Column | None = None, max_labelled: int = 20_000) -> DataFrame:
    """(id, n_tokens, code, p_<domain>) of every row."""
    model = learn_classifier(docs, labels, id_col, text_col, domain, max_labelled)
    return model.posteriors(model.rows(docs, [id_col], _body(text_col)))


def fit_rates(rows: DataFrame, targets: dict[str, float], total_tokens: float | None = None, ridge: float = 1e-3, steps: int = 40, tolerance: float = 1e-4, cut: int = 4) -> DataFrame:
    """``rows`` (n_tokens and p_<domain>) and the ``rate`` of each, so that expected tokens meet the targets.

    ``targets`` are shares of ``total_tokens`` (those of the rows if not given).
    If the steps end further than ``tolerance`` (a share of all tokens) from a
    target, a warning says how far.
    """
    state = kept = stage(rows.withColumn("rate", F.lit(1.0)).withColumn("__point", F.lit(1.0)), "mixing-rates")
    domains = list(targets)
    now = lambda d, c: d.agg(*[F.sum(F.col("n_tokens") * F.col(c) * F.col(f"p_{k}")).alias(k) for k in domains], F.sum("n_tokens").alias("__all")).first()
    first = now(state, "rate")
    tokens = float(first["__all"] or 0)
    if not tokens:
        return state.drop("__point")
    share = {k: first[k] / tokens for k in domains}
    domains = [k for k in domains if share[k] > 0]
    goal = {k: targets[k] * (total_tokens or tokens) / tokens for k in domains}
    eta, speed = 1 / (1 + ridge), 1.0
    for step in range(1, steps + 1):
        at = first if step == 1 else now(state, "__point")
        # Rounded, so that the order in which tasks are summed doesn't matter.
        off = {k: round((at[k] / tokens - goal[k]) / share[k], 9) for k in domains}
        gradient = sum((F.col(f"p_{k}") * F.lit(off[k]) for k in domains), F.lit(0.0))
        faster = (1 + math.sqrt(1 + 4 * speed * speed)) / 2
        push, speed = (speed - 1) / faster, faster
        new = F.greatest(F.lit(0.0), F.col("__point") * F.lit(1 - eta * ridge) + F.lit(eta * ridge) - F.lit(eta) * gradient)
        state = state.withColumn("__new", new).withColumn("__point", F.lit(1 + push) * F.col("__new") - F.lit(push) * F.col("rate")).withColumn("rate", F.col("__new")).drop("__new")
        far = max(abs(off[k]) * share[k] for k in domains)
        if step > 1 and far < tolerance:
            break
        if step % cut == 0:
            told = stage(state, "mixing-rates")
            unstage(kept)
            state = kept = told
    else:
        warnings.warn(f"document rates miss a target by {far:.2g} of all tokens", stacklevel=2)
    return state.drop("__point")


def with_rates(rows: DataFrame, targets: dict[str, float], total_tokens: float | None = None) -> DataFrame:
    """``rows`` of ``domain_posteriors`` and the fitted ``rate`` of each.

    A gradient depends on a row's posteriors alone, so rows of one code have
    one rate and are added up first.  There are at most as many codes as
    combinations of bins (64,000), whatever the corpus: that table is fitted,
    and sent to every task by code.
    """
    points = _points(rows.groupBy("code", *[f"p_{k}" for k in DOMAINS]).agg(F.sum("n_tokens").alias("n_tokens")))
    rates = fit_rates(points, targets, total_tokens).select("code", "rate")
    return rows.join(F.broadcast(rates), "code")


def _points(points: DataFrame) -> DataFrame:
    """The table of codes, staged in one file: at most 64,000 rows."""
    return stage(points.repartition(1), "mixing-points")


def mix_documents(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, whole: str = "high", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` as often as their rates say, with their columns.

    A rate's fraction is rounded by a hash of the row.  The target total is
    large enough that the domain ``whole`` need not be thinned, and a row that
    most likely belongs to it appears at least once.
    """
    marked = docs.select(F.struct(*docs.columns).alias("__row"), (F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string")), F.lit(1 << 20)) / F.lit(float(1 << 20))).alias("__u"), F.col(text_col).alias("__body"))
    model = learn_classifier(docs, labels, id_col, text_col)
    # Codes are computed twice, for the fit and for the rows, rather than written with the texts.
    found = model.rows(marked, ["__row", "__u"], _body("__body"))
    points = _points(model.posteriors(found.groupBy("code").agg(F.sum("n_tokens").alias("n_tokens"))))
    sums = points.agg(F.sum(F.col("n_tokens") * F.col(f"p_{whole}")).alias("mine"), F.sum("n_tokens").alias("all")).first()
    total = max(float(sums["all"] or 0), float(sums["mine"] or 0) / targets[whole]) or None
    best = F.col(f"p_{whole}") >= F.greatest(*[F.col(f"p_{k}") for k in DOMAINS])
    rates = fit_rates(points, targets, total).select("code", "rate", best.alias("best"))
    times = F.floor(F.col("rate") + F.col("__u")).cast("int")
    times = F.when(F.col("best"), F.greatest(times, F.lit(1))).otherwise(times)
    rated = found.join(F.broadcast(rates), "code")  # bounded as in with_rates
    return rated.withColumn("__times", times).where("__times > 0").select("__row", F.explode(F.expr("sequence(1, __times)")).alias("__copy")).select("__row.*")
