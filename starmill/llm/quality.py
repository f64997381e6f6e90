"""Quality rules with risk-controlled cutoffs, in DataFrame expressions only.

A rule is a score of a document (higher: worse) and a cutoff per stratum; a
document that passes a cutoff is rejected. Cutoffs are learnt on a labelled
holdout: for a rule and stratum, cutoffs are tried from the mildest on, and each
is certified while an exact binomial test rejects "it falsely rejects more than
``alpha / number of rules`` of the good documents" at level ``delta / (number of
rules * number of strata)``. Trying them in that fixed order needs no further
correction, so all certified cutoffs hold together with probability 1 - delta,
and all rules together falsely reject at most ``alpha`` per stratum. Among the
certified ones, the cutoff used rejects most bad documents, each good one
rejected counting as ``cost`` bad ones; ties take the mildest.

Defined results: null and empty texts have no words, all counts 0, and fail the
base rule; a null stratum is a stratum of its own; strata without labels, or
with too few for any certificate, get no cutoff; a document labelled more than
once counts as good only if every label says so; labels without quality count
for nothing; repeated rows are judged one by one; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import drop_scratch, ordered_documents, spill

SYMBOLS = "[#*$%&|<>]"
WINDOW = 8


@dataclass(frozen=True)
class Risk:
    alpha: float = 0.02
    delta: float = 0.05
    cost: float = 20.0
    steps: int = 50


def features(docs: DataFrame, *keys: str) -> DataFrame:
    """doc_id, ``keys``, lang and the counts of every row of ``docs``."""
    ids = ["doc_id", *keys]
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(*ids, lang.alias("lang"), text.alias("text"))
    d = d.select(*ids, "lang", "text", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "").alias("words"), F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    d = d.select(
        *ids,
        "lang",
        F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + F.char_length(w)).alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    last = F.size("h") - F.lit(WINDOW)
    windows = F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[F.get("h", i + j) for j in range(WINDOW)])))
    d = d.select(*ids, "lang", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", windows.alias("w"))
    d = d.withColumn("again", F.size(F.array_distinct("w")) < F.size("w"))
    # (hash, place) in order: a window that occurs again stands beside its like
    placed = F.when(F.col("again"), F.sort_array(F.transform("w", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))
    d = d.select(*ids, "lang", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", placed.alias("p"))
    same = lambda j, k: F.coalesce(F.get("p", j)["x"] == F.get("p", k)["x"], F.lit(False))
    starts = F.sort_array(F.transform(F.filter(F.transform("p", lambda q, j: F.struct(q["i"].alias("i"), ((j > 0) & same(j - 1, j) | same(j + 1, j)).alias("again"))), lambda q: q["again"]), lambda q: q["i"]))
    d = d.select(*ids, "lang", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", starts.alias("s"))
    span = F.transform("s", lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get("s", j + 1) - x, F.lit(WINDOW))))
    covered = F.coalesce(F.aggregate(span, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0))
    return d.select(*ids, "lang", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", covered.cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """Each rule's score from 0 to 1, higher: worse."""
    part = lambda a, b: F.least(F.lit(1.0), F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return {
        "symbols": part("n_symbols", "word_chars"),
        "lines": part("n_dup_lines", "n_lines"),
        "repeats": part("n_repeat_words", "n_words"),
        "long_words": F.least(F.lit(1.0), F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)) / 40),
    }


def _tail_at_most(n: Column, k: Column, p: float, level: Column) -> Column:
    """P(Binomial(n, p) <= k) <= level, summed exactly in logarithms."""
    import math

    first = n * math.log1p(-p)
    odds = math.log(p) - math.log1p(-p)

    def step(acc, i):
        term = acc["term"] + F.log((n - i + 1) / i) + odds
        top, low = F.greatest(acc["total"], term), F.least(acc["total"], term)
        return F.struct(term.alias("term"), (top + F.log1p(F.exp(low - top))).alias("total"))

    zero = F.struct(first.cast("double").alias("term"), first.cast("double").alias("total"))
    places = F.when(k > 0, F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1)))).otherwise(F.array().cast("array<bigint>"))
    # beyond the mean the tail is over one half: no level of use is met, and the sum isn't taken
    return (k < n * p) & (F.aggregate(places, zero, step, lambda a: a["total"]) <= F.log(level))


def cutoffs(found: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """(lang, rule, step): the chosen step of each stratum and rule; a score s is rejected if floor(s * steps) >= step. ``found`` has the features."""
    names = rules()
    marks = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_l")).agg(F.min("quality").alias("good"))
    scored = found.where(~base_failed()).join(marks, F.col("doc_id") == F.col("_l"))
    each = scored.select("lang", "good", F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.floor(v * risk.steps).cast("int").alias("step")) for k, v in names.items()])).alias("r"))
    counts = each.select("lang", "r.rule", "r.step", "good").groupBy("lang", "rule", "step").agg(F.sum(F.when(F.col("good") == 1, 1).otherwise(0)).alias("good"), F.sum(F.when(F.col("good") == 1, 0).otherwise(1)).alias("bad"))
    by = Window.partitionBy("lang", "rule")
    down = by.orderBy(F.col("step").desc()).rowsBetween(Window.unboundedPreceding, 0)
    # one row for each step with documents: a cutoff between two of them rejects the same
    tried = counts.withColumn("n", F.sum("good").over(by)).withColumn("k", F.sum("good").over(down)).withColumn("caught", F.sum("bad").over(down))
    strata = counts.agg(F.count_distinct(F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")))).first()[0]
    level = F.lit(risk.delta / (len(names) * max(1, strata)))
    tried = tried.withColumn("held", F.when((F.col("step") > 0) & _tail_at_most(F.col("n"), F.col("k"), risk.alpha / len(names), level), 0).otherwise(1))
    sure = tried.withColumn("failed", F.sum("held").over(down)).where("failed = 0").withColumn("gain", F.col("caught") - risk.cost * F.col("k")).where("gain > 0")
    best = sure.groupBy("lang", "rule").agg(F.max_by("step", F.struct("gain", "step")).alias("step"))
    return best.select("lang", "rule", "step")


def judge(docs: DataFrame, labels: DataFrame, risk: Risk = Risk(), keys: tuple[str, ...] = ()) -> DataFrame:
    """A row per row of ``docs``: its ``keys``, counts, base_failed, kept, and the rules that rejected it."""
    found = spill(features(docs, *keys), "quality")
    chosen = cutoffs(found, labels, risk).groupBy(F.col("lang").alias("_lang")).agg(F.map_from_entries(F.collect_list(F.struct("rule", "step"))).alias("_cut"))
    # as many rows as strata and rules; written, so that its size is known when the join is planned
    chosen = spill(chosen, "cutoffs")
    judged = found.join(chosen, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    hits = F.filter(F.array(*[F.when(F.floor(v * risk.steps) >= F.element_at("_cut", F.lit(k)), F.lit(k)) for k, v in rules().items()]), lambda x: x.isNotNull())
    judged = judged.select(*found.columns, base_failed().alias("base_failed"), hits.alias("rejected_by"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))


def filter_documents(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns; each row by its own verdict, whatever its doc_id."""
    slim, _ = ordered_documents(docs, *[c for c in docs.columns if c not in ("doc_id", "text")])
    kept = judge(slim, labels, risk, ("_ord",)).where("kept").select(F.col("_ord").alias("_kept"))
    return slim.join(kept, F.col("_ord") == F.col("_kept"), "left_semi").select(*docs.columns)


def op10(spark, sf_dir: str) -> DataFrame:
    from starmill.llm.common import table

    out = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
