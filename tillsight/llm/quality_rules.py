"""Quality rules whose cutoffs keep a proven bound on the share of good documents that they reject.

Each rule is a number per document and a list of cutoffs, loosest first; the lists are equally long. Policy g rejects what exceeds the
cutoff at place g of any rule. On the labelled holdout the policies of a stratum are tested one after the other by the exact binomial
tail: with n good documents of which k are rejected, the hypothesis "more than ``risk`` of the good ones are rejected" falls if
P(Bin(n, risk) <= k) is at most the level. Testing stops at the first policy that fails (a fixed sequence needs no
correction within a stratum); the level is ``alpha`` divided by the number of strata (Bonferroni). A policy counts the rejections of all
rules together, so neither risk nor level is shared out among the rules, and 0 of ln(level) / ln(1 - risk) good labels certify one.
With confidence ``1 - alpha`` no stratum loses more than ``risk`` of its good documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.common import small, with_key, without
from tillsight.session import materialise

#: name -> (expression over the measures, cutoffs from loose to strict); a document is rejected above the cutoff.
#: Place 8 holds thresholds in common use; those before and after it are looser and stricter by roughly like factors, as far as shares
#: below 1, and for repeats the base rule's 0.2, leave room.
RULES = {
    "symbols": ("try_divide(n_symbols, word_chars)", [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.125, 0.1, 0.08, 0.06, 0.04, 0.02]),
    "same_lines": ("try_divide(n_dup_lines, n_lines)", [0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.375, 0.3, 0.24, 0.18, 0.12, 0.06]),
    "repeats": ("try_divide(n_repeat_words, n_words)", [0.199, 0.195, 0.19, 0.185, 0.18, 0.17, 0.16, 0.15, 0.12, 0.09, 0.06, 0.03]),
    "long_words": ("try_divide(word_chars, n_words)", [40.0, 30.0, 25.0, 20.0, 18.0, 15.0, 12.5, 10.0, 9.0, 8.0, 7.0, 6.0]),
}


def measures(docs: DataFrame, *keep: str) -> DataFrame:
    """One row per document: doc_id, the columns ``keep`` and the measures of its whole text.

    A null text has no words and no lines. Windows are told apart by a 64-bit hash of their five words.
    """
    d = docs.select("doc_id", *keep, F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumns({
        "words": F.expr("regexp_extract_all(text, '[^ \\\\t-\\\\r]+', 0)"),
        "lines": F.expr("filter(split(text, '\\n'), l -> l rlike '[^ \\\\t-\\\\r]')"),
        "n_symbols": F.expr("CAST(regexp_count(text, '[#*$%&|<>]') AS LONG)"),
    })
    d = d.select(
        "doc_id", *keep, "n_symbols", F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("CASE WHEN size(words) > 5 THEN transform(sequence(1, size(words) - 4), i -> xxhash64(slice(words, i, 5))) END").alias("h"),
    )
    # Only texts with some window twice go on; their windows are sorted, neighbours compared, and covered words counted.
    d = d.withColumn("s", F.expr("CASE WHEN size(array_distinct(h)) < size(h) THEN sort_array(transform(h, (x, i) -> struct(x AS h, i AS i))) END"))
    d = d.withColumn("p", F.expr(
        "sort_array(transform(filter(s, (e, j) -> coalesce(e.h = get(s, j - 1).h, false) OR coalesce(e.h = get(s, j + 1).h, false)), e -> e.i))"))
    d = d.withColumn("n_repeat_words", F.expr(
        "coalesce(aggregate(transform(p, (x, j) -> least(5, coalesce(get(p, j + 1) - x, 5))), 0L, (a, x) -> a + x), 0L)"))
    return d.drop("h", "s", "p")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def binomial_tail(k: str, n: str, risk: str) -> str:
    """SQL for P(Bin(n, risk) <= k), summed exactly in logarithms; 1 where k/n is not below the risk."""
    step = f"(ln(({n} - j + 1) / j) + ln({risk}) - ln(1 - {risk}))"
    return f"""CASE WHEN {n} = 0 OR {k} >= {n} * {risk} THEN 1.0D ELSE exp(aggregate(
        CASE WHEN {k} >= 1 THEN sequence(1L, {k}) ELSE CAST(array() AS ARRAY<BIGINT>) END,
        struct({n} * ln(1 - {risk}) AS term, {n} * ln(1 - {risk}) AS total),
        (a, j) -> struct(a.term + {step} AS term,
            greatest(a.total, a.term + {step}) + ln(1 + exp(-abs(a.total - a.term - {step}))) AS total),
        a -> a.total)) END"""


def _grid(cuts: list[float]) -> str:
    return "array(" + ", ".join(f"{c!r}D" for c in cuts) + ")"


def certified_policies(measured: DataFrame, labels: DataFrame, stratum: str, risk: float = 0.01, alpha: float = 0.05,
                       rules: dict | None = None) -> DataFrame:
    """One row per stratum with a certified policy: ``stratum, place, n_good, n_rejected, p_value``.

    Labels with a null quality, a null id or a document that failed the base rules say nothing; repeated labels of
    a document count once, as good if any of them says so. Of the certified policies the one taken rejects the most
    bad documents, and of equals the loosest; one that rejects no bad document is not taken. Too few labels
    certify nothing. Lists of cutoffs of different lengths raise an error.
    """
    rules = rules or RULES
    sizes = {len(cuts) for _, cuts in rules.values()}
    if len(sizes) != 1:
        raise ValueError(f"the rules' lists of cutoffs are not equally long: {sorted(sizes)}")
    size = sizes.pop()
    good = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        (F.max("quality") > 0).alias("good")).withColumnRenamed("doc_id", "label_id")
    held = measured.where(~base_failed()).join(good, F.col("doc_id") == F.col("label_id"))
    # The lists fall, so a document that exceeds b cutoffs of some rule, and no more of any, is rejected by the last b policies.
    beyond = F.greatest(*[F.expr(f"size(filter({_grid(cuts)}, c -> coalesce({value}, 0D) > c))") for value, cuts in rules.values()], F.lit(0))
    counted = held.select(F.col(stratum).alias("stratum"), "good", beyond.alias("beyond")).groupBy("stratum", "beyond").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    counted = materialise(counted, "counted")
    places = counted.groupBy("stratum").agg(F.collect_list(F.struct("beyond", "good", "bad")).alias("c"), F.sum("good").alias("n_good"))
    places = places.select("stratum", "n_good", "c", F.explode(F.sequence(F.lit(1), F.lit(size))).alias("place"))
    over = f"filter(c, x -> x.beyond >= {size} - place + 1)"
    places = places.select(
        "stratum", "n_good", "place",
        F.expr(f"aggregate({over}, 0L, (a, x) -> a + x.good)").alias("n_rejected"),
        F.expr(f"aggregate({over}, 0L, (a, x) -> a + x.bad)").alias("n_bad"))
    strata = counted.select(F.count_distinct(F.struct("stratum"))).scalar()
    tested = places.withColumn("p_value", F.expr(binomial_tail("n_rejected", "n_good", f"{risk!r}D"))).withColumn("level", F.lit(alpha) / strata)
    in_order = Window.partitionBy("stratum").orderBy("place")
    passed = tested.withColumn("open", F.min((F.col("p_value") <= F.col("level")).cast("int")).over(in_order)).where("open = 1 AND n_bad > 0")
    best = Window.partitionBy("stratum").orderBy(F.desc("n_bad"), "place")
    return passed.withColumn("r", F.row_number().over(best)).where("r = 1").select("stratum", "place", "n_good", "n_rejected", "p_value")


def verdicts(measured: DataFrame, policies: DataFrame, stratum: str, rules: dict | None = None) -> DataFrame:
    """``measured`` with base_failed, failed_rules (sorted names) and kept."""
    rules = rules or RULES
    limits = policies.select(F.col("stratum").alias("_stratum"), F.col("place").alias("_place"))
    out = measured.join(small(materialise(limits, "policies"), 10_000), F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    failed = F.array_compact(F.array(*[
        F.when(F.expr(f"coalesce({value}, 0D) > element_at({_grid(cuts)}, _place)"), F.lit(name)) for name, (value, cuts) in sorted(rules.items())]))
    out = out.withColumn("base_failed", base_failed()).withColumn("failed_rules", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("_stratum", "_place")


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.01, alpha: float = 0.05) -> DataFrame:
    """Measures and verdict per document row; repeated rows are judged each, null ids are judged without labels.

    Other columns of ``docs`` and ``labels`` are ignored. A null stratum is a stratum. Empty tables give empty results;
    empty labels certify no policy, so only the base rules reject.
    """
    measured = materialise(measures(docs.select("doc_id", "text", F.col(stratum).alias("_s")), "_s"), "measures")
    policies = certified_policies(measured, labels.select("doc_id", "quality"), "_s", risk, alpha)
    return verdicts(measured, policies, "_s")


def accepted(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.01, alpha: float = 0.05) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep."""
    keyed = with_key(docs.select("doc_id", "text", F.col(stratum).alias("_s")), F.col("text"))
    measured = materialise(measures(keyed, "_s", "k1", "k2"), "measures")
    judged = verdicts(measured, certified_policies(measured, labels.select("doc_id", "quality"), "_s", risk, alpha), "_s")
    return without(docs, materialise(judged.where(~F.col("kept")).select("k1", "k2").distinct(), "rejected"))
