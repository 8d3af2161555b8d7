"""Benchmark decontamination by a positional inverted index of the training documents.

The index holds a posting (document, term, position) for every occurrence of a benchmark word in any document; a word
that no benchmark item has can be in no match. Per window of an item the terms are ordered by their number of postings
in the whole corpus. The list of the rarest term is intersected with that of the second rarest (positions less than
``reach`` apart), and what is left is checked against the lists of all terms of the window: the phrase occurs where
every position less its offset agrees, a proximity match is where each distinct term lies within ``reach`` words
of the rarest one. Lists are cut into bins of positions, so a frequent term in a long document is not paired with itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.common import ascii_lower, small, with_key, without
from tillsight.session import materialise

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Not a word character, so it is no word: stands at the end of each document's words.
END = "\x00"


def words(text: Column) -> Column:
    """Lower-cased words of a text; a null text has none."""
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


@dataclass
class Index:
    """``documents``: k1, k2, doc_id, n_words. ``postings``: k1, k2, term, pos. ``terms``: word, term, n."""

    documents: DataFrame
    postings: DataFrame
    terms: DataFrame


def build_index(docs: DataFrame, vocabulary: DataFrame) -> Index:
    """Index of all ``docs`` for the words of ``vocabulary`` (column word)."""
    ids = materialise(vocabulary.select("word").distinct().withColumn("term", F.monotonically_increasing_id()), "terms")
    ends = docs.sparkSession.createDataFrame([(END, -1)], "word string, term long")
    d = with_key(docs.select("doc_id", "text"), F.col("text"))
    tokens = d.select("k1", "k2", "doc_id", F.posexplode(F.concat(words(F.col("text")), F.array(F.lit(END)))).alias("pos", "word"))
    stored = materialise(tokens.join(small(ids.union(ends), 500_000), "word").select(
        "k1", "k2", "term", "pos", F.when(F.col("term") == -1, F.col("doc_id")).alias("doc_id")), "postings")
    postings = stored.where("term >= 0").select("k1", "k2", "term", "pos")
    counts = postings.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return Index(stored.where("term = -1").select("k1", "k2", "doc_id", F.col("pos").cast("long").alias("n_words")), postings,
                 materialise(ids.join(counts, "term"), "term_counts"))


def windows(benchmark: DataFrame, size: int) -> DataFrame:
    """item_id and ws, the words of each window: ``size`` consecutive words, or all where an item has fewer."""
    w = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    return w.select("item_id", "w", F.explode(starts).alias("i")).select("item_id", F.slice("w", F.col("i"), size).alias("ws"))


def matches(docs: DataFrame, benchmark: DataFrame, size: int = 10, reach: int = 20) -> tuple[Index, DataFrame, DataFrame]:
    """The index; matches (k1, k2, wid, start, len, phrase, near); windows of items (wid, item_id).

    ``start`` is the word where the phrase begins; for a mere proximity match (phrase false) it is where it would begin,
    judged by the rarest term. Documents and items without words match nothing; repeated items share their windows.
    """
    found = materialise(windows(benchmark, size), "windows")
    uniq = materialise(found.select("ws").distinct().withColumn("wid", F.monotonically_increasing_id()), "distinct_windows")
    items = materialise(found.join(uniq, "ws").select("wid", "item_id").distinct(), "window_items")
    index = build_index(docs, uniq.select(F.explode("ws").alias("word")))
    spots = uniq.select("wid", F.size("ws").alias("len"), F.posexplode("ws").alias("off", "word")).join(index.terms, "word", "left")
    rarity = Window.partitionBy("wid").orderBy("n", "off")
    every = Window.partitionBy("wid")
    spots = spots.withColumns({"rank": F.row_number().over(rarity), "known": F.count("n").over(every),
                               "n_terms": F.size(F.collect_set("word").over(every))}).where("known = len")
    spots = materialise(spots.select("wid", "len", "off", "term", "rank", "n_terms"), "window_terms")
    first = spots.where("rank = 1").select("wid", "len", "n_terms", F.col("off").alias("off1"), F.col("term").alias("term1"))
    second = spots.where("rank = 2").select(F.col("wid").alias("wid2"), F.col("term").alias("term2"))
    post = index.postings
    pairs = first.join(second, F.col("wid") == F.col("wid2"), "left").drop("wid2")
    at = post.join(small(pairs, 500_000), F.col("term") == F.col("term1")).select("k1", "k2", "wid", "len", "term2", F.col("pos").alias("pos1"))
    wide = 8 * reach
    lists = post.join(small(second.select(F.col("term2").alias("term")).distinct(), 500_000), "term", "left_semi").select(
        F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("term").alias("t2"), F.col("pos").alias("pos2"),
        F.expr(f"pos div {wide}").alias("bin2"))
    near_bins = F.sequence(F.expr(f"greatest(pos1 - {reach}, 0) div {wide}"), F.expr(f"(pos1 + {reach}) div {wide}"))
    both = at.where("len > 1").drop("len").withColumn("bin", F.explode(near_bins)).join(
        lists, (F.col("k1") == F.col("a1")) & (F.col("k2") == F.col("a2")) & (F.col("term2") == F.col("t2"))
        & (F.col("bin") == F.col("bin2")) & (F.abs(F.col("pos1") - F.col("pos2")) <= reach), "left_semi")
    likely = both.select("k1", "k2", "wid", "pos1").union(at.where("len = 1").select("k1", "k2", "wid", "pos1")).distinct()
    facts = first.select(F.col("wid").alias("fw"), "len", "n_terms", "off1")
    likely = materialise(likely.join(small(facts, 500_000), F.col("wid") == F.col("fw")).drop("fw"), "likely")
    columns = ["k1", "k2", "wid", "len", "n_terms", "off1", "pos1"]
    # Of the postings only those of documents with something left are needed.
    owners = likely.select(F.col("k1").alias("a1"), F.col("k2").alias("a2")).distinct()
    rest = post.join(small(owners, 200_000), (F.col("k1") == F.col("a1")) & (F.col("k2") == F.col("a2")), "left_semi").select(
        F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("term").alias("t2"), F.col("pos").alias("pos2"),
        F.expr(f"pos div {wide}").alias("bin2")).distinct()
    probes = likely.join(small(spots.select(F.col("wid").alias("w"), "off", "term"), 500_000), F.col("wid") == F.col("w"))
    probes = probes.withColumn("bin", F.explode(near_bins))
    seen = probes.join(rest, (F.col("k1") == F.col("a1")) & (F.col("k2") == F.col("a2")) & (F.col("term") == F.col("t2"))
                       & (F.col("bin") == F.col("bin2")) & (F.abs(F.col("pos1") - F.col("pos2")) <= reach))
    fits = F.col("pos2") - F.col("off") == F.col("pos1") - F.col("off1")
    judged = seen.groupBy(*columns).agg(
        F.count_distinct(F.when(fits, F.col("off"))).alias("n_fit"), F.count_distinct("term").alias("n_seen"))
    judged = judged.select(
        "k1", "k2", "wid", (F.col("pos1") - F.col("off1")).alias("start"), "len",
        (F.col("n_fit") == F.col("len")).alias("phrase"), (F.col("n_seen") == F.col("n_terms")).alias("near"))
    return index, materialise(judged.where("phrase OR near"), "matches"), items


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10, reach: int = 20) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, item_ids (sorted as strings), contaminated, n_near_items, and the key k1, k2.

    A word is hit if it lies in any occurrence of a window. Items with a null id hit words but are not listed or counted.
    Null and empty texts have no words and no hits. Rows repeated with the same id and text get a result each. Windows
    reach at most ``reach`` words around their rarest term, so ``reach`` must not be less than ``size``.
    """
    if reach < size:
        raise ValueError("reach must be at least size")
    index, found, items = matches(docs, benchmark, size, reach)
    key = ["k1", "k2"]
    spans = found.where("phrase").groupBy(*key, "start").agg((F.col("start") + F.max("len")).alias("end"))
    before = F.max("end").over(Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce("before", F.lit(0))))
    hit = spans.withColumn("before", before).groupBy(*key).agg(F.sum(fresh).cast("long").alias("n_hit"))
    named = found.groupBy(*key, "wid").agg(F.max("phrase").alias("phrase")).join(small(items.where("item_id IS NOT NULL"), 500_000), "wid")
    named = named.groupBy(*key, "item_id").agg(F.max("phrase").alias("phrase")).groupBy(*key).agg(
        F.array_sort(F.collect_list(F.when(F.col("phrase"), F.col("item_id").cast("string")))).alias("item_ids"),
        F.count(F.lit(1)).alias("n_near_items"))
    out = index.documents.join(hit.join(named, key, "full"), key, "left")
    n_hit, ids = F.coalesce("n_hit", F.lit(0)), F.coalesce("item_ids", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "n_words", n_hit.cast("long").alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"),
        (n_hit > 0).alias("contaminated"), F.coalesce("n_near_items", F.lit(0)).cast("long").alias("n_near_items"), "k1", "k2")


def clean(docs: DataFrame, benchmark: DataFrame, size: int = 10, reach: int = 20) -> DataFrame:
    """The rows of ``docs``, all columns, in which no window of an item occurs."""
    found = contamination(docs, benchmark, size, reach).where("contaminated")
    return without(docs, materialise(found.select("k1", "k2").distinct(), "contaminated"))
