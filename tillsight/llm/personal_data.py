"""Personal data: expressions propose spans, checksums confirm them, words nearby adjust the score.

Spark's expressions return no positions. So every match is put between two marks (a control character that no pattern
matches), the text is split at the marks, and the running sum of the pieces' lengths gives the code point where each match starts.
Patterns are written so that no text makes them backtrack: runs are possessive, and a match starts at the head of a run
or where the match before it ended, which finds the same leftmost matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MARK, STAND_IN = "\x01", "\x02"
_LOCAL = "A-Za-z0-9._%+-"

#: kind -> (cheap test on the text, pattern, words nearby that speak for it, score of a bare match).
KINDS = {
    "email": (lambda t: F.contains(t, F.lit("@")),
              rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "mail|contact|write", 0.8),
    "ip": (lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]"),
           r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"\bip\b|host|server|address|from", 0.5),
    "card": (lambda t: t.rlike("[0-9](?:[ -]?[0-9]){12}"), "[0-9](?:[ -]?[0-9])++", "card|visa|credit|pay|debit", 0.3),
    "phone": (lambda t: F.contains(t, F.lit("+")), r"\+[0-9][ ().0-9-]+[0-9]", "phone|tel|call|mobile|fax", 0.6),
    "iban": (lambda t: t.rlike("[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}"),
             r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}+(?![A-Za-z0-9])", "iban|account|bank|transfer", 0.2),
    "ssn": (lambda t: t.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}"),
            r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "ssn|social security|tax", 0.3),
}
BASE = ["email", "ip", "card", "phone"]
CONTEXT = 40


def luhn(digits: Column) -> Column:
    """Luhn's sum of a string of digits is a multiple of ten."""
    each = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise(F.when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int"))))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(code: Column) -> Column:
    """The check of account numbers: first four characters to the end, letters as 10 to 35, remainder 1."""
    turned = F.concat(F.substr(code, F.lit(5)), F.substr(code, F.lit(1), F.lit(4)))
    value = lambda c: F.when(F.ascii(c) < 58, F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    step = lambda a, c: (a * F.when(F.ascii(c) < 58, 10).otherwise(100) + value(c)) % 97
    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step) == 1


def _pieces(text: Column, kind: str) -> Column:
    """Pieces of the text around and within the matches; those at odd places are matches. Null where the cheap test fails."""
    test, pattern, _, _ = KINDS[kind]
    parts = F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK)
    return F.when(test(text), parts)


def proposals(docs: DataFrame) -> DataFrame:
    """One row per match: rid, doc_id, kind, start, end, value, before, after; and one per document with kind null.

    ``rid`` tells the document rows apart, so repeated rows and null ids stay separate.
    """
    t = F.coalesce("text", F.lit(""))
    d = docs.select("doc_id", F.when(F.contains(t, F.lit(MARK)), F.translate(t, MARK, STAND_IN)).otherwise(t).alias("text"))
    d = d.withColumn("rid", F.monotonically_increasing_id())
    d = d.select("rid", "doc_id", *[_pieces(F.col("text"), k).alias(k) for k in KINDS])
    kind = "kind string, at int, len int, value string, before string, after string"
    none = "array(named_struct('kind', CAST(NULL AS STRING), 'at', 0, 'len', 0, 'value', CAST(NULL AS STRING), 'before', CAST(NULL AS STRING), 'after', CAST(NULL AS STRING)))"
    each = [f"""coalesce(transform({k}, (p, i) -> named_struct('kind', '{k}', 'at', i, 'len', char_length(p),
        'value', if(i % 2 = 1, p, NULL), 'before', if(i % 2 = 1, right(get({k}, i - 1), {CONTEXT}), NULL),
        'after', if(i % 2 = 1, left(get({k}, i + 1), {CONTEXT}), NULL))), CAST(array() AS ARRAY<STRUCT<{kind.replace(" ", ":").replace(",:", ",")}>>))"""
            for k in KINDS]
    rows = d.select("rid", "doc_id", F.explode(F.expr(f"concat({none}, {', '.join(each)})")).alias("p")).select("rid", "doc_id", "p.*")
    before = F.sum("len").over(Window.partitionBy("rid", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.withColumn("start", F.coalesce(before, F.lit(0)).cast("long"))
    return placed.where("kind IS NULL OR value IS NOT NULL").select(
        "rid", "doc_id", "kind", "start", (F.col("start") + F.col("len")).alias("end"), "value", "before", "after")


def confirmed(found: DataFrame, least: float = 0.5) -> DataFrame:
    """``found`` with ``score``, without the matches that fail.

    A match of a base kind stays if its own rule holds (parts of at most 255, 13 to 19 digits with Luhn's sum, 9 to 15
    digits). A match of the other kinds needs its checksum, where it has one, and a score of ``least``. The score is
    the kind's own, plus 0.4 for a checksum, plus 0.3 for a word nearby, at most 1.
    """
    v, kind = F.col("value"), F.col("kind")
    digits = F.regexp_replace(v, "[^0-9]", "")
    n = F.length(digits)
    parts = F.forall(F.split(v, r"\."), lambda p: p.try_cast("double") <= 255)
    plain = F.replace(v, F.lit(" "), F.lit(""))
    holds = (F.when(kind == "email", True).when(kind == "ip", parts).when(kind == "card", F.when(n.between(13, 19), luhn(digits)).otherwise(False))
             .when(kind == "phone", n.between(9, 15)).when(kind == "iban", mod97(plain)).otherwise(True))
    near = F.lower(F.concat("before", F.lit(" "), "after"))
    context, own = F.lit(False), F.lit(0.0)
    for k, (_, _, words, score) in KINDS.items():
        context = F.when(kind == k, near.rlike(words)).otherwise(context)
        own = F.when(kind == k, F.lit(score)).otherwise(own)
    score = F.round(F.least(F.lit(1.0), own + F.when(kind.isin("card", "iban"), 0.4).otherwise(0.0) + F.when(context, 0.3).otherwise(0.0)), 2)
    judged = found.withColumn("holds", holds).withColumn("score", score)
    return judged.where(kind.isNull() | (F.col("holds") & (kind.isin(BASE) | (F.col("score") >= least)))).drop("holds")


def personal_data(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Per document row: doc_id and ``spans``, an array of (rank, kind, start, end, score, base) by kind as listed, then start.

    Positions are code points, ends exclusive. A null text counts as empty; repeated rows get a result each; other columns
    are ignored. A document's spans are gathered in one row, as its text is.
    """
    rank = F.lit(None).cast("int")
    for i, k in enumerate(KINDS):
        rank = F.when(F.col("kind") == k, i).otherwise(rank)
    span = F.struct(rank.alias("rank"), "start", "end", "kind", "score", F.col("kind").isin(BASE).alias("base"))
    rows = confirmed(proposals(docs), least)
    return rows.groupBy("rid").agg(F.max("doc_id").alias("doc_id"), F.sort_array(F.collect_list(
        F.when(F.col("kind").isNotNull(), span))).alias("spans")).drop("rid")
