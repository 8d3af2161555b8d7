"""Secret scans with multipart credential linking.

Expressions find the base secrets of a text, and weak parts that alone mean little: identifiers (account or client names, access keys),
random-looking strings, and endpoints. Weak parts are joined in Spark by intervals: an identifier's surroundings (``reach`` code
points to either side, in the same scope, a block of lines without an empty one) are cut into bins; a random string that touches one of
them is linked to it, and an endpoint likewise to a linked string. Weak parts are reported only where linked. Parts have a least length (random
strings 20 characters) and no greatest, so few fit within a reach and the pairs grow with the text, not with its square.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import parts, small, with_key
from tillsight.session import materialise

BASE = ["assign", "access", "hex"]
LINKED = ["link_id", "link_secret", "link_endpoint"]
REACH = 300

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # the runs of [0-9a-f]+ that have 32 or more
_NAMED = re.compile(r"""(?:client_?id|account(?:_?id)?|access_?key(?:_?id)?|user(?:name)?|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@+-]{3,})""", re.I | re.A)
_RANDOM = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])")
_ENDPOINT = re.compile(r"""[a-z][a-z0-9+]{1,9}://[^\s"'<>]{4,}|\b[a-z0-9-]+(?:\.[a-z0-9-]+)+:[0-9]{2,5}\b""")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base secrets (kind, start, end) by start, then kind as listed."""
    out = []
    if ":" in text or "=" in text:
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], BASE.index(s[0])))


def weak_parts(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, int]]:
    """(role, scope, start, end) of identifiers, random strings and endpoints; nothing where a text lacks one of the first two."""
    ids = [(s, e) for kind, s, e in base if kind == "access"]
    if ":" in text or "=" in text:
        ids += [m.span(1) for m in _NAMED.finditer(text)]
    if not ids:
        return []
    starts = [s for _, s, _ in base]
    reached = list(accumulate((e for _, _, e in base), max))  # the greatest end of the base spans up to each one

    def free(s: int, e: int) -> bool:
        before = bisect_left(starts, e)  # the base spans that start before e
        return not before or reached[before - 1] <= s

    strings = []
    for m in _RANDOM.finditer(text):
        c = m[0]
        mixed = any("a" <= x <= "z" for x in c) and any("A" <= x <= "Z" for x in c) and any("0" <= x <= "9" for x in c)
        if mixed and len(set(c)) >= 10 and free(*m.span()):
            strings.append(m.span())
    if not strings:
        return []
    breaks = [m.start() for m in re.finditer(r"\n[ \t\r]*\n", text)]
    parts = [("id", *x) for x in ids] + [("secret", *x) for x in strings] + [("endpoint", *m.span()) for m in _ENDPOINT.finditer(text)]
    return [(role, bisect_right(breaks, s), s, e) for role, s, e in parts]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_PART = pa.struct([("role", pa.string()), ("scope", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def _extract(batches):
    for b in parts(batches):
        bases, weak = [], []
        for t in b.column("text").to_pylist():
            base = base_spans(t or "")
            bases.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in base])
            weak.append([dict(zip(("role", "scope", "start", "end"), p, strict=True)) for p in weak_parts(t or "", base)])
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("k1"), b.column("k2"), pa.array(bases, pa.list_(_SPAN)), pa.array(weak, pa.list_(_PART))],
                                         names=["doc_id", "k1", "k2", "base", "weak"])


def _within(a: DataFrame, b: DataFrame, reach: int) -> DataFrame:
    """Interval join: parts of ``a`` and ``b`` of one text and scope at most ``reach`` apart (columns of b end in _b).

    Both sides lie in every bin that they touch, ``a`` with its surroundings; a pair is formed in the first bin that both have.
    """
    first, last = F.expr(f"greatest(start - {reach}, 0) div {reach}"), F.expr(f"(end + {reach}) div {reach}")
    spread = a.withColumn("first", first).withColumn("bin", F.explode(F.sequence("first", last)))
    other = b.select(*[F.col(c).alias(f"{c}_b") for c in ("rid", "scope", "start", "end")], F.expr(f"start div {reach}").alias("first_b"),
                     F.explode(F.expr(f"sequence(start div {reach}, end div {reach})")).alias("bin_b"))
    return spread.join(other, (F.col("rid") == F.col("rid_b")) & (F.col("scope") == F.col("scope_b")) & (F.col("bin") == F.col("bin_b"))
                       & (F.col("bin") == F.greatest("first", "first_b"))
                       & (F.col("start_b") <= F.col("end") + reach) & (F.col("end_b") >= F.col("start") - reach))


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """Per document row: doc_id, k1, k2 (key of id and text) and ``spans``: array of (start, rank, kind, end, base) by start, then kind.

    Positions are code points, ends exclusive. Null texts are empty; repeated rows get a result each; other columns are ignored.
    Identifiers that are base secrets are not reported twice.
    """
    keyed = with_key(docs.select("doc_id", "text"), F.col("text"))
    found = keyed.mapInArrow(_extract, """doc_id long, k1 long, k2 long, base array<struct<kind:string,start:bigint,end:bigint>>,
        weak array<struct<role:string,scope:bigint,start:bigint,end:bigint>>""")
    found = materialise(found.withColumn("rid", F.monotonically_increasing_id()), "secrets")
    parts = found.where(F.size("weak") > 0).select("rid", F.inline("weak"))
    role = {r: parts.where(F.col("role") == r).drop("role") for r in ("id", "secret", "endpoint")}
    pairs = materialise(_within(role["id"], role["secret"], reach).select("rid", "scope", "start", "end", "start_b", "end_b").distinct(), "pairs")
    secrets = pairs.select("rid", "scope", F.col("start_b").alias("start"), F.col("end_b").alias("end")).distinct()
    ends = _within(secrets, role["endpoint"], reach).select("rid", F.lit("link_endpoint").alias("kind"), F.col("start_b").alias("start"), F.col("end_b").alias("end"))
    known = found.select("rid", F.inline("base")).where("kind = 'access'").select("rid", "start", "end")
    ids = pairs.select("rid", "start", "end").distinct().join(known, ["rid", "start", "end"], "left_anti")
    spans = ids.select("rid", F.lit("link_id").alias("kind"), "start", "end").unionByName(
        secrets.select("rid", F.lit("link_secret").alias("kind"), "start", "end")).unionByName(ends).distinct()
    added = spans.groupBy(F.col("rid").alias("r")).agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    every = F.concat("base", F.coalesce("added", F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")))
    rank = lambda s: F.array_position(F.array(*map(F.lit, BASE + LINKED)), s.kind)
    ordered = F.sort_array(F.transform(every, lambda s: F.struct(
        s.start.alias("start"), rank(s).alias("rank"), s.kind.alias("kind"), s.end.alias("end"), s.kind.isin(BASE).alias("base"))))
    return found.join(small(materialise(added, "linked"), 200_000), F.col("rid") == F.col("r"), "left").select("doc_id", "k1", "k2", ordered.alias("spans"))


def _mask(batches):
    for b in parts(batches):
        texts = []
        for text, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist(), strict=True):
            if spans:
                out, at = [], 0
                for s in spans:
                    if s["end"] > at:
                        if s["start"] >= at:
                            out += [text[at: s["start"]], "[SECRET]"]
                        at = s["end"]
                text = "".join([*out, text[at:]])
            texts.append(text)
        yield b.drop_columns(["spans"]).set_column(b.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))


def masked(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """``docs`` with every secret in the text replaced by [SECRET]; all rows and columns stay, null texts stay null.

    A column n_chars follows the new text.
    """
    hits = scan(docs, reach).where(F.size("spans") > 0).select(F.col("k1").alias("_j1"), F.col("k2").alias("_j2"), F.col("spans").alias("_spans"))
    hits = materialise(hits.dropDuplicates(["_j1", "_j2"]), "hits")
    k1, k2 = F.coalesce(F.col("doc_id"), F.lit(0)).cast("long"), F.xxhash64(F.col("text"), F.col("doc_id").isNull())
    plain = docs.join(small(hits, 50_000), (k1 == F.col("_j1")) & (k2 == F.col("_j2")), "left").select(
        "text", F.col("_spans").alias("spans"), F.struct(*[F.col(c) for c in docs.columns if c != "text"]).alias("row"))
    out = plain.mapInArrow(_mask, plain.drop("spans").schema)
    chars = {c: F.char_length("text").cast(t) for c, t in docs.dtypes if c == "n_chars"}
    return out.select(*[chars[c].alias(c) if c in chars else F.col("text") if c == "text" else F.col(f"row.{c}") for c in docs.columns])
