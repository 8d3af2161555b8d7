"""Exact Jaccard join of documents' sets of word n-grams, by adaptive multi-match prefixes.

Two orders are used. By the first (a hash of the n-gram) each set keeps a window of its first tokens, long enough for
two linked sets to share at least ``l`` tokens in both windows, where l grows with the set. Only window tokens are counted over
all documents. By the second (how many sets have the token in their window, rarest first) a prefix of the window is
taken: sets that share l window tokens share at least k of the first ``window - l + k``. Each document chooses its k by estimated
cost, the pairs that its prefix tokens will meet plus the pairs that may reach k matches; a longer prefix
meets more but asks for more matches. A pair must share min(k, k') prefix tokens before it is verified on the whole sets.

Tokens that one set alone has come first in every prefix and meet nothing, so documents with text of their own are
settled by counting. A token that many sets keep in their prefixes means large groups of near copies: such a list is first joined
with one leader, a line of pairs; what the leader has linked needs no pairs among itself. Lists with many texts outside their largest
component get a few more leaders from among these, round by round, as long as that links them. Afterwards only pairs in which the two
sides are still apart are formed, by joining those outside a list's largest component with the whole list; tokens that a text has for
itself among all texts of such lists and the parities of its tokens, counted by hash, bound what it can share, which settles near copies that
differ by too much.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.common import only, parts, slices, small, with_key, without
from tillsight.llm.hashing import Runs, blank_words, mix
from tillsight.session import materialise

#: Lists of a token longer than this are joined with a leader first.
LONG_LIST = 32
#: Further leaders that a list gets in a round.
LEADERS = 8
#: Cost of verifying a pair, in units of one pair met by a token.
VERIFY = 20


def shingle_sets(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's word n-grams; the whole sequence where there are fewer words."""
    factors = mix(np.arange(11, 11 + size, dtype=np.uint64)) | np.uint64(1)
    for _, run in slices([t or "" for t in texts], 1_000_000):
        encoded = [t.encode() for t in run]
        data = b" ".join(encoded).lower()
        starts, ends = blank_words(data)
        words = Runs(np.frombuffer(data, dtype=np.uint8)).hashes(starts, ends)
        at = np.cumsum([0] + [len(x) + 1 for x in encoded])
        bounds = np.searchsorted(starts, at)
        grams = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
        for j in range(size):
            grams += words[j: j + len(grams)] * factors[j]
        grams = mix(grams)
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            if hi - lo >= size:
                yield np.unique(grams[lo: hi - size + 1])
            elif hi > lo:
                yield mix(np.atleast_1d((words[lo:hi] * factors[: hi - lo]).sum(dtype=np.uint64) + np.uint64(hi - lo)))
            else:
                yield np.zeros(0, dtype=np.uint64)


def least_overlap(n, percent: int):
    """Tokens that a set of n shares at least with any set it links to."""
    return -(-n * percent // 100)


def shared(n, percent: int):
    """l: what two linked sets share at least in both windows; does not fall with n."""
    return 1 + n * (8 if percent >= 85 else 10) // 100


def _sketches(size: int, percent: int):
    schema = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()),
                        ("s2", pa.int64()), ("tokens", pa.list_(pa.int64()))])

    def run(batches):
        for b in parts(batches):
            n, s1, s2, windows = [], [], [], []
            for s in shingle_sets(b.column("text").to_pylist(), size):
                n.append(len(s))
                s1.append(mix(s).sum(dtype=np.uint64).astype(np.int64))
                s2.append(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).astype(np.int64))
                m = len(s)
                windows.append(s[: min(m, m - least_overlap(m, percent) + shared(m, percent))].view(np.int64))
            offsets = np.cumsum([0] + [len(w) for w in windows]).astype(np.int32)
            flat = np.concatenate(windows) if windows else np.zeros(0, np.int64)
            tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("k1"), b.column("k2"), pa.array(n, pa.int64()), pa.array(s1, pa.int64()),
                                              pa.array(s2, pa.int64()), tokens], schema=schema)

    return run


def _compare(size: int, percent: int, every: bool):
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("both", pa.int64()), ("either", pa.int64())])

    def run(batches):
        for b in parts(batches):
            x, y = b.column("x").to_pylist(), b.column("y").to_pylist()
            out = []
            for i, (s, t) in enumerate(zip(shingle_sets(b.column("tx").to_pylist(), size), shingle_sets(b.column("ty").to_pylist(), size), strict=True)):
                both = len(np.intersect1d(s, t, assume_unique=True))
                either = len(s) + len(t) - both
                if every or 100 * both >= percent * either:
                    out.append((x[i], y[i], both, either))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 4)], schema=schema)

    return run


def _tokens(size: int):
    def run(batches):
        for b in parts(batches):
            nodes = b.column("node").to_numpy()
            sets = list(shingle_sets(b.column("text").to_pylist(), size))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(nodes, [len(s) for s in sets])), pa.array(np.concatenate(sets).view(np.int64))],
                                             names=["node", "token"])

    return run


def _parities(size: int):
    """Places of 4 to 8 times a set's tokens, by hash, with the parity of the tokens in each; ``half``: the same in half as many places."""
    def run(batches):
        for b in parts(batches):
            bits, half = [], []
            for s in shingle_sets(b.column("text").to_pylist(), size):
                width = max(128, 4 << max(len(s) - 1, 0).bit_length())
                odd = np.bincount((s & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
                words = np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)
                bits.append(words)
                half.append(words[: len(words) // 2] ^ words[len(words) // 2:])
            lists = [pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(w) for w in x]).astype(np.int32)), pa.array(np.concatenate(x)))
                     for x in (bits, half)]
            yield pa.RecordBatch.from_arrays([b.column("node"), *lists], names=["node", "bits", "half"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of the undirected ``edges`` (x, y) reaches.

    Each round takes the least label among neighbours, then the label's label; rounds end when nothing changes.
    """
    both = materialise(edges.select(F.col("x").alias("u"), F.col("y").alias("v")).union(edges.select("y", "x")).distinct(), "edges")
    labels = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("label")).withColumnRenamed("u", "node")
    labels = materialise(labels, "labels")
    while True:
        named = labels.select(F.col("node").alias("n2"), F.col("label").alias("l2"))
        least = both.join(named, F.col("v") == F.col("n2")).groupBy("u").agg(F.min("l2").alias("least"))
        step = labels.join(least, F.col("node") == F.col("u")).select("node", "label", F.least("label", "least").alias("new"))
        jumped = step.join(named, F.col("new") == F.col("n2"), "left").select("node", "label", F.least("new", F.coalesce("l2", "new")).alias("new"))
        jumped = materialise(jumped, "labels")
        if jumped.where("new <> label").isEmpty():
            return labels
        labels = jumped.select("node", F.col("new").alias("label"))


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int, every: bool = False) -> DataFrame:
    """The pairs (x, y) of distinct nodes whose whole sets are linked, or with ``every`` all of them; what both and either have."""
    a = texts.select(F.col("node").alias("na"), F.col("text").alias("tx"))
    b = texts.select(F.col("node").alias("nb"), F.col("text").alias("ty"))
    side = pairs.join(a, F.col("x") == F.col("na")).join(b, F.col("y") == F.col("nb")).select("x", "y", "tx", "ty")
    return side.mapInArrow(_compare(size, percent, every), "x long, y long, both long, either long")


def _texts(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Written table (node, text) of the wanted nodes (column node)."""
    keys = nodes.join(wanted, "node", "left_semi").select("node", F.col("k1").alias("j1"), F.col("k2").alias("j2"))
    found = docs.join(small(keys, 200_000), (F.col("k1") == F.col("j1")) & (F.col("k2") == F.col("j2"))).select("node", "text")
    return materialise(found.dropDuplicates(["node"]), "texts")


def _under(rows: DataFrame, compared: DataFrame, parities: DataFrame) -> DataFrame:
    """Written table of the texts under each leader: node, n, own, lead, what it shares with the leader (``ov``) and its parities."""
    met = compared.select(F.col("x").alias("cx"), F.col("y").alias("cy"), "both")
    under = rows.select("node", "n", "own", "lead").distinct()
    under = under.join(met, (F.least("node", "lead") == F.col("cx")) & (F.greatest("node", "lead") == F.col("cy")), "left").withColumn(
        "ov", F.when(F.col("node") == F.col("lead"), F.col("n")).otherwise(F.col("both"))).drop("cx", "cy", "both")
    return materialise(under.join(parities.withColumnRenamed("node", "pn"), F.col("node") == F.col("pn"), "left").drop("pn"), "under")


def _labelled(under: DataFrame, labels: DataFrame) -> DataFrame:
    """Written: ``under`` with each text's component, and ``major``, the largest component under the leader."""
    named = under.select(F.col("node").alias("un"), F.col("lead").alias("ul")).join(
        labels.select(F.col("node").alias("ln"), F.col("label").alias("found")), F.col("un") == F.col("ln"), "left")
    named = materialise(named.select("un", "ul", F.coalesce("found", "un").alias("label")), "labelled")
    major = named.groupBy("ul", "label").count().groupBy(F.col("ul").alias("ml")).agg(
        F.max(F.struct("count", F.col("label").alias("major"))).alias("m")).select("ml", "m.major")
    # Written, so that the optimiser can split a leader with very many texts.
    named = named.join(materialise(major, "majors"), F.col("ul") == F.col("ml")).drop("ml")
    return materialise(under.join(named, (F.col("node") == F.col("un")) & (F.col("lead") == F.col("ul"))).drop("un", "ul"), "under")


def _apart(some: DataFrame, under: DataFrame, percent: int, once: bool) -> DataFrame:
    """Distinct pairs (x, y) of a text of ``some`` and one of ``under`` the same leader, in different components, that may link.

    Three bounds settle most without a look: tokens of its own (``own``) no text shares; of the leader's tokens two texts share at most
    what the one with fewer has (``ov``), of other tokens at most what the one with fewer has besides its own; and each place whose
    parities differ (``bits``) holds a token that one of the two lacks. ``once``: ``some`` is all texts outside the largest components.
    """
    other = under.select(*[F.col(c).alias(f"{c}_r") for c in under.columns])
    enough = lambda most: f"100 * ({most}) >= {percent} * (n + n_r - ({most}))"
    odd = lambda a, b: f"aggregate(zip_with({a}, {b}, (a, b) -> bit_count(a ^ b)), 0, (s, x) -> s + x)"
    differ = (f"CASE WHEN size(bits) = size(bits_r) THEN {odd('bits', 'bits_r')} WHEN size(half) = size(bits_r) THEN {odd('half', 'bits_r')} "
              f"WHEN size(bits) = size(half_r) THEN {odd('bits', 'half_r')} ELSE 0 END")
    may = F.expr(f"(own IS NULL OR own_r IS NULL OR {enough('least(n - own, n_r - own_r)')}) AND (own IS NULL OR own_r IS NULL OR ov IS NULL OR ov_r IS NULL OR "
                 f"{enough('least(ov, ov_r) + least(n - ov - own, n_r - ov_r - own_r)')}) AND "
                 # What both have is at most half of what the two have together without what one of them lacks: (n + n_r - d) / 2.
                 f"(100 + {percent}) * (n + n_r - ({differ})) >= {percent} * 2 * (n + n_r)")
    fits = (F.col("lead") == F.col("lead_r")) & (F.col("node") != F.col("node_r")) & (F.col("label") != F.col("label_r")) & _fits(percent, "n", "n_r")
    if once:  # Where both are outside, the pair would come twice: keep one.
        fits = fits & ((F.col("label_r") == F.col("major")) | (F.col("node") < F.col("node_r")))
    return some.join(other, fits & may).select(F.least("node", "node_r").alias("x"), F.greatest("node", "node_r").alias("y")).distinct()


def _led(under: DataFrame, links: list[DataFrame], texts: DataFrame, size: int, percent: int) -> DataFrame:
    """``_labelled`` after rounds of further leaders, whose links are appended to ``links``.

    In each round up to LEADERS texts outside the largest component, drawn by hash, meet all texts under the same leader. Rounds end when no
    leader has more than LONG_LIST texts outside, or when a round has settled less than an eighth of them.
    """
    named, before, turn = _labelled(under, components(links[0])), None, 0
    while True:
        outside = named.where("label <> major")
        many = outside.groupBy(F.col("lead").alias("ol")).count().where(f"count > {LONG_LIST}")
        left = many.agg(F.sum("count")).first()[0] or 0
        if not left or (before is not None and 8 * left > 7 * before):
            return named
        drawn = outside.groupBy("lead", F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(LEADERS)).alias("place")).agg(
            F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), *[c for c in named.columns if c != "lead"])).alias("d"))
        drawn = drawn.join(many, F.col("lead") == F.col("ol"), "left_semi").select("lead", "d.*").drop("h").select(*named.columns)
        pairs = materialise(_apart(small(materialise(drawn, "leaders"), 10_000), named, percent, once=False), "led")
        links.append(materialise(_verified(pairs, texts, size, percent), "led").select("x", "y"))
        every = links[0]
        for more in links[1:]:
            every = every.union(more)
        named, before, turn = _labelled(under, components(every)), left, turn + 1


def _fits(percent: int, a: str, b: str):
    return F.expr(f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})")


def linked(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per document row: doc_id, n_shingles, component_id, n_links (texts of other sets that it links to, as verified), and
    the key k1, k2 and the group (a number; null for the empty set).

    Documents link when the Jaccard similarity of their sets is at least ``percent`` hundredths. ``component_id`` is the smallest doc_id
    that links reach. Equal sets are one node. Null, empty and blank texts have the empty set and link with nothing: their
    component is their own id. Rows repeated with one id get a result each. Null ids take part; a component
    of null ids alone has a null component_id. ``n_links`` counts verified pairs of different sets only: within a group that
    a leader has joined, not all pairs are verified.
    """
    keyed = with_key(docs.select("doc_id", "text"), F.col("text"))
    sketch = keyed.mapInArrow(_sketches(size, percent), "doc_id long, k1 long, k2 long, n long, s1 long, s2 long, tokens array<long>")
    sketch = materialise(sketch.withColumn("rid", F.monotonically_increasing_id()), "sketches")
    # Written, so that the join below has two plain inputs and the optimiser can split a set that very many rows have.
    sets = materialise(sketch.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("rid").alias("node"), F.min("doc_id").alias("first_id")), "sets")
    members = materialise(sketch.where("n > 0").select("rid", "n", "s1", "s2").join(sets, ["n", "s1", "s2"]).select("rid", "node", "first_id"), "members")
    copies = members.where("rid <> node").select("rid")
    reps = sketch.where("n > 0").join(small(copies, 1_000_000), "rid", "left_anti").withColumnRenamed("rid", "node")
    tokens = reps.select("node", F.explode("tokens").alias("token"))
    counts = tokens.groupBy("token").count().where("count > 1").select(F.col("token").alias("t"), F.col("count").alias("df"))
    # What more than one set has in its window, by set, rarest first; the others are known by their number.
    common = tokens.join(counts, F.col("token") == F.col("t")).groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("c"))
    sizes = reps.select(F.col("node").alias("m"), "n", "k1", "k2", F.size("tokens").alias("w"))
    part = sizes.join(common, F.col("m") == F.col("node")).drop("m")
    low = f"((n * {percent} + 99) div 100)"
    part = part.withColumn("l", F.expr(f"1 + {low} * {8 if percent >= 85 else 10} div 100")).withColumn("own", F.expr("w - size(c)"))
    part = part.where("own < w - l + 1")
    met = "aggregate(slice(c, 1, greatest(0, CAST(w - l + k - own AS INT))), 0L, (a, x) -> a + x.df - 1)"
    part = part.withColumn("k", F.expr(
        f"array_min(transform(sequence(1L, least(l, 8L)), k -> struct({met} * (1.0D + {VERIFY} / k) AS cost, k AS k))).k"))
    part = part.select("node", "n", "k", "k1", "k2", (F.col("own") * 1000 / F.col("w")).cast("long").alias("rough"),
                       F.expr("transform(slice(c, 1, greatest(0, CAST(w - l + k - own AS INT))), x -> x.token)").alias("prefix"))
    nodes = materialise(part, "prefixes")
    rows = nodes.select("node", "n", "k", F.explode("prefix").alias("token"), "rough")
    lists = rows.groupBy("token").agg(F.count(F.lit(1)).alias("f"), F.min(F.struct("rough", "node", "n")).alias("lead")).where("f > 1")
    rows = materialise(rows.join(lists.withColumnRenamed("token", "lt"), F.col("token") == F.col("lt")).select(
        "node", "n", "k", "token", "f", F.col("lead.node").alias("lead"), F.col("lead.n").alias("lead_n")), "lists")
    links = []
    # First the leaders of long lists.
    stars = materialise(rows.where(f"f > {LONG_LIST} AND node <> lead").where(_fits(percent, "n", "lead_n")).select(
        F.least("node", "lead").alias("x"), F.greatest("node", "lead").alias("y")).distinct(), "stars")
    long_lists = not stars.isEmpty()
    if long_lists:
        texts = _texts(keyed, nodes, rows.where(f"f > {LONG_LIST}").select("node").distinct())
        compared = materialise(_verified(stars, texts, size, percent, every=True), "stars")
        links.append(compared.where(f"100 * both >= {percent} * either").select("x", "y"))
        # Tokens that one text alone has among all those in long lists: no other of them can share these.
        own = texts.mapInArrow(_tokens(size), "node long, token long").groupBy("token").agg(
            F.count(F.lit(1)).alias("c"), F.min("node").alias("on")).where("c = 1").groupBy("on").agg(F.count(F.lit(1)).alias("own"))
        own = texts.select(F.col("node").alias("tn")).join(own, F.col("tn") == F.col("on"), "left").select("tn", F.coalesce("own", F.lit(0)).alias("own"))
        grouped = rows.where(f"f > {LONG_LIST}").join(materialise(own, "facts"), F.col("node") == F.col("tn"), "left").drop("tn")
        under = _under(grouped, compared, texts.mapInArrow(_parities(size), "node long, bits array<long>, half array<long>"))
        named = _led(under, links, texts, size, percent)
        labels = named.select(F.col("node").alias("tn"), "label").distinct()
        rows = materialise(rows.join(labels, F.col("node") == F.col("tn"), "left").withColumn("label", F.coalesce("label", "node")).drop("tn"), "lists")
    else:
        rows = rows.withColumn("label", F.col("node"))
    # Then all pairs of short lists that share enough tokens, and of long ones those outside a leader's largest component with all it was compared with.
    brief = rows.where(f"f <= {LONG_LIST}").select("token", "node", "n", "k", "label")
    right = brief.select(F.col("token").alias("tr"), *[F.col(c).alias(f"{c}_r") for c in ("node", "n", "k", "label")])
    pairs = brief.join(right, (F.col("token") == F.col("tr")) & (F.col("node") < F.col("node_r")) & (F.col("label") != F.col("label_r"))
                       & _fits(percent, "n", "n_r")).groupBy(F.col("node").alias("x"), F.col("node_r").alias("y")).agg(
        F.count(F.lit(1)).alias("met"), F.min(F.least("k", "k_r")).alias("k")).where("met >= k").select("x", "y")
    if long_lists:
        pairs = pairs.union(_apart(named.where("label <> major"), named, percent, once=True)).distinct()
    pairs = materialise(pairs, "pairs")
    if not pairs.isEmpty():
        texts = _texts(keyed, nodes, pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct())
        links.append(materialise(_verified(pairs, texts, size, percent), "links"))
    out = sketch.select("doc_id", "rid", F.col("n").alias("n_shingles"), "k1", "k2")
    if not links:
        own = out.join(members.withColumnRenamed("rid", "mr"), F.col("rid") == F.col("mr"), "left")
        return own.select("doc_id", "n_shingles", F.coalesce("first_id", "doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"),
                          "k1", "k2", F.col("node").alias("group"))
    edges = links[0].select("x", "y")
    for more in links[1:]:
        edges = edges.union(more.select("x", "y"))
    labels = components(edges)
    degree = edges.select(F.explode(F.array("x", "y")).alias("dn")).groupBy("dn").agg(F.count(F.lit(1)).alias("n_links"))
    firsts = members.where("rid = node").select("node", "first_id")
    grouped = firsts.join(labels.withColumnRenamed("node", "ln"), F.col("node") == F.col("ln")).select("node", "label", "first_id")
    least = grouped.groupBy("label").agg(F.min("first_id").alias("least_id")).withColumnRenamed("label", "gl")
    named = grouped.join(least, F.col("label") == F.col("gl")).join(degree, F.col("node") == F.col("dn")).select(
        F.col("node").alias("gn"), "least_id", "n_links", "label")
    flat = members.join(named, F.col("node") == F.col("gn"), "left").select(
        F.col("rid").alias("mr"), F.coalesce("least_id", "first_id").alias("component_id"), "n_links", F.coalesce("label", "node").alias("group"))
    return out.join(flat, F.col("rid") == F.col("mr"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "k1", "k2", "group")


def representatives(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs``, all columns, for each group: that of the smallest id (null last), and of one row where it is repeated.

    Documents of the empty set are in no group and stay.
    """
    found = materialise(linked(docs, size, percent).where("group IS NOT NULL").select("doc_id", "k1", "k2", "group"), "groups")
    first = found.groupBy(F.col("group").alias("fg")).agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "k1", "k2")).alias("first"))
    first = materialise(first, "firsts")  # so that the optimiser can split a large group in the join
    marked = found.join(first, F.col("group") == F.col("fg")).withColumn("stays", F.struct("k1", "k2") == F.struct("first.k1", "first.k2"))
    keys = materialise(marked.groupBy("k1", "k2").agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("rows")), "keys")
    left = without(docs, keys.where("NOT stays OR rows > 1"))
    repeated = keys.where("stays AND rows > 1")
    return left.unionByName(only(docs, repeated).dropDuplicates(["doc_id", "text"]))
