import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from tillsight.llm import target_resampling as tr
from tillsight.session import materialise

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def grams(text):
    w = WORD.findall((text or "").translate(UPPER))
    return len(w), [" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(rows, target, percent=5, least=20):
    count = lambda texts: Counter(zlib.crc32(g.encode()) % 10000 for t in texts for g in grams(t)[1])
    s, t = count(x for _, x in rows), count(target)
    big_s, big_t = sum(s.values()), sum(t.values())
    out, able = {}, []
    for doc, text in rows:
        n, g = grams(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000))))
                     for b in (zlib.crc32(x.encode()) % 10000 for x in g))
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[doc] = (n, len(g), weight, score)
        if n >= least:
            able.append((-score, doc))
    ranks = {d: i + 1 for i, (_, d) in enumerate(sorted(able)[: percent * len(able) // 100])}
    return {d: (*v, ranks.get(d)) for d, v in out.items()}


@pytest.fixture
def corpus():
    r = random.Random(4)
    words = ["alpha", "Beta", "ÉTÉ", "ß9", "漢字", "x" * 64, "y" * 65, "Z" * 300, "0", "a_b", "it's", "İI"]
    make = lambda n: "".join(r.choice(words) + r.choice(" \n.,--%") for _ in range(n))
    return [(i, make(r.randrange(0, 90))) for i in range(400)] + [(1000, None), (1001, ""), (1002, "..."), (1003, make(4000))], [make(50) for _ in range(5)]


def test_equals_brute_force(spark, make_docs, corpus, monkeypatch):
    rows, target = corpus
    bench = spark.createDataFrame([(i, t) for i, t in enumerate([*target, None])], "item_id long, text string")
    want = brute(rows, target, percent=20)
    assert sum(v[4] is not None for v in want.values()) > 40
    for block in (tr.BLOCK, 1000):
        monkeypatch.setattr(tr, "BLOCK", block)
        got = tr.drawn(make_docs(rows), bench, percent=20, chunk=16, few=3)
        assert {x.doc_id: (x.n_words, x.n_features, x.weight, x.score, x.rank) for x in got.collect()} == want


def test_ties_repeated_rows_null_ids_empty_tables(spark, make_docs, prose):
    bench = spark.createDataFrame([], "item_id long, text string")
    t = prose(30)
    rows = [(7, t)] * 50 + [(None, t)] * 5 + [(7, prose(30))] * 5 + [(3, "short")]
    got = tr.drawn(make_docs(rows), bench, percent=50, chunk=8, few=2).collect()
    assert len(got) == 61
    assert sorted(x.rank for x in got if x.rank) == list(range(1, 31))
    best = sorted((x for x in got if x.n_words >= 20), key=lambda x: -x.score)
    assert {x.score for x in got if x.rank} == {x.score for x in best[:30]}
    assert tr.drawn(make_docs([]), bench).collect() == []
    assert [x.rank for x in tr.drawn(make_docs([(1, t)]), bench).collect()] == [None]


def test_cutoff_is_the_kth_key(spark):
    r = random.Random(9)
    rows = [(r.randrange(-3, 3), r.randrange(4), 0, i) for i in range(3000)]
    r.shuffle(rows)
    table = materialise(spark.createDataFrame(rows, "a long, b long, t long, u long").repartition(5), "keys")
    order = sorted(rows)
    for k in (1, 2, 1500, 2222, 2999, 3000):
        assert tr.cutoff(table, k, chunk=100, few=4) == order[k - 1]


def test_medians_discard_a_quarter(spark):
    rows = [(i * i % 10007, 0, 0, i) for i in range(5000)]
    table = materialise(spark.createDataFrame(rows, "a long, b long, t long, u long").repartition(7), "keys")
    medians = table.mapInArrow(tr._medians(None, 64), "side int, n long, a long, b long, t long, u long").collect()
    pivot = tr._weighted_median([x[1:] for x in medians])
    below = sum(row < pivot for row in rows)
    assert 5000 // 4 - 64 <= below <= 3 * 5000 // 4 + 64
