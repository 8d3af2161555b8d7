import random
import re

import pytest

from tillsight.llm import decontamination as dc


def words(text):
    return re.findall(dc.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, size=10):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        b = words(t)
        n = min(size, len(b))
        for i in range(len(b) - n + 1 if b else 0):
            for j in range(len(w) - n + 1):
                if w[j:j + n] == b[i:i + n]:
                    hit.update(range(j, j + n))
                    found.add(item)
    return len(w), len(hit), sorted(str(x) for x in found if x is not None)


def test_against_brute_force(spark, make_docs, prose):
    r = random.Random(3)
    items = [(i, prose(r.choice([3, 9, 10, 11, 25]), 60)) for i in range(30)] + [
        (30, "same same same same same same same same same same same"), (31, None), (32, " .,"), (33, "w1"), (7, "ÉCOLE été W5"),
        (None, "n1 n2 n3 n4"), (100, "n1 n2 n3 n4"), (34, prose(40, 8))]
    texts = [None, "", "...", "w1", "same " * 40, "x " * 500, "École ÉCOLE Été w5 École été", "ÉCOLE Été w5; ÉCOLE été W5", "n1 n2 N3, n4"]
    for i in range(60):
        w = words(r.choice(items)[1])
        t = prose(r.randrange(60), 60).split()
        at = r.randrange(len(t) + 1)
        texts.append(" ".join(t[:at] + w + t[at:] + w[: r.randrange(12)]))
    texts.append(" ".join(prose(3000, 60).split() + words(items[5][1])))
    rows = list(enumerate(texts)) + [(4, "same " * 40), (4, "other text"), (None, texts[12])]
    bench = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id long, text string, wid string")
    got = dc.contamination(make_docs(rows), bench).collect()
    assert len(got) == len(rows)
    left = [(i, *brute(t, items)) for i, t in rows]
    for x in got:
        left.remove((x.doc_id, x.n_words, x.n_hit, list(x.item_ids)))
        assert x.contaminated == (x.n_hit > 0) and x.n_items == len(x.item_ids) <= x.n_near_items


def test_proximity(spark, make_docs):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    got = {x.doc_id: x for x in dc.contamination(make_docs([(1, "delta x gamma y y beta alpha"), (2, "delta " + "x " * 30 + "gamma beta alpha"),
                                                          (3, "delta gamma beta")]), bench).collect()}
    assert [got[i].n_near_items for i in (1, 2, 3)] == [1, 0, 0] and not any(x.contaminated for x in got.values())


def test_empty_tables_and_bad_reach(spark, make_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    got = dc.contamination(make_docs([(1, "a b")]), bench).collect()
    assert [(x.n_words, x.n_hit, x.n_items, x.contaminated) for x in got] == [(2, 0, 0, False)]
    assert dc.contamination(make_docs([]), bench).count() == 0
    with pytest.raises(ValueError):
        dc.contamination(make_docs([]), bench, reach=5)
