import hashlib
import random

import numpy as np

from tillsight.llm import recompression as rc


def brute(rows, window):
    """Per (doc_id, text), in the operator's order of documents: n_words, n_removed, the words left."""
    seen, out = {}, {}
    for doc, text in rows:
        w = (text or "").encode().split()
        for i in range(len(w) - window + 1):
            seen.setdefault(tuple(w[i:i + window]), (doc, i))
    for doc, text in rows:
        w = (text or "").encode().split()
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] < (doc, i):
                gone.update(range(i, i + window))
        rest = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[doc] = (len(w), len(gone), hashlib.sha256(rest).hexdigest(), rest.decode())
    return out


def texts(prose, seed=1):
    r = random.Random(seed)
    passages = [prose(n) for n in (19, 20, 21, 25, 60, 200)]
    rows = []
    for i in range(160):
        kind = r.randrange(6)
        if kind == 0:
            rows.append(prose(r.randrange(0, 60)))
        elif kind == 1:
            rows.append(" ".join([prose(r.randrange(0, 30)), r.choice(passages), prose(r.randrange(0, 30), 3)]))
        elif kind == 2:
            rows.append("\n".join([r.choice(passages), "\t", r.choice(passages)]))
        elif kind == 3:
            w = passages[5].split()
            w[r.randrange(200)] = "other"
            rows.append(" ".join(w))
        elif kind == 4:
            rows.append("a b " * r.randrange(5, 60) + "c " * r.randrange(0, 50))
        else:
            rows.append("é ß 漢字 \x1f \x85 " * r.randrange(1, 9) + passages[1])
    return list(enumerate(rows)) + [(900, None), (901, ""), (902, " \n"), (903, "x " * 3000)]


def test_equals_brute_force(spark, make_docs, prose):
    rows = texts(prose)
    want = brute(rows, 20)
    assert sum(w[1] > 0 for w in want.values()) > 60
    for options in ({}, {"rounds": "R"}, {"rounds": "RPRPP", "block": 50}):
        got = {x.doc_id: (x.n_words, x.n_removed, x.kept_sha256, x.kept) for x in rc.without_repeats(make_docs(rows), **options).collect()}
        assert got == want


def test_short_windows(spark, make_docs):
    r = random.Random(5)
    rows = [(i, " ".join(r.choice("ab") for _ in range(r.randrange(40)))) for i in range(60)]
    want = brute(rows, 4)
    got = {x.doc_id: (x.n_words, x.n_removed, x.kept_sha256, x.kept) for x in rc.without_repeats(make_docs(rows), window=4).collect()}
    assert got == want


def test_repeated_rows_null_ids_and_empty_table(spark, make_docs, prose):
    t, u = prose(40), prose(40)
    rows = [(5, t), (5, t), (None, t), (None, t), (7, t + " " + u), (7, u), (9, u)]
    got = sorted((x.doc_id is not None, x.doc_id or 0, x.n_words, x.n_removed) for x in rc.without_repeats(make_docs(rows), keep=False).collect())
    # The null id counts as 0, so its rows are one document and stay; of the two texts with id 7, one comes before the other.
    assert got[:4] == [(False, 0, 40, 0)] * 2 + [(True, 5, 40, 40)] * 2
    assert got[6] == (True, 9, 40, 40) and {got[4][2:], got[5][2:]} in ({(40, 0), (80, 80)}, {(40, 40), (80, 40)})
    assert rc.without_repeats(make_docs([])).collect() == []


def test_one_passage_in_a_third_of_all_rows(spark, make_docs, prose):
    passage = prose(30)
    rows = [(i, f"{prose(15)} {passage} {prose(15)}" if i % 3 == 0 else prose(40)) for i in range(600)] + [(1000 + i, passage) for i in range(300)]
    want = brute(rows, 20)
    got = {x.doc_id: (x.n_words, x.n_removed, x.kept_sha256, x.kept) for x in rc.without_repeats(make_docs(rows)).collect()}
    assert got == want


def test_equal_windows_have_equal_anchors_at_equal_places():
    r = np.random.default_rng(2)
    for _ in range(50):
        word = r.integers(0, r.integers(2, 60), 20).astype(np.uint64)
        seen = set()
        for _ in range(8):
            left, right = (r.integers(0, 60, r.integers(0, 30)).astype(np.uint64) for _ in range(2))
            sym = rc.mix(np.concatenate([left, word, right]) + np.uint64(1))
            fresh = np.zeros(len(sym), dtype=bool)
            fresh[0] = True
            starts, name, place = rc.anchors(sym, fresh)
            i = np.flatnonzero(starts == len(left))[0]
            seen.add((name[i], place[i] - starts[i]))
        assert len(seen) == 1
