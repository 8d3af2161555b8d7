import hashlib
import math
import random

import numpy as np
import pytest

from tillsight.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, x string, code string, error long"


def frame(spark, rows):
    return spark.createDataFrame([(v, e, lab, "x", "y", 1) for v, e, lab in rows], SCHEMA)


def brute(rows, n_parts=8, entries=16, rounds=6):
    """Rows with distinct ids, none null: {vec_id: (code, error, label_error)} and the digest, by comparing everything with everything."""
    good = sorted((v, [math.floor(4096 * float(np.float32(c))) for c in e], lab) for v, e, lab in rows
                  if e and all(c is not None and math.isfinite(c) for c in e))
    dim = len(good[0][1])
    cuts = [slice(p * dim // n_parts, (p + 1) * dim // n_parts) for p in range(n_parts)]
    books = [[x[cut] for _, x, _ in good[:entries]] for cut in cuts]

    def assign():
        out = []
        for _, x, _ in good:
            ds = [[sum((a - b) ** 2 for a, b in zip(x[cut], c)) for c in book] for cut, book in zip(cuts, books)]
            out.append([(d.index(min(d)), min(d)) for d in ds])
        return out

    for _ in range(rounds):
        found = assign()
        for p, cut in enumerate(cuts):
            for e in range(len(books[p])):
                mine = [x[cut] for (_, x, _), f in zip(good, found) if f[p][0] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    found = assign()
    total = {}
    for (_, _, lab), f in zip(good, found):
        total[lab] = total.get(lab, 0) + sum(d for _, d in f)
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return {v: ("".join(f"{e:02x}" for e, _ in f), sum(d for _, d in f), total[lab]) for (v, _, lab), f in zip(good, found)}, digest


def vectors(kind, n=400, dim=24):
    r = random.Random(kind)
    centre = [[r.uniform(-1, 1) for _ in range(dim)] for _ in range(12)]
    rows = []
    for i in range(n):
        c = r.choice(centre)
        if kind == "ties":
            e = [r.choice([-0.5, 0.0, 0.5]) for _ in range(dim)]
        elif kind == "copies":
            e = list(centre[0]) if i % 3 else [x + r.gauss(0, 0.05) for x in c]
        elif kind == "large":
            e = [x * 9000 + r.gauss(0, 3000) for x in c]
        else:
            e = [x + r.gauss(0, 0.2) for x in c]
        rows.append((i * 7 - 50, [min(max(x, -16000.0), 16000.0) for x in e], r.choice([None, 0, 1, 2])))
    r.shuffle(rows)
    return rows + [(10 ** 6, None, 1), (10 ** 6 + 1, [math.nan] * dim, 1), (-10 ** 6, [math.inf] * dim, None), (-10 ** 6 + 1, [None] * dim, None), (-10 ** 7, [], 0)]


@pytest.mark.parametrize("kind", ["plain", "ties", "copies", "large"])
def test_equals_brute_force(spark, kind):
    rows = vectors(kind)
    want, digest = brute(rows)
    got = vc.coded(frame(spark, rows).repartition(3)).collect()
    assert {x.vec_id: (x.code, x.error, x.label_error) for x in got} == want and len(got) == len(want)
    assert {x.codebooks_sha256 for x in got} == {digest}


def test_few_vectors_other_parts_and_empty(spark):
    rows = vectors("plain", n=5, dim=10)
    want, digest = brute(rows, n_parts=3, entries=16)
    got = vc.coded(frame(spark, rows), n_parts=3).collect()
    assert {x.vec_id: (x.code, x.error, x.label_error) for x in got} == want and got[0].codebooks_sha256 == digest
    assert vc.coded(frame(spark, [])).collect() == []
    assert vc.coded(frame(spark, [(1, None, None)])).collect() == []


def test_repeated_and_null_ids_and_other_lengths(spark):
    r = random.Random(3)
    rows = [(r.choice([None, 1, 2, 3]), [r.uniform(-1, 1) for _ in range(16)], 1) for _ in range(60)]
    rows += rows[:20] + [(5, [0.1] * 8, 1)]
    got = vc.coded(frame(spark, rows)).collect()
    assert len(got) == 80 and len({x.label_error for x in got}) == 1 and got[0].label_error == sum(x.error for x in got)
    again = vc.coded(frame(spark, rows[::-1])).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_too_large_components_raise(spark):
    with pytest.raises(Exception, match="beyond"):
        vc.coded(frame(spark, [(1, [1e30] * 8, 0)])).collect()


def test_bounds_spare_comparisons_and_b_never_grows(spark):
    state, books, used = vc.fit_codes(frame(spark, vectors("plain", n=2000)))
    assert used == sorted(used, reverse=True) and used[0] == 4 and used[-1] >= 2
    x = np.array([[math.floor(4096 * float(np.float32(c))) for c in e] for _, e, _ in vectors("plain", n=2000) if e and None not in e and np.isfinite(e).all()])
    ids, bounds = vc.nearest(x[:, :3], books[0], 4)
    after = books[0] + 1
    moved = np.sqrt(((after - books[0]) ** 2).sum(axis=1))
    new_ids, new_bounds, depth = vc.reassign(x[:, :3], after, moved, ids, bounds, 4)
    assert (depth == 1).mean() > 0.9
    want, _ = vc.nearest(x[:, :3], after, 1)
    assert (new_ids[:, 0] == want[:, 0]).all()
    true = np.sqrt(vc._exact(x[:, :3], after))
    assert (new_bounds[:, 0] >= true[np.arange(len(x)), new_ids[:, 0]]).all()
    assert all((new_bounds[:, j] <= true[np.arange(len(x)), new_ids[:, j]]).all() for j in range(1, 4))
