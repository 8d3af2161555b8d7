import random
import re

import pytest

from tillsight.llm import ngram_jaccard as nj


def brute(rows, size, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(d)
    return sorted(((d, len(sets[i]), min((x for x in groups[root(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows)), key=str)


def edited(r, words, edits):
    w = list(words)
    for _ in range(edits):
        i = r.randrange(len(w))
        w[i] = f"e{r.randrange(10**6)}" if r.random() < 0.7 else w[r.randrange(len(w))]
    return " ".join(w)


@pytest.mark.parametrize("size,percent,seed,long_list", [(3, 90, 1, 32), (5, 80, 2, 32), (3, 90, 3, 4), (5, 80, 4, 2)])
def test_against_brute_force(spark, make_docs, prose, monkeypatch, size, percent, seed, long_list):
    monkeypatch.setattr(nj, "LONG_LIST", long_list)
    r = random.Random(seed)
    texts = [None, "", " \t\n", "a", "A", "a  b", "a b", "É b", "é b", "one two three", "ONE\ttwo\nthree", "x " * 500, "x " * 300]
    shared = prose(60, 5000)
    for g in range(12):
        base = prose(r.choice([12, 40, 150, 400]), 3000).split()
        for _ in range(r.choice([1, 2, 6])):
            texts.append(edited(r, base, r.randrange(1 + len(base) // 25)))
        texts.append(" ".join(base) + " " + shared)
    hot = prose(150, 3000).split()
    texts += [edited(r, hot, r.randrange(9)) for _ in range(90)] + [" ".join(hot)] * 30
    texts += [shared + " " + prose(60, 5000) for _ in range(40)]
    r.shuffle(texts)
    rows = [(2 * i, t) for i, t in enumerate(texts)] + [(None, "a b"), (4, texts[2]), (None, "lonely words here")]
    got = nj.linked(make_docs(rows), size, percent).collect()
    assert sorted(((x.doc_id, x.n_shingles, x.component_id) for x in got), key=str) == brute(rows, size, percent)


def test_empty_and_unlinked(spark, make_docs):
    assert nj.linked(make_docs([])).count() == 0
    got = nj.linked(make_docs([(1, "a b c d e f"), (2, None), (3, "q r s t u v")])).collect()
    assert sorted((x.doc_id, x.component_id, x.n_links) for x in got) == [(1, 1, 0), (2, 2, 0), (3, 3, 0)]


@pytest.mark.parametrize("edits,bases", [(3, 1), (1, 2)])
def test_group_of_near_copies_is_not_verified_pair_by_pair(spark, make_docs, prose, monkeypatch, edits, bases):
    """Near copies that do not quite link (similarity 0.66), and two linked groups under one leader: no square of their number is verified."""
    sizes, written = {}, nj.materialise

    def counted(df, name="stage"):
        out = written(df, name)
        if name in ("stars", "led", "pairs"):
            sizes[name] = sizes.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(nj, "materialise", counted)
    base = prose(150, 100_000).split()
    other = [*base[:70], *(f"o{i}" for i in range(5)), *base[75:]]
    other[20] = "o"
    rows = []
    for i in range(160):
        words = list((base, other)[i % bases])
        for j in range(edits):
            words[(i * 37 + j * 50) % 150] = f"e{i}x{j}"
        rows.append((i, " ".join(words)))
    got = nj.linked(make_docs(rows), 5, 80).collect()
    assert sorted(((x.doc_id, x.n_shingles, x.component_id) for x in got), key=str) == brute(rows, 5, 80)
    assert sum(sizes.values()) < 160 * 16, sizes
