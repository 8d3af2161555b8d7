import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tillsight.llm import repeats as rp


def brute(texts, length):
    seen = Counter()
    data = [(t or "").encode() for t in texts]
    for d in data:
        seen.update(d[i:i + length] for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, dtype=np.int8)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = 1
        rest = bytes(np.frombuffer(d, np.uint8)[gone[:-1] == 0])
        out.append((len(d), int(gone.sum()), int((np.diff(np.append(0, gone)) == 1).sum()), hashlib.sha256(rest).hexdigest()))
    return out


def random_texts(r, n):
    word = lambda k: " ".join(r.choice(["ab", "é", "cde", "f", "gh😀"]) + str(r.randrange(50)) for _ in range(k))
    shared = [word(r.choice([5, 12, 30])) for _ in range(5)]
    out = []
    for _ in range(n):
        t = word(r.randrange(40))
        for s in r.sample(shared, r.randrange(3)):
            t += s[r.randrange(10):] + word(r.randrange(5))
        out.append(t)
    return out


@pytest.mark.parametrize("shard", [1 << 18, 40])
def test_against_brute_force(spark, make_docs, shard):
    r = random.Random(9)
    texts = random_texts(r, 150) + [None, "", "a", "x" * 500, "xy" * 300, "y" * 39, "y" * 40, "z" * 41, "q" * 20 + "w" * 90]
    texts += [texts[0]] * 3 + [texts[1] + "tail", "head" + texts[1], random_texts(r, 1)[0] * 30]
    hot = texts[2] + "common passage that stands everywhere in just the same words"
    texts += [f"{r.random()}{hot}{r.random()}" for _ in range(40)]
    rows = list(enumerate(texts)) + [(2, texts[2]), (None, "only here " * 2)]
    got = rp.without_repeats(make_docs(rows), length=40, gram=8, shard=shard).collect()
    want = Counter((d, *b) for (d, _), b in zip(rows, brute([t for _, t in rows], 40), strict=True))
    assert Counter((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got) == want
    assert all(hashlib.sha256(x.kept).hexdigest() == x.kept_sha256 for x in got)


def test_equal_strings_of_an_anchor_get_one_key():
    r = random.Random(4)
    core = bytes(r.randrange(97, 123) for _ in range(60))
    texts = [bytes(r.randrange(97, 123) for _ in range(30)) + core + bytes(r.randrange(97, 123) for _ in range(30)) for _ in range(30)]
    for step in (5, 1):
        keys, strings = {}, Counter()
        for t in texts:
            for anchor, _, first, count, _ in zip(*(x.tolist() for x in rp.units(t, 40, 8)), strict=True):
                unit, starts = t[first:first + count + 39], []
                for key, _, at, n in rp.pieces(anchor, unit, step, 40, 8):
                    assert 0 < n <= step
                    starts += range(at, at + n)
                    for i in range(at, at + n):
                        s = unit[i:i + 40]
                        strings[s] += 1
                        assert keys.setdefault(s, key) == key
                assert sorted(starts) == list(range(count))
        assert max(strings.values()) == 30
        assert step > 1 or len(set(keys.values())) == len(keys)


@pytest.mark.parametrize("shard", [1 << 18, 400])
def test_one_anchor_of_very_many_units(spark, make_docs, monkeypatch, shard):
    """A phrase, a passage longer than a string and near copies, each in very many different surroundings: no anchor's units meet in one group."""
    r = random.Random(6)
    word = lambda k: " ".join(str(r.randrange(10**6)) for _ in range(k))
    phrase, passage, page = "a phrase of old", word(11), word(40).split()
    texts = [f"{word(8)} {phrase} {word(8)}" for _ in range(80)] + [f"{word(7)} {passage} {word(7)}" for _ in range(80)]
    for _ in range(80):
        near = list(page)
        near[r.randrange(40)] = word(1)
        texts.append(" ".join(near))
    rows = list(enumerate(texts)) + [(3, texts[3]), (100, texts[100])]
    groups, deal = [], rp._deal

    def watched(data, counts, length, gram, many):
        before = counts.agg({"kinds": "max"}).first()[0]
        out, marks = deal(data, counts, length, gram, many)
        groups.append((before, out.groupBy("anchor").agg(rp.F.countDistinct("full").alias("n")).agg({"n": "max"}).first()[0] or 0, many))
        return out, marks

    monkeypatch.setattr(rp, "_deal", watched)
    got = rp.without_repeats(make_docs(rows), length=40, gram=8, shard=shard).collect()
    want = Counter((d, *b) for (d, _), b in zip(rows, brute([t for _, t in rows], 40), strict=True))
    assert Counter((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got) == want
    (before, after, many), = groups
    assert before >= 80
    assert after <= many
    assert shard > 400 or before > many


def test_suffix_arrays_and_common_prefixes():
    r = random.Random(1)
    for _ in range(60):
        text = bytes(r.choice(b"abc"[: r.choice([1, 2, 3])]) for _ in range(r.randrange(1, 120)))
        depth = r.choice([8, 20, 64])
        a = np.frombuffer(text, np.uint8)
        sa, _ = rp.suffix_array(a, depth)
        assert sorted(sa.tolist()) == list(range(len(text)))
        heads = [text[i:i + depth] for i in sa.tolist()]
        assert heads == sorted(heads)
        lcp = rp.neighbours(a, sa, depth)
        for k, (x, y) in enumerate(zip(heads[:-1], heads[1:], strict=True)):
            n = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
            assert lcp[k] == n, (text, depth)


def test_empty_table(spark, make_docs):
    assert rp.without_repeats(make_docs([])).count() == 0
