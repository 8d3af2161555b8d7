import re
from collections import Counter
from fractions import Fraction
from math import comb

import pytest

from tillsight.llm import quality_rules as qr


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    for x in lines:
        dup += x in seen
        seen.add(x)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    c, hit = Counter(grams), set()
    for i, g in enumerate(grams):
        if c[g] > 1:
            hit.update(range(i, i + 5))
    return (len(words), sum(map(len, words)), sum(x in "#*$%&|<>" for x in text), dup, len(hit))


def test_measures(spark, make_docs, prose):
    texts = [None, "", " \n\t ", "a", "a b c d e", "a b c d e f a b c d e", "x\ny\nx\n \n \nx", "É$ #&\x0bü\x0c<>|\r\nß", "a " * 300,
             prose(50, 3), prose(4000, 5), prose(30) + "\n" + prose(30), "q" * 50_000 + "   nbsp", "l1\r\nl1\r\nl1"]
    got = qr.measures(make_docs(list(enumerate(texts)) + [(1, ""), (None, "n n")])).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        text = "n n" if r.doc_id is None else texts[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(text), repr(text)[:50]


def test_binomial_tail_is_exact(spark):
    cases = [(0, 10), (0, 3000), (3, 4000), (40, 20_000), (24, 10_000), (25, 10_000), (0, 0), (2400, 1_000_000)]
    df = spark.createDataFrame(cases, "k long, n long")
    for r in df.selectExpr("k", "n", f"{qr.binomial_tail('k', 'n', '0.0025D')} AS p").collect():
        if r.n == 0 or r.k >= r.n * 0.0025:
            assert r.p == 1.0
        elif r.n < 100_000:
            e = Fraction(25, 10_000)
            exact = float(sum(comb(r.n, j) * e**j * (1 - e) ** (r.n - j) for j in range(r.k + 1))) if r.n < 5000 else None
            assert exact is None or abs(r.p - exact) < 1e-9 * max(exact, 1e-3)
            assert 0 < r.p <= 1


def test_cutoffs_hold_their_risk_and_reject_the_bad(spark, make_docs):
    good, bad = "plain words that go on " * 3, "plain w#rds #### #### on " * 3
    rows = [(i, (good if i % 10 else bad) + f" n{i} m{i} o{i} p{i} q{i} r{i} s{i}" * 4, "en" if i < 6000 else None) for i in range(6100)]
    labels = spark.createDataFrame([(i, int(i % 10 > 0), 0) for i in range(6100)] + [(3, 1, 0), (None, 1, 1), (4, None, 0)],
                                   "doc_id long, quality int, toxic int")
    docs = make_docs(rows)
    r = qr.judge(docs, labels).collect()
    assert len(r) == 6100
    for x in r:
        # The stratum of a hundred labels certifies nothing; the other rejects what has symbols and nothing else.
        assert x.kept == (x.base_failed is False and (x.doc_id % 10 > 0 or x.doc_id >= 6000)), x


def test_policies_are_those_of_a_brute_force_version(spark, make_docs):
    """Strata with many labels, with few, with errors among the good ones, and a null one."""
    plain, signs = "plain words that go on and on here today ", "plain w#rds #### #### on and on here today "
    rows, quality = [], []
    for s, n, bad_every, wrong_every in (("en", 1400, 10, 0), ("de", 900, 4, 900), ("fr", 120, 3, 0), (None, 700, 5, 25)):
        for _ in range(n):
            i = len(rows)
            bad = i % bad_every == 0
            noisy = bad or (wrong_every and i % wrong_every == 1)
            rows.append((i, (signs if noisy else plain) + f"n{i} m{i} o{i}", s))
            quality.append((i, int(not bad), 0))
    docs = make_docs(rows)
    measured = qr.measures(docs.select("doc_id", "text", "lang"), "lang")
    got = {r.stratum: (r.place, r.n_good, r.n_rejected) for r in qr.certified_policies(
        measured, spark.createDataFrame(quality, "doc_id long, quality int, toxic int"), "lang").collect()}
    size, want = len(qr.RULES["symbols"][1]), {}
    m = {r.doc_id: r for r in measured.collect()}
    share = {
        "symbols": lambda r: r.n_symbols / r.word_chars, "same_lines": lambda r: r.n_dup_lines / r.n_lines,
        "repeats": lambda r: r.n_repeat_words / r.n_words, "long_words": lambda r: r.word_chars / r.n_words}
    for s in ("en", "de", "fr", None):
        mine = [(m[i], q) for (i, _, lang), (_, q, _) in zip(rows, quality, strict=True) if lang == s]
        best = None
        for g in range(size):
            hit = [(any(f(r) > qr.RULES[name][1][g] for name, f in share.items()), q) for r, q in mine]
            n, k, b = sum(q for _, q in hit), sum(h and q for h, q in hit), sum(h and not q for h, q in hit)
            if k >= n * 0.01 or sum(comb(n, j) * 0.01**j * 0.99 ** (n - j) for j in range(k + 1)) > 0.05 / 4:
                break
            if b and (best is None or b > best[0]):
                best = (b, g + 1, n, k)
        if best:
            want[s] = best[1:]
    assert got == want and {s: w[2] for s, w in want.items()} == {"en": 0, "de": 1}


def test_lists_of_different_lengths_raise(spark, make_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    with pytest.raises(ValueError, match="equally long"):
        qr.certified_policies(qr.measures(make_docs([])), labels, "doc_id", rules={"a": ("n_words", [1.0]), "b": ("n_words", [2.0, 1.0])})


def test_empty_tables(spark, make_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert qr.judge(make_docs([]), labels).count() == 0
    assert [x.kept for x in qr.judge(make_docs([(1, "one two three four five six seven eight nine ten"), (2, None)]), labels)
            .orderBy("doc_id").collect()] == [True, False]
