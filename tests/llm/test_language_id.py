import random

from tillsight.llm import language_id as li


def test_presence_is_that_of_each_text_alone():
    texts = ["Hello", "", "a", "ab", "éa" * 50, "hello"]
    together = li.presence(texts)
    for i, t in enumerate(texts):
        assert (together[i] == li.presence([t])[0]).all()
    assert (together[0] == together[5]).all() and together[1].sum() == 0 and together[2].sum() == 1
    assert together[3].sum() == 3


def test_held_out_accuracy_and_cases(spark, make_docs):
    r = random.Random(4)
    syllables = {"en": ["th", "er", "ing", "wh"], "fr": ["é", "eau", "tion", "ou"], "de": ["sch", "ung", "ei", "ß"]}
    rows = []
    for i in range(900):
        lang = list(syllables)[i % 3]
        text = " ".join("".join(r.choice(syllables[lang]) for _ in range(3)) for _ in range(r.randrange(1, 60)))
        rows.append((i, text, lang if i % 7 else None))
    extra = [(1000, None, "en"), (1001, "", "en"), (1002, "123 ...", "fr"), (None, "therwhing", "en"), (5, rows[5][1], rows[5][2]), (1003, "ei" * 30_000, "de")]
    got = li.identify(make_docs(rows + extra), max_rows=120, landmarks=40).collect()
    assert len(got) == len(rows) + len(extra)
    truth = {i: list(syllables)[i % 3] for i in range(900)}
    held = [x for x in got if x.held_out and x.doc_id in truth]
    assert len(held) > 100 and sum(x.lang_pred == truth[x.doc_id] for x in held) >= 0.97 * len(held)
    assert all(0 <= x.score <= 1 for x in got)
    by = {x.doc_id: x for x in got}
    assert [by[i].lang_pred for i in (1000, 1001, 1002, None, 1003)] == ["und", "und", "und", "en", "de"]


def test_nothing_to_learn_from(spark, make_docs):
    got = li.identify(make_docs([(1, "words", None)])).collect()
    assert [(x.lang_pred, x.score) for x in got] == [("und", 0.0)]
    assert li.identify(make_docs([])).count() == 0
