import random
import re

from tillsight.llm import personal_data as pd

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits))
                    or kind == "phone" and not 9 <= len(digits) <= 15):
                continue
            out.append((kind, *m.span()))
    return out


def test_base_against_brute_force(spark, make_docs):
    r = random.Random(5)
    bits = ["a@b.com", "x_y@z-1.co.uk", "@", ".", "_", "+", "1.2.3.4", "300.1.1.1", "010.0.0.255", "4111 1111 1111 1111", "4111111111111112",
            "5500-0000-0000-0004", "+1 (736) 555-2678", "+49-30-123", " ", " ", "é", "\n", "9", "99", "-", "ß😀", "\x01", "$0", "\\1", "text",
            "DE89 3704 0044 0532 0130 00"]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(1, 25))) for _ in range(400)]
    texts += [None, "", "a@b.com_x@y.org", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "0" * 13, "4" * 30_000 + "@" + "b" * 30_000, "1 " * 20_000, "a." * 30_000 + "@", "+1" * 10_000,
              "😀 mail: a@b.com " * 500]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "a@b.com")]
    got = pd.personal_data(make_docs(rows)).collect()
    assert len(got) == len(rows)
    for x in got:
        text = "a@b.com" if x.doc_id is None else texts[x.doc_id]
        assert [(s.kind, s.start, s.end) for s in x.spans if s.base] == brute(text), repr(text)[:80]


def test_checksums_and_context(spark, make_docs):
    texts = ["bank DE89 3704 0044 0532 0130 00.", "bank DE88 3704 0044 0532 0130 00.", "GB82WEST12345698765432", "number 123-45-6789", "ssn 123-45-6789",
             "pay by card 4111111111111111"]
    got = {x.doc_id: [(s.kind, s.score) for s in x.spans] for x in pd.personal_data(make_docs(list(enumerate(texts)))).collect()}
    assert got[0] == [("iban", 0.9)] and got[1] == [] and got[2] == [("iban", 0.6)]
    assert got[3] == [] and got[4] == [("ssn", 0.6)] and got[5] == [("card", 1.0)]


def test_empty_table(spark, make_docs):
    assert pd.personal_data(make_docs([])).count() == 0
