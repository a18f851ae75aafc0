import hashlib
import random
import re

from spendguard.llm import pii
from tests.llm.helpers import docs

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_against_the_patterns():
    rng = random.Random(11)
    bits = ["@", ".", "-", " ", "+", "1", "25", "255", "256", "4539578763621486", "a", "b.c", "é", "(017) 555-7713", "0", "%", "\n", "٣"]
    bits += ["4539 5787 6362 1486", "x@y.zz", "1.2.3.4", "://", "token = ", "😀", "999"]
    for _ in range(6000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 14)))
        assert [s for s in pii.find(text) if s[0] in pii.BASE_KINDS] == plain(text), text


def test_spans_the_method_adds():
    text = 'a token = "f3ef4d6b2755" b ssh://bob:x1@host.org/ GB82 WEST 1234 5698 7654 32. passport: nothing'
    found = {(k, text[a:b]) for k, a, b in pii.find(text)}
    assert ("account", "f3ef4d6b2755") in found and ("account", "bob:x1") in found
    assert ("iban", "GB82 WEST 1234 5698 7654 32") in found
    assert not any("nothing" in s for _, s in found)


def test_documents_and_redaction(spark):
    rows = [(1, "x a@b.cc, 1.2.3.4 y"), (2, None), (3, ""), (4, "é" * 5000 + "+1 (017) 555-7713"), (4, "clean"), (None, "a@b.cc")]
    df = docs(spark, rows)
    got = {(r.doc_id, r.n_email + r.n_phone): r for r in pii.scan_pii(df).collect()}
    assert len(got) == len(rows)
    assert got[1, 1].spans == "email:2:8,ip:10:17"
    assert got[1, 1].base_sha256 == hashlib.sha256(b"email:2:8,ip:10:17").hexdigest()
    assert got[4, 1].spans == "phone:5000:5017" and got[2, 0].base_sha256 == hashlib.sha256(b"").hexdigest()
    clean = pii.redact_pii(df)
    assert clean.columns == df.columns and clean.dtypes == df.dtypes
    by = {(r.doc_id, r.text): r.n_chars for r in clean.collect()}
    assert by == {(1, "x [EMAIL], [IP] y"): 17, (2, None): None, (3, ""): 0, (4, "é" * 5000 + "[PHONE]"): 5007, (4, "clean"): 5, (None, "[EMAIL]"): 7}
    assert pii.scan_pii(df.limit(0)).count() == pii.redact_pii(df.limit(0)).count() == 0


def test_overlapping_spans_are_one():
    assert pii.masked("abcdefgh", [("email", 1, 4), ("ip", 2, 6), ("card", 6, 7)]) == "a[EMAIL][CARD]h"
