import random
import re

from spendguard.llm import licenses
from tests.llm.helpers import docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places, base, labels, score = [], set(), set(), 0.0
    for tid, (phrase, label) in enumerate([*licenses.BASE, *licenses.NOTICES]):
        t = phrase.split(" ")
        votes = {}
        for p in range(len(words) - 1):
            for q in range(len(t) - 1):
                if words[p : p + 2] == t[q : q + 2]:
                    votes.setdefault(p - q, set()).update((q, q + 1))
        for d, seen in votes.items():
            if tid < len(licenses.BASE):
                if len(seen) == len(t):
                    places.append(d)
                    base.add(label)
                    score = 1.0
                continue
            merged = set().union(*(votes.get(d + k, ()) for k in range(-licenses.REACH, licenses.REACH + 1)))
            if len(merged) / len(t) >= licenses.COVERAGE:
                labels.add(label)
                score = max(score, len(merged) / len(t))
    first, last = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(base | labels)), score


def test_against_plain_code(spark):
    rng = random.Random(8)
    pool = "all rights reserved cc by general public license mit released under the x y Ä 4 0 nc licensed".split()
    rows = [(i, " ".join(rng.choices(pool, k=rng.randint(0, 60)))) for i in range(300)]
    rows += [
        (1000, None), (1001, ""), (1002, "..."), (1003, "ALL-RIGHTS reserved!"), (1004, "all rights\x00reserved all rights reserved"),
        (1005, "Licensed under the Apache License, Version 2.0."), (1006, "Licensed under the great Apache License Version 2.0"),
        (1007, "Licensed under CC BY-NC 4.0."), (1008, "word " * 3000 + "cc by"), (1009, "cc"), (1010, "all rights reservedä"),
    ]
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan_licenses(docs(spark, rows)).collect()}
    assert got == {i: plain(t) for i, t in rows}
    assert got[1006][5] == "apache-2.0" and got[1006][6] == 1.0


def test_repeated_rows_and_ids_stay_apart(spark):
    rows = [(1, "all rights reserved"), (1, "all rights reserved"), (1, "cc by"), (None, "cc by"), (None, "")]
    got = licenses.scan_licenses(docs(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.n_base, r.base_labels) for r in got) == [
        (0, 0, ""), (0, 1, "cc-by"), (1, 1, "cc-by"), (1, 1, "reserved"), (1, 1, "reserved")]
    assert licenses.scan_licenses(docs(spark, rows).limit(0)).count() == 0
