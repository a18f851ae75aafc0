import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spendguard.llm import spelling
from tests.llm.helpers import docs


def near(a, b):
    """One edit apart, by trying all of them."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    """The whole contract in plain loops."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 6 and k >= 5}
    around = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(around[w]), n[form[w]] if form[w] else None)
    return out


def found(df):
    rows = df.collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


def corpus():
    rng = random.Random(13)
    letters = "abcdeé×ÿ"
    stems = ["".join(rng.choices(letters, k=rng.randint(5, 11))) for _ in range(40)]
    words = list(stems)
    for _ in range(500):
        w = rng.choice(words[-60:])
        at = rng.randrange(len(w))
        c = rng.choice(letters)
        words.append(rng.choice([w[:at] + c + w[at:], w[:at] + w[at + 1 :], w[:at] + c + w[at + 1 :], w + c]))
    weights = [rng.choice([1, 2, 12, 70]) for _ in words]
    rows = []
    for i in range(300):
        text = " ".join(rng.choices(words, weights, k=120))
        rows.append((i, text.upper().replace("É", "é") if i % 7 == 0 else text))
    rows += [(1, rows[1][1]), (1, rows[1][1]), (None, rows[2][1]), (900, None), (901, ""), (902, "Straße_straße9straße straßẞe ŐőŐ")]
    rows.append((903, ("abcabcabc " * 30_000) + "x" * 50_000))
    rows += [(910 + i, "aaaaaaa aaaaaaaa aaaaaab baaaaaa " * (i + 1)) for i in range(5)]
    return rows


@pytest.mark.parametrize("crowd", [512, 3])
def test_whole_operator(spark, crowd):
    rows = corpus()
    expected = plain(rows)
    assert found(spelling.variants(docs(spark, rows), crowd=crowd)) == expected
    assert sum(v[0] is not None for v in expected.values()) > 50
    assert any(v[0] and v[1] != v[0] for v in expected.values())


def test_nothing(spark):
    assert found(spelling.variants(docs(spark, [(1, "a")]).limit(0))) == {}
    assert found(spelling.variants(docs(spark, [(1, None), (2, "short words only"), (None, "")]))) == {}


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("abc", max_size=7), max_size=25))
def test_list_scan(words):
    words = sorted(words)
    pairs = [(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if near(words[i], words[j])]
    assert sorted(spelling.near_in_list(words)) == pairs


def test_one_list_is_split_until_it_is_small(spark):
    rng = random.Random(7)
    words = {"prefix" + "".join(rng.choices("abcd", k=6)) + "suffix" for _ in range(900)}
    table = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    held = spelling.lists(table, 20).groupBy(*spelling.KEY).count().collect()
    assert all(r["count"] <= 20 or r.hi - r.lo == 1 for r in held)
    links = [(r.word, r.near) for r in spelling.near_words(table, 20).collect()]
    assert len(links) == len(set(links))
    assert set(links) == {(a, b) for a in words for b in words if near(a, b)}


def test_long_chains_of_forms(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(27)] + [("a", "w3"), ("b", "c")]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {**{f"w{i}": "w27" for i in range(27)}, "a": "w27", "b": "c"}
