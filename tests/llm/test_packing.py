import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from spendguard.llm import packing, tokens
from spendguard.runtime import checkpointed
from tests.llm.helpers import docs

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_ids_are_those_of_tokenizers():
    slow, fast = Tokenizer.from_file(PATH), tokens.load(PATH)
    assert fast.fast is not None
    rng = random.Random(1)
    bits = ["a", " ", "  ", "\n", "\t", "é", "12", "'s", "'LL", "\u00a0", "\u3000", "😀", "x" * 30, "<|endoftext|>", "\r\n", "\x1c", "\x85", "ß", "٣", "_", "$", "\u200b", "İ", "the"]
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 12)))
        assert fast(text).tolist() == slow.encode(text, add_special_tokens=False).ids, repr(text)


def test_other_vocabularies_go_through_tokenizers():
    other = public_tokenizers.path("word_bpe_49k.json")
    text = "Some words, in Lower and upper case."
    assert tokens.load(other)(text).tolist() == Tokenizer.from_file(other).encode(text, add_special_tokens=False).ids


def check(rows, got, length=1024):
    slow = Tokenizer.from_file(PATH)
    ids = {i: slow.encode(t or "", add_special_tokens=False).ids + [2] for i, t in rows}
    seen, room = {}, {}
    for r in got:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(part) == r.length <= length and zlib.crc32(part.tobytes()) == r.ids_crc32
        seen.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
        room.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert seen.keys() == ids.keys()
    for i, parts in seen.items():
        parts.sort()
        assert [p[0] for p in parts] == list(range(-(-len(ids[i]) // length)))
        assert [p[1] for p in parts] == np.cumsum([0, *(p[2] for p in parts)])[:-1].tolist()
        assert sum(p[2] for p in parts) == len(ids[i]) and all(p[2] == length for p in parts[1:])
    for parts in room.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end <= length
    return len(room), sum(map(len, ids.values())) / length


def test_documents(spark):
    rng = random.Random(2)
    rows = [(i, "the cat sat " * rng.randint(0, 500)) for i in range(300)] + [(900, None), (901, ""), (902, "word " * 1023), (903, "a b " * 9000)]
    used, least = check(rows, packing.pack_documents(docs(spark, rows), PATH).collect())
    assert used <= 1.03 * least + 1
    assert packing.pack_documents(docs(spark, rows).limit(0), PATH).count() == 0
    twice = packing.pack_documents(docs(spark, [(1, "a"), (1, "a"), (None, "b")]), PATH).collect()
    assert sorted((r.doc_id or 0, r.offset) for r in twice)[0][0] == 0 and {r.offset for r in twice} == {0, 2, 4}


@pytest.mark.parametrize("per_task", [20, 100, 10_000])
@pytest.mark.parametrize("sizes", ["even", "six tenths", "one"])
def test_rounds_of_small_tasks(spark, per_task, sizes):
    rng = random.Random(5)
    size = {"even": lambda: rng.randint(1, 99), "six tenths": lambda: 60, "one": lambda: 100}[sizes]
    items = checkpointed(spark.createDataFrame([(i, size()) for i in range(500)], "item long, size long"))
    got = {r.item: r for r in packing.pack_items(items, 100, 2, per_task).collect()}
    assert len(got) == 500
    bins = {}
    for i, s in items.collect():
        bins.setdefault(got[i].bin, []).append((got[i].offset, s))
    for parts in bins.values():
        end = 0
        for offset, s in sorted(parts):
            assert offset == end
            end += s
        assert end <= 100
    total = sum(s for _, s in items.collect())
    assert len(bins) <= (500 if sizes != "even" else total / 100 * (1.2 if per_task == 20 else 1.05) + 1)


def test_best_fit_chooses_the_least_room():
    bin_of, offset, fill = packing.best_fit(np.array([6, 7, 3, 4]), 10)
    assert bin_of.tolist() == [1, 0, 0, 1] and offset.tolist() == [0, 0, 7, 6] and fill.tolist() == [10, 10]
