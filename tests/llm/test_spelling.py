"""Spelling variants against brute force; the filters on their own."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerlark.llm import bloom, queries, spelling

from odd_cases import none, odd, texts  # noqa: F401

SF001 = "/root/testdata/sf0.001"


def plain_words(rows, modulus=97):
    """Every occurrence on its own, as the contract reads."""
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % modulus == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    s, t = sorted((a, b), key=len)
    return any(t[:i] + t[i + 1:] == s for i in range(len(t)))


def plain_groups(words):
    of = {}
    for w, n in words.items():
        close = [x for x in words if near(w, x)]
        best = min(close, key=lambda x: (-words[x], x), default=None)
        of[w] = (best if best is not None and words[best] >= 2 * n else None, len(close))
    out = []
    for w, n in words.items():
        root = w
        while of[root][0]:
            root = of[root][0]
        form = of[w][0]
        out.append((w, form, root, n, of[w][1], words[form] if form else None))
    return sorted(out)


def rows(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()))


def random_words(seed, n=400, letters="abcé"):
    rnd = random.Random(seed)
    out = {}
    while len(out) < n:
        w = "".join(rnd.choice(letters) for _ in range(rnd.randint(5, 8)))
        out[w] = rnd.choice([3, 3, 4, 6, 8, 12, 24, 50, 100, 1000])
    return out


def test_edit_hashes():
    for w in ("a", "aab", "zoé", "abcabc", "ÿ" * 30):
        m = bloom.letters_of([w, w[::-1]])
        key, first = bloom.deletions(m)
        for i in range(len(w)):
            cut = w[:i] + w[i + 1:]
            assert key[0, i] == bloom.keys(bloom.letters_of([cut]))[0] if cut else True
            assert first[0, i] == (i == 0 or w[i] != w[i - 1])
        for c in "aé":
            key, smaller = bloom.replacements(m, ord(c))
            for i in range(len(w)):
                assert key[0, i] == bloom.keys(bloom.letters_of([w[:i] + c + w[i + 1:]]))[0]
                assert smaller[0, i] == (w[i] < c)


@pytest.mark.parametrize("room", [64 << 20, 4096, 32])
def test_filters_hold_all_words_and_few_others(room):
    words = [w for w in random_words(3, 3000) if len(w) == 7]
    key = bloom.keys(bloom.letters_of(words))
    other = bloom.keys(bloom.letters_of([w[::-1] + "x" for w in words]))
    held = strange = 0
    rounds = bloom.plan({7: len(words)}, room)
    for r in rounds:
        assert r.total * bloom.BLOCK_BYTES <= room
        filters = np.zeros((r.total, bloom.LANES), np.uint32)
        block = r.place(7, key)
        np.bitwise_or.at(filters, block[block >= 0], bloom.lanes(key[block >= 0]))
        held += len(bloom.probe(filters, block, key))
        strange += len(bloom.probe(filters, r.place(7, other), other))
    assert held == len(words) and strange < 0.02 * len(words)
    assert len(rounds) > 1 if room < 4096 else True


@pytest.mark.parametrize("room", [64 << 20, 256])
def test_groups_against_brute_force(spark, room):
    words = random_words(room)
    counted = spark.createDataFrame([(w, n, "x", 1, "r") for w, n in words.items()], "word string, n long, other string, size int, root string")
    want = plain_groups(words)
    assert rows(spelling.group(counted.repartition(5), max_bytes=room)) == want
    assert sum(r[1] is not None for r in want) > 50 and any(r[2] != (r[1] or r[0]) for r in want)


def test_long_chain_of_forms(spark):
    """Each word is a near word of the next, of twice its count."""
    words = {"a" * (5 + i): 3 << i for i in range(40)}
    counted = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r[0]: r for r in rows(spelling.group(counted))}
    assert {r[2] for r in got.values()} == {"a" * 44} and got["aaaaa"][1] == "aaaaaa"


def test_very_long_words(spark):
    word = "".join(random.Random(5).choice("abcdef") for _ in range(30_000))
    words = {word: 3, word[:777] + word[778:]: 9, word[:5] + "z" + word[6:]: 30, word[:15_000]: 4}
    assert rows(spelling.group(spark.createDataFrame(list(words.items()), "word string, n long"))) == plain_groups(words)


def test_words_of_documents(spark, odd, none, texts, monkeypatch):
    monkeypatch.setattr(spelling, "FLUSH", 7)
    want = plain_words(texts)
    assert {r.word: r.n for r in spelling.count_words(odd).collect()} == want and want
    assert {r.word: r.n for r in spelling.count_words(odd, modulus=2).collect()} == plain_words(texts, 2)
    assert rows(spelling.group(spelling.count_words(odd))) == plain_groups(want)
    assert spelling.count_words(none).count() == 0 and rows(spelling.group(spelling.count_words(none))) == []


def test_odd_vocabulary(spark):
    counted = spark.createDataFrame([("abcde", 2), ("abcde", 1), (None, 4), ("abcdf", None), ("abcdx", 6), ("", 5), ("b", 9)], "word string, n long")
    got = rows(spelling.group(counted))
    assert got == [("", None, "", 5, 1, None), ("abcde", "abcdx", "abcdx", 3, 1, 6),
                   ("abcdx", None, "abcdx", 6, 1, None), ("b", None, "b", 9, 1, None)]


def test_query(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    assert rows(queries.op13_spelling(spark, SF001)) == plain_groups(plain_words([tuple(r) for r in docs]))
