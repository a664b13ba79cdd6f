"""Language identification: held-out accuracy, a pure-Python scorer, gradients, odd inputs."""

import zlib

import numpy as np
import pytest

from ledgerlark.llm import langid, queries
from ledgerlark.llm.common import ship

from odd_cases import none, odd  # noqa: F401

SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def letter():
    return langid.letters()


@pytest.fixture(scope="module")
def model(spark):
    ship(spark)
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    return langid.fit(docs.filter(~langid.held_out()))


def plain_buckets(text):
    """Every gram by the definition: letter runs between boundary marks."""
    marked = [ord(c) if c.isalpha() else 0 for c in "\n" + text.lower() + "\n"]
    out = []
    for n in langid.ORDERS:
        for a in range(len(marked) - n + 1):
            gram = marked[a:a + n]
            if not all(gram[1:-1]) or not any(gram):
                continue
            h = gram[0] * 0x9E3779B1 % 2**32
            for c in gram[1:]:
                h = ((h ^ h >> 15) * 0x9E3779B1 + c) % 2**32
            out.append((h * 0x9E3779B1 % 2**32) >> 16)
    return out


TEXTS = ["", None, "a", " ", "12 34!", "Übung macht", "x\ny\r\nzed  İstanbul", "漢字 kanji", "one" * 400, "ab cd " * 300, "é", "don't-stop"]


@pytest.mark.parametrize("size", [1 << 19, 64, 7])
def test_scores_against_plain_python(model, letter, size, monkeypatch):
    monkeypatch.setattr(langid, "SLICE", size)
    table = model.table()
    got, found = langid.score_texts(TEXTS, table, model.bias, letter)
    for i, text in enumerate(TEXTS):
        b = plain_buckets(text or "")
        want = model.bias + (sum(table[:, x] for x in b) / len(b) if b else 0)
        assert np.allclose(got[i], want, rtol=1e-9, atol=1e-12), text
        assert found[i] == any(c.isalpha() for c in text or "")
        at, share = langid.bag(text or "", letter)
        assert sorted({*b}) == at.tolist() and np.isclose(share.sum(), 1 if b else 0)
        assert np.allclose(model.logits([(at, share)])[0], want, rtol=1e-5, atol=1e-6)


def test_held_out(spark, model):
    rows = {r.doc_id: r for r in queries.op11_language(spark, SF01).collect()}
    docs = spark.read.parquet(f"{SF01}/documents.parquet").collect()
    assert len(rows) == len(docs)
    right = []
    for d in docs:
        r = rows[d.doc_id]
        assert r.held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        if r.held_out:
            right.append((r.lang_pred == d.lang, r.score, r.accepted))
    assert np.mean([x[0] for x in right]) > 0.98 and len(right) > 200
    assert np.mean([x[0] for x in right if x[2]]) >= 0.99 and np.mean([x[2] for x in right]) > 0.95
    assert abs(np.mean([x[0] for x in right]) - np.mean([x[1] for x in right])) < 0.06  # calibrated
    assert 0.05 <= model.temperature <= 20


def test_only_the_text_is_read_and_held_out_rows_teach_nothing(spark, model):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    other = docs.selectExpr("doc_id", "text", "if(crc32(cast(doc_id as string)) % 4 = 2, 'zz', lang) as lang", "'q' as source")
    again = langid.fit(other.filter(~langid.held_out()).repartition(7))
    assert again.langs == model.langs and (again.embeddings == model.embeddings).all() and (again.weights == model.weights).all()
    swapped = docs.selectExpr("doc_id + 1000000 as doc_id", "text", "'xx' as lang")
    a = sorted((r.doc_id, r.lang_pred, r.score) for r in langid.predict(docs, model).collect())
    b = sorted((r.doc_id - 1000000, r.lang_pred, r.score) for r in langid.predict(swapped.repartition(5), model).collect())
    assert a == b


def test_rejects_what_it_cannot_tell(spark, model):
    """A mix of two languages' words is less certain than either."""
    en, de = "the of and the thing ation", "und der die schen keit ung"
    rows = langid.predict(spark.createDataFrame([(1, en), (2, de), (3, en + " " + de)], "doc_id long, text string"), model).collect()
    by = {r.doc_id: r for r in rows}
    assert by[1].lang_pred == "en" and by[2].lang_pred == "de" and by[3].score < min(by[1].score, by[2].score)


def test_softmax_steps_go_downhill(letter):
    """Two made-up languages of disjoint letters are told apart after training."""
    rnd = np.random.default_rng(1)
    texts, of = [], []
    for i in range(80):
        texts.append(" ".join("".join(rnd.choice(list("abcd" if i % 2 else "wxyz"), 4)) for _ in range(6)))
        of.append(i % 2)
    bags = [langid.bag(t, letter) for t in texts]
    m = langid.LanguageModel.fit(bags, np.array(of), ["p", "q"], np.arange(80))
    assert (m.logits(bags).argmax(axis=1) == of).all()
    loss = [-np.log(langid.softmax(langid.LanguageModel.fit(bags, np.array(of), ["p", "q"], np.arange(80), epochs=e).logits(bags))[np.arange(80), of]).mean()
            for e in (1, 6)]
    assert loss[1] < loss[0]


def test_odd_rows(spark, odd, none):
    ship(spark)
    known = odd.filter("doc_id is not null and lang is not null")
    m = langid.fit(odd, max_rows=30)
    assert m.langs == ["de", "en"] and langid.sample(odd, 30, 200, 11).count() <= 30
    assert langid.sample(odd, 30, 1, 11).select("lang").distinct().count() == 1
    assert langid.sample(odd, 10**6, 200, 11).count() == known.select("doc_id").distinct().count()
    rows = langid.predict(odd, m).collect()
    texts = {r.doc_id: r.text for r in odd.filter("doc_id <> 20 and doc_id is not null").collect()}
    assert len(rows) == odd.count()
    for r in rows:
        if r.doc_id in texts:
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id] or ""))
            assert (r.score == 0 and not r.accepted) if r.lang_pred == "und" else 0 < r.score <= 1
    assert langid.predict(none, m).count() == 0
    assert langid.fit(none) is None and langid.fit(odd.selectExpr("doc_id", "text", "cast(null as string) as lang")) is None
    assert langid.predict(odd, None).filter("lang_pred = 'und' and score = 0").count() == odd.count()
    one = langid.predict(odd, langid.fit(odd.filter("lang = 'de'"))).collect()
    assert {r.score for r in one if r.lang_pred != "und"} == {1.0}


def test_very_long_text(spark, model):
    text = "the thing and of " * 200_000  # 3.4 million code points, several slices
    rows = langid.predict(spark.createDataFrame([(1, text), (2, text[:17 * 100])], "doc_id long, text string"), model).collect()
    assert {r.lang_pred for r in rows} == {"en"} and abs(rows[0].score - rows[1].score) < 0.01
