import random

import pytest

# clashing names: columns that operators use inside or return
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, fp long, tokens string, spans string, "
        "grade int, epoch int, component string, kept string, __key string")


def odd_rows(seed=1, n=60):
    """Documents with nulls, empty and very long texts, copies, near copies, shared passages, secrets, ties, repeated rows."""
    rnd = random.Random(seed)
    words = ["ka", "lo", "Mira", "tesu", "vo", "né", "漢字", "the", "of", "pa1", "x-9", "dor!"]
    line = lambda k: " ".join(rnd.choice(words) for _ in range(k))
    passage = line(40)
    texts = [None, "", " \n\t ", "a", line(2), line(3000), "z" * 4000, "ab " * 1500, passage, passage + " tail",
             "password = hunter2hunter2 and token:abc", 'api_key: "ABCDEFGH12345678" AKIA' + "Q" * 16, "0123456789abcdef" * 3,
             "ſecret=longlonglong token=secret=abcdefgh12", "-----BEGIN RSA PRIVATE KEY-----", "x\u0085y  z  \x1c q"]
    while len(texts) < n:
        k = rnd.random()
        texts.append(line(rnd.randrange(1, 80)) if k < 0.5 else rnd.choice(texts) if k < 0.65 else
                     line(5) + " " + passage + " " + line(rnd.randrange(9)) if k < 0.8 else (rnd.choice(texts) or "") + " " + line(1))
    rows = [(i, t, rnd.choice(["en", "de", None]), rnd.choice(["src1", "src2", "src7", None, "other"]), None if i % 7 == 0 else len(t or ""))
            for i, t in enumerate(texts)]
    rows += [rows[8], rows[20], (None, passage, "en", "src1", 3), (None, "only here and nowhere else", None, None, None), (20, "same id, other text", "en", "src2", 1)]
    rnd.shuffle(rows)
    return [(*r, 1, "t", "s", 2, 3, "c", "k", "y") for r in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(5)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def texts():
    return [(r[0], r[1]) for r in odd_rows()]
