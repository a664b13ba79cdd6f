"""Each stage of the pipeline on what the stage before kept, against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from ledgerlark.llm import quality
from odd_cases import none, odd, texts  # noqa: F401
from test_texts import brute_groups, brute_print, brute_secrets, tiktoken_encoding

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, odd, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    odd.select(*COLUMNS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 > 0), int(i % 9 == 0)) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages(spark, folder):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "simhash", "secrets", "mix", "tokens"]
    frames = [spark.read.parquet(f"{folder}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{folder}/out{k}"
        stage(spark, frames[-1], folder).write.parquet(path)
        frames.append(spark.read.parquet(path))
        assert k == 4 or frames[-1].columns == COLUMNS
    rows = [[(r.doc_id, r.text) for r in f.collect()] for f in frames[:5]]
    # quality
    model = quality.fit(frames[0], spark.read.parquet(f"{folder}/labels.parquet"))
    assert len(rows[1]) == quality.classify(frames[0], model).filter("selected").count() < len(rows[0])
    assert not Counter(rows[1]) - Counter(rows[0])
    # near-duplicates: one of each group, the smallest ID
    root = brute_groups([brute_print(t) for _, t in rows[1]], 2)
    assert sorted(root[brute_print(t)] for _, t in rows[2]) == sorted({*root.values()})
    for i, t in rows[2]:
        assert i == min((j for j, u in rows[1] if j is not None and root[brute_print(u)] == root[brute_print(t)]), default=None)
    # secrets: nothing left to find, nothing else changed
    assert len(rows[3]) == len(rows[2]) and all(not brute_secrets(t) for _, t in rows[3])
    clean = [(i, t) for i, t in rows[2] if not brute_secrets(t)]
    assert not Counter(clean) - Counter(rows[3])
    # mix: a part, each at most once
    assert 0 < len(rows[4]) <= len(rows[3]) and not Counter(rows[4]) - Counter(rows[3])
    # tokens
    e = tiktoken_encoding()
    want = Counter()
    for i, t in rows[4]:
        ids = e.encode_ordinary(t or "")
        want[(i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in frames[5].collect()) == want
    assert Counter(tuple(r) for r in corpus_pipeline.run(spark, folder).collect()) == want


def test_no_documents(spark, folder, tmp_path):
    d = str(tmp_path)
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{d}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{d}/labels.parquet")
    assert corpus_pipeline.run(spark, d).count() == 0
