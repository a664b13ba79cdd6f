"""Operators on texts against brute force, on rows with every odd case and on an empty table."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import xxhash

from ledgerlark.llm import bpe, lengths, mixing, secrets, simhash, suffixes, tokenfiles, trigrams
from ledgerlark.llm.queries import byte_ranks, tokenizer_path
from odd_cases import none, odd, texts  # noqa: F401


def got(df):
    return Counter(tuple(r) for r in df.collect())


def brute_secrets(text):
    text, out = text or "", []
    for k, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, text):
            if len(m[rule.group]) >= rule.least:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def line_of(spans):
    return ",".join(f"{secrets.RULES[k].kind}:{a}:{z}" for a, k, z in spans)


def test_secrets(odd, none, texts):
    want = Counter()
    for i, t in texts:
        s = brute_secrets(t)
        base = [x for x in s if x[1] < 3]
        want[(i, *(sum(x[1] == k for x in s) for k in range(3)), hashlib.sha256(line_of(base).encode()).hexdigest(), line_of(s))] += 1
    assert got(secrets.report(odd)) == want
    assert sum(n for k, n in want.items() if k[-1]) >= 5
    assert secrets.report(none).count() == 0


def test_secrets_masked(odd, texts):
    want = Counter()
    for i, t in texts:
        out, at = "", 0
        for a, _, z in brute_secrets(t):
            if a >= at:
                out += t[at:a] + "[secret]"
            at = max(at, z)
        want[(i, None if t is None else out + t[at:])] += 1
    masked = secrets.redact(odd)
    assert masked.columns == odd.columns
    assert got(masked.select("doc_id", "text")) == want


@pytest.mark.parametrize("pattern", ["(password|passwd)=x", "a[bc]?d{2}e+f", "(ab|cd)*xyz", "x?y?", "abc|[0-9]+", "(foo|bar)(baz)?qux", "k[a-z]{3}m_{2,3}end"])
def test_trigram_queries_hold_for_matches(pattern):
    import random
    rnd = random.Random(5)
    rx, q = re.compile(pattern), trigrams.query(pattern)
    hits = 0
    pool = ["password=x", "passwd=x", "abddeef", "acddef", "ababxyz", "xyz", "abc", "7", "foobazqux", "barqux", "kabcm__end", "kabcm___end"]
    for _ in range(3000):
        s = "".join(rnd.choice([*pool, "a", "b", "x", "_", "="]) for _ in range(rnd.randrange(1, 4)))
        if rx.search(s):
            hits += 1
            assert any(all(g in s.lower() for g in alternative) for alternative in q)
    assert hits > 50


def brute_print(text, shingle=3):
    words = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + shingle]), seed=42) for i in range(max(1, len(words) - shingle + 1))]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_groups(prints, radius):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in root:
        for b in root:
            if a < b and (a ^ b).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {p: find(p) for p in root}


@pytest.mark.parametrize("radius", [1, 2, 4])
def test_simhash(odd, none, texts, radius):
    prints = [(i, brute_print(t)) for i, t in texts]
    roots = brute_groups([p for _, p in prints], radius)
    low = {}
    for i, p in prints:
        if i is not None:
            low[roots[p]] = min(low.get(roots[p], i), i)
    want = Counter((i, f"{p:016x}", low.get(roots[p])) for i, p in prints)
    found = simhash.near_duplicates(odd, 3, radius)
    assert got(found.select("doc_id", simhash.hex_digits(found["fp"]), "component_id")) == want
    assert simhash.near_duplicates(none, 3, radius).count() == 0


def test_simhash_links_by_bits(spark):
    """Fingerprints a few bits apart, the sign bit among them."""
    import random
    rnd = random.Random(2)
    base = [rnd.getrandbits(64) for _ in range(40)]
    prints = {b ^ sum(1 << k for k in rnd.sample([0, 5, 17, 40, 62, 63], rnd.randrange(4))) for b in base for _ in range(6)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    pairs = {frozenset(((r.u % (1 << 64)), (r.v % (1 << 64)))) for r in simhash.links(spark.createDataFrame(signed, "fp long"), 2).collect()}
    root = brute_groups(prints, 2)
    assert all(root[min(p)] == root[max(p)] and (min(p) ^ max(p)).bit_count() <= 2 for p in pairs)
    joined = {p: p for p in prints}
    for _ in range(8):
        for a, b in map(tuple, pairs):
            joined[a] = joined[b] = min(joined[a], joined[b])
    assert len({*joined.values()}) == len({*root.values()})


def test_simhash_keeps_one_of_each_group(odd, none, texts):
    left = simhash.deduplicate(odd)
    assert left.columns == odd.columns
    roots = brute_groups([brute_print(t) for _, t in texts], 2)
    kept = left.select("doc_id", "text").collect()
    assert sorted(roots[brute_print(r.text)] for r in kept) == sorted({*roots.values()})
    for r in kept:
        same = [i for i, t in texts if roots[brute_print(t)] == roots[brute_print(r.text)]]
        assert r.doc_id == min((i for i in same if i is not None), default=None)
    assert simhash.deduplicate(none).count() == 0


def brute_removed(texts, least):
    late = float("inf")
    first = {}
    for i, t in texts:
        b = (t or "").encode()
        for p in range(len(b) - least + 1):
            w = b[p:p + least]
            first[w] = min(first.get(w, late), late if i is None else i)
    for i, t in texts:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - least + 1):
            if first[b[p:p + least]] < (late if i is None else i):
                gone[p:p + least] = b"\1" * least
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        yield i, len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()


@pytest.mark.parametrize("least", [50, 24])
def test_repeated_passages(odd, none, texts, least):
    want = Counter(brute_removed(texts, least))
    assert got(suffixes.digests(suffixes.remove(odd, least))) == want
    assert sum(n for k, n in want.items() if k[2]) > 10
    assert suffixes.remove(none, least).count() == 0


def test_no_minimizer_brings_a_shard_many_strings(spark):
    """A passage in most documents: the strings at its edges differ in every one of them."""
    import random
    rnd = random.Random(3)
    line = lambda k: "".join(rnd.choice("abcdefgh ") for _ in range(k))
    passage, least, hot = line(150), 50, 20
    texts = [(i // 2 if i < 20 else None if i % 17 == 0 else i, line(90) + passage[:rnd.choice([150, 120])] + line(90)) for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    batches = suffixes.packed(docs)

    def most(limit):
        hits = suffixes.shared_minimizers(batches, least, 8, limit)
        sent = suffixes.candidates(batches, hits, least, 8).filter("kind = 1").collect()
        return max(Counter(m for r in sent for m in suffixes.Strings.unpack(bytes(r.blob), 0, suffixes.padded(least)).minimizer.tolist()).values())

    assert most(1 << 14) > 100  # at the edges
    assert most(hot) <= hot
    want = Counter(brute_removed(texts, least))
    assert sum(n for k, n in want.items() if k[2]) > 250
    for limit in (suffixes.HOT, hot, 0):
        assert got(suffixes.digests(suffixes.remove(docs, least, limit))) == want


def test_a_shard_is_sorted_in_bounded_parts(monkeypatch):
    """Sorts of about SORT bytes whatever the shard holds, one minimizer's strings always in one of them."""
    rnd, least, n = np.random.default_rng(5), 50, 600
    grid = np.zeros((n, suffixes.padded(least)), np.uint8)
    size = rnd.integers(50, 84, n)
    base = rnd.integers(97, 123, (60, grid.shape[1]), dtype=np.uint8)
    owner = rnd.integers(0, 60, n)
    for i in range(n):
        grid[i, :size[i]] = base[owner[i], :size[i]]
        grid[i, rnd.integers(0, size[i])] = 65 + i % 26
    own = suffixes.Strings(owner.astype(np.uint64), rnd.integers(0, 300, n), np.zeros(n, np.int64), np.arange(n), np.zeros(n, np.int64), size, grid)
    sort, seen = suffixes.induced.sort, []
    monkeypatch.setattr(suffixes.induced, "sort", lambda text, depth: seen.append(len(text)) or sort(text, depth))

    def spans(most):
        monkeypatch.setattr(suffixes, "SORT", most)
        seen.clear()
        return sorted(zip(*(c.tolist() for c in suffixes.repeated(*own.folded(), least))))

    first = {}
    for i in range(n):
        for a in range(size[i] - least + 1):
            key = grid[i, a:a + least].tobytes()
            first[key] = min(first.get(key, 1 << 30), own.order[i])
    want = {(i, a + k) for i in range(n) for a in range(size[i] - least + 1)
            if own.order[i] > first[grid[i, a:a + least].tobytes()] for k in range(least)}
    for most in (1 << 30, 4000, 1):
        assert {(d, at + k) for _, d, at, long in spans(most) for k in range(long)} == want and want
    assert spans(1 << 30) == spans(4000)
    assert len(seen) > 5 and max(seen) <= 4000 + max(np.bincount(owner, size + 1))


def test_induced_sorting_against_brute_force():
    import random
    from ledgerlark.llm import induced
    rnd, mem, small = random.Random(0), induced.MEMORY, induced.IN_MEMORY
    try:
        for it in range(300):
            t = []
            for _ in range(rnd.randrange(1, 6)):
                t += [rnd.randrange(1, rnd.choice([2, 3, 4, 7])) for _ in range(rnd.randrange(0 if it % 3 == 0 else 1, 14))] + [0]
            key = lambda i: [*t[i:t.index(0, i)], 0.0 + i / 1e3]  # noqa: B023, E731
            want = sorted(range(len(t)), key=key)
            most = rnd.choice([3, 50])
            lcp = [0]
            for a, b in zip(want, want[1:]):
                k = 0
                while k < most and t[a + k] and t[a + k] == t[b + k]:
                    k += 1
                lcp.append(k)
            for induced.MEMORY, induced.IN_MEMORY in ((mem, small), (0, 1)):  # the second: all queues on disk, recursion to the end
                order, common = induced.sort(np.array(t), most)
                assert (order.tolist(), common.tolist()) == (want, lcp)
    finally:
        induced.MEMORY, induced.IN_MEMORY = mem, small


def tiktoken_encoding():
    import tiktoken
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_ranks(), special_tokens={})


def test_byte_bpe(odd, none, texts):
    e = tiktoken_encoding()
    want = Counter()
    for i, t in texts:
        ids = e.encode_ordinary(t or "")
        want[(i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert got(bpe.digests(bpe.round_trip(odd, byte_ranks(), P.PATTERN))) == want
    assert bpe.encode(none, byte_ranks(), P.PATTERN).count() == 0


def test_perfect_hash_is_minimal():
    ranks = byte_ranks()
    table = bpe.PerfectHash(ranks)
    assert len(table.keys) == len({*table.keys}) == len(ranks)
    assert all(table.get(k) == v for k, v in ranks.items())
    assert table.get(b"no token of this table") is None
    for n in (1, 2, 3, 50):
        few = {k: ranks[k] for k in sorted(ranks)[:n]}
        assert all(bpe.PerfectHash(few).get(k) == v for k, v in few.items())


def test_token_files(spark, odd, none, texts, tmp_path):
    from tokenizers import Tokenizer
    tool = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    tokenfiles.write(odd, str(tmp_path / "a"), tokenizer_path("word_bpe_49k.json"), 1, parts=3)
    rows = sorted((tuple(r) for r in tokenfiles.checksums(tokenfiles.read(spark, str(tmp_path / "a"))).collect()), key=lambda r: r[1])
    assert [r[0] is not None for r in rows] == sorted(r[0] is not None for r in rows)
    assert [r[0] for r in rows if r[0] is not None] == sorted(i for i, _ in texts if i is not None)
    assert [r[1] for r in rows] == np.cumsum([0, *(r[2] for r in rows)]).tolist()[:-1]
    want = Counter()
    for i, t in texts:
        ids = [*tool.encode(t or "", add_special_tokens=False).ids, 1]
        want[(i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    assert Counter((a, c, d) for a, _, c, d in rows) == want
    tokenfiles.write(none, str(tmp_path / "b"), tokenizer_path("word_bpe_49k.json"), 1, parts=3)
    assert tokenfiles.checksums(tokenfiles.read(spark, str(tmp_path / "b"))).count() == 0


def test_added_tokens_in_words():
    from tokenizers import Tokenizer
    tool = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    own = tokenfiles.WordEncoder(tokenizer_path("word_bpe_49k.json"))
    for t in ("a<|endoftext|>b c", "H̱ello İ K ΑΣ", "it's we'll 123 a-b", "é é  x", "", " "):
        assert np.frombuffer(own.encode(t), "<u4").tolist() == tool.encode(t, add_special_tokens=False).ids


def test_words_of_letters_need_no_split():
    from tokenizers import Tokenizer
    tool = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    own = tokenfiles.WordEncoder(tokenizer_path("word_bpe_49k.json"))
    letters = "".join(c for c in map(chr, range(0x300)) if c.isalpha() and c.lower().isalpha())
    own.cut = lambda word: pytest.fail(f"split {word!r}")
    for t in ("Plain words OF letters", *(letters[i:i + 7] for i in range(0, len(letters), 7))):
        assert np.frombuffer(own.encode(t), "<u4").tolist() == tool.encode(t, add_special_tokens=False).ids


def test_new_words_of_a_slice_go_to_the_model_in_one_call():
    from tokenizers import Tokenizer
    tool = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    own = tokenfiles.WordEncoder(tokenizer_path("word_bpe_49k.json"))
    texts = [" ".join(f"{a}{b}{c}'s, Ünï{c}{a}{b}!" for c in "aeiou") for a in "bdfgk" for b in "lmnpr"]
    want = [tool.encode(t, add_special_tokens=False).ids for t in texts]
    calls, bulk = [], getattr(own, "bulk", None)

    class Counted:
        def encode_batch_fast(self, lines, **kw):
            calls.append(len(lines))
            return bulk.encode_batch_fast(lines, **kw)

    own.tool, own.bulk = None, Counted()  # no call piece by piece
    assert [np.frombuffer(own.encode(t), "<u4").tolist() for t in texts[:1]] == want[:1] and calls == [1]
    for _ in range(2):  # the second time all are known
        assert [np.frombuffer(ids, "<u4").tolist() for ids in own.encode_all(texts)] == want and calls == [1, 1]


def test_texts_of_odd_characters_against_the_library(monkeypatch):
    import random

    from tokenizers import Tokenizer
    tool = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    own = tokenfiles.WordEncoder(tokenizer_path("word_bpe_49k.json"))
    ids = lambda t: tool.encode(t or "", add_special_tokens=False).ids
    rnd = random.Random(5)
    low = [chr(c) for c in range(0x300)]
    texts = [f"{c}a{c}'{c}s{c}1{c}{c}" for c in low] + [f"{c}’ {c}x" for c in low]
    marks = ["'", "'", " ", "s", "t", "re", "VE", "m", "ll", "D", "l", "r", "x", "É", "5", "½", "!", "\n", "\x85", "\xa0", "\x90", "\x1c", "\u2003",
             "’", "ſ", "İ", "́", "漢", "ő", "\U0001f600", "<|endoftext|>", "<|"]
    texts += ["".join(rnd.choices(marks, k=rnd.randrange(30))) for _ in range(3000)] + ["", None, " ", "'", "'s", "x'", "it'll", "a'ld", "''s", ",'s"]
    for step in (1, 100, len(texts)):
        got = [x for i in range(0, len(texts), step) for x in own.encode_all(texts[i:i + step])]
        wrong = [t for t, x in zip(texts, got) if np.frombuffer(x, "<u4").tolist() != ids(t)]
        assert not wrong, wrong[:5]
    long = " ".join(t for t in texts if t)
    monkeypatch.setattr(tokenfiles, "SLICE", 50)
    monkeypatch.setattr(tokenfiles, "MOST", 100)
    monkeypatch.setattr(tokenfiles, "LONGEST", 3)
    own.table.clear()
    assert np.frombuffer(own.encode(long), "<u4").tolist() == ids(long)
    assert len(own.table) <= 100 and max(map(len, own.table)) <= 3
    own.ends = None  # a file without a mark at a word's end
    own.table.clear()
    assert np.frombuffer(own.encode(long), "<u4").tolist() == ids(long)


@pytest.mark.parametrize("width", [*range(1, 33)])
def test_blocks_of_any_width(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 700, dtype=np.uint64).astype(np.uint32)
    ids[::256] = 0
    payload, starts = tokenfiles.pack(ids)
    assert np.frombuffer(payload, tokenfiles.HEAD, 1)["width"][0] in (width, width - 1)
    assert tokenfiles.unpack(payload, starts).tolist() == ids.tolist()


@pytest.mark.parametrize("kind", ["flat", "steps", "spikes", "one", "none"])
def test_blocks_round_trip(kind):
    rnd = np.random.default_rng(3)
    ids = {"flat": np.full(1000, 7), "steps": rnd.integers(0, 50_000, 700), "one": np.array([9]), "none": np.empty(0, int),
           "spikes": np.where(rnd.random(5000) < 0.02, 4_000_000_000, rnd.integers(0, 30, 5000))}[kind].astype(np.uint32)
    payload, starts = tokenfiles.pack(ids)
    assert tokenfiles.unpack(payload, starts).tolist() == ids.tolist()
    if len(starts) > 2:  # blocks by their index alone
        assert tokenfiles.unpack(payload, starts[1:2]).tolist() == ids[256:512].tolist()
    if kind == "spikes":
        assert len(payload) < 2 * len(ids)  # outliers don't widen the blocks


def test_histogram(spark, none):
    sizes = [0, 0, 3, 5, 5, 5, 9, 100, 100, 7]
    hist = lengths.histogram(spark.createDataFrame([(x, 1) for x in sizes] + [(None, 1)], "n_tokens long, n_docs int"))
    rows = {r.n_tokens: r for r in hist.collect()}
    assert {k: r.n_docs for k, r in rows.items()} == Counter(sizes)
    for k, r in rows.items():
        assert r.docs_below == sum(x < k for x in sizes) and r.docs_from == sum(x >= k for x in sizes)
        assert r.tokens_from == sum(x for x in sizes if x >= k) and r.truncated_total == sum(min(x, k) for x in sizes)
        assert (r.total_docs, r.total_tokens) == (len(sizes), sum(sizes))
    cut = {r.context_limit: (r.docs_longer, r.truncated_total) for r in lengths.truncated(hist, [0, 4, 5, 50, 100, 1000]).collect()}
    assert cut == {c: (sum(x > c for x in sizes), sum(min(x, c) for x in sizes)) for c in (0, 4, 5, 50, 100, 1000)}
    q = {r.share: r.n_tokens for r in lengths.quantiles(hist, [0.1, 0.5, 0.75, 1.0]).collect()}
    assert q == {s: sorted(sizes)[int(np.ceil(s * len(sizes))) - 1] for s in q}
    assert lengths.histogram(spark.createDataFrame([], "n_tokens long")).count() == 0


def test_length_query_against_the_library(odd, texts):
    e = tiktoken_encoding()
    ids = bpe.encode(odd, byte_ranks(), P.PATTERN)
    hist = lengths.histogram(ids.selectExpr("octet_length(ids) div 4 as n_tokens"))
    assert {r.n_tokens: r.n_docs for r in hist.collect()} == Counter(len(e.encode_ordinary(t or "")) for _, t in texts)


def brute_water(capacity, weight, budget):
    given, live = dict.fromkeys(capacity, 0.0), {k for k in capacity if weight[k] > 0}
    left = min(budget, sum(capacity[k] for k in live))
    while live:
        unit = left / sum(weight[k] for k in live)
        full = {k for k in live if capacity[k] <= weight[k] * unit + 1e-9}
        if not full:
            return given | {k: weight[k] * unit for k in live}
        for k in full:
            given[k] = capacity[k]
            left -= capacity[k]
        live -= full
    return given


def test_mixing(odd, none, texts):
    plan = mixing.Plan(share=0.6, max_epochs=2, other=1.0, domain={"d0": 0.2, "d1": 0.5}, lang={"en": 3.0, "": 0.0}, source={"src7": 2.0})
    slim = [r.asDict() for r in mixing.leaves_of(odd).collect()]
    assert sum(r["tokens"] for r in slim) == sum(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in texts)
    tree = Counter()
    for r in slim:
        for d in range(4):
            tree[tuple(r[c] for c in mixing.TREE[:d])] += r["tokens"]
    given = {(): tree[()] * plan.share}
    for depth, (name, named) in enumerate((("domain", plan.domain), ("lang", plan.lang), ("source", plan.source))):
        for parent in [k for k in tree if len(k) == depth]:
            kids = {k: 2.0 * tree[k] for k in tree if len(k) == depth + 1 and k[:-1] == parent}
            given |= brute_water(kids, {k: named.get(k[-1], 1.0) for k in kids}, given[parent])
    budget = {tuple(r[c] for c in mixing.TREE): r.budget for r in mixing.budgets(mixing.leaves_of(odd), plan).collect()}
    assert all(abs(budget.get(k, 0) - v) <= 1.001 for k, v in given.items() if len(k) == 3)
    want = Counter()
    for leaf, b in budget.items():
        whole, rest = divmod(b, tree[leaf])
        rows = [r for r in slim if tuple(r[c] for c in mixing.TREE) == leaf]
        key = lambda r: (hashlib.md5(f"7:{whole}:{'' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest(), r["doc_id"] or 0, r["text_key"])  # noqa: B023, E731
        for r in sorted(rows, key=key):
            for e in range(whole):
                want[(r["doc_id"], *leaf, e, r["tokens"], r["tokens"])] += 1
            if rest > 0:
                want[(r["doc_id"], *leaf, whole, r["tokens"], min(r["tokens"], rest))] += 1
            rest -= r["tokens"]
    assert got(mixing.chosen(odd, plan).drop("text_key")) == want
    assert mixing.chosen(none, plan).count() == 0
    one = mixing.Plan(share=0.5, max_epochs=1)
    some = mixing.select(odd, one)
    assert some.columns == odd.columns
    assert {(r.doc_id, r.text) for r in some.collect()} <= {*texts} and 0 < some.count() < len(texts)
