"""Suffix dedup, source divergence and whitening against plain versions."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylane.llm import catalog, divergence, rows, suffixes, whiten


def plain_repeats(texts, length):
    """Removed flags of every byte, by looking at all windows."""
    times = Counter(d[i:i + length] for d in texts for i in range(len(d) - length + 1))
    out = []
    for d in texts:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if times[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        out.append(bytes(gone))
    return out


def noisy_texts(seed, n):
    """Copies, near copies, shared passages in other surroundings, runs of one character, and short texts."""
    draw = np.random.default_rng(seed)
    word = lambda: "".join(draw.choice(list("abcdeéß"), draw.integers(1, 7)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passage, line, out = prose(30), prose(4), []
    for i in range(n):
        own = prose(int(draw.integers(0, 60)))
        kind = i % 6
        if kind == 0:
            own += passage + prose(3)
        elif kind == 1:
            own = own + line + prose(2) + line
        elif kind == 2 and out:
            own = out[int(draw.integers(len(out)))]
        elif kind == 3 and out:
            ws = out[int(draw.integers(len(out)))].split(" ")
            ws[int(draw.integers(len(ws)))] = word()
            own = " ".join(ws)
        elif kind == 4:
            own += "z" * int(draw.integers(0, 120)) + passage[int(draw.integers(40)):]
        out.append(own)
    return out


@pytest.mark.parametrize("length,hot", [(200, False), (50, False), (50, True), (7, False), (1, False)])
def test_repeats_against_all_windows(spark, monkeypatch, length, hot):
    monkeypatch.setattr(suffixes, "RANGE_BYTES", 2000)
    monkeypatch.setattr(suffixes, "RUN_BYTES", 4000)
    if hot:
        whole = suffixes.plan_ranges
        grams = lambda sample, n: frozenset({r[:suffixes.gram_of(n)] for r, _ in sample[::2]})
        monkeypatch.setattr(suffixes, "plan_ranges", lambda sample, parts, n: suffixes.Ranges(
            whole(sample, parts, n).spans, tuple(sorted({r for r, _ in sample[::40]})), grams(sample, n)))
    texts = noisy_texts(length, 120)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    found, name = suffixes.remove_repeats(df, length=length)
    got = {r.doc_id: r[name] for r in found.collect()}
    for i, gone in enumerate(plain_repeats([t.encode() for t in texts], length)):
        kept = bytes(b for b, g in zip(texts[i].encode(), gone) if not g)
        assert (bytes(got[i].kept), got[i].n_removed, len(got[i].spans)) == (kept, sum(gone), sum(map(bool, gone.split(b"\0"))))


def test_repeats_across_pieces_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "_PIECE", 1000)
    passage = noisy_texts(3, 6)[0] * 2
    filler = [noisy_texts(k, 12)[5] + str(k) for k in range(10, 60)]
    texts = ["".join(filler), passage + "x", "y" + passage, None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found, name = suffixes.remove_repeats(df)
    for r in found.collect():
        gone = plain_repeats([(t or "").encode() for t in texts], 200)[r.doc_id]
        assert (r[name].n_bytes, r[name].n_removed) == (len((texts[r.doc_id] or "").encode()), sum(gone))


def test_merge_is_sorted_and_knows_its_prefixes():
    draw = np.random.default_rng(5)
    strings = [bytes(draw.choice(list(b"ab"), draw.integers(0, 12)).astype(np.uint8)) for _ in range(500)]
    for k in (1, 2, 3, 7, 16):
        runs = [sorted(strings[i::k]) for i in range(k)]
        coded = [suffixes.front_coded([suffixes.Suffix(s, b"l", 1, 2, 3) for s in run]) for run in runs]
        out = list(suffixes.merged([suffixes.decoded(c) for c in coded]))
        assert [x.right for _, x in out] == sorted(strings)
        assert [n for n, _ in out[1:]] == [suffixes.common_prefix(a.right, b.right) for (_, a), (_, b) in zip(out, out[1:])]
    assert list(suffixes.merged([])) == []


def test_hot_grams_are_those_of_many_distinct_spans():
    gram = suffixes.gram_of(200)
    spread = [(bytes([65 + i]) * 200, bytes([97 + j])) for i in range(20) for j in range(1)]
    hot = [(b"!" * 190 + bytes([60 + j]) * 10, b"left" + bytes([j])) for j in range(30)]
    planned = suffixes.plan_ranges(spread * 50 + hot, 4, 200)
    assert planned.hot == {b"!" * gram} and planned.windows and len(planned.spans) <= 3


def test_query_digest(spark, sf_dir):
    docs = {r.doc_id: (r.text or "").encode() for r in rows.table(spark, sf_dir, "documents").collect()}
    gone = dict(zip(docs, plain_repeats(list(docs.values()), 200)))
    for r in catalog.op11_suffix_dedup(spark, sf_dir).collect():
        kept = bytes(b for b, g in zip(docs[r.doc_id], gone[r.doc_id]) if not g)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest() and r.n_removed == sum(gone[r.doc_id])


def test_divergence_by_hand(spark, monkeypatch):
    monkeypatch.setattr(divergence, "LEAST_DOCUMENTS", 2)
    data = [("en", "a", "Cat cat dog"), ("en", "b", "cat Ünï ünï"), ("en", None, "dog Ünï"), ("en", "b", None), (None, "x", "one"), ("de", "q", "")]
    df = spark.createDataFrame(data, "lang string, source string, text string")
    got = {(r.lang, r.source, r.part, r.item): (r.value, r.rank) for r in divergence.audit(df).collect()}
    # cat: a 2, b 1; dog: a 1, none 1; Ünï: b 1, none 1 (ünï is another term, in one document only).
    counts = {"a": {"cat": 2, "dog": 1}, "b": {"cat": 1, "Ünï": 1}, "": {"dog": 1, "Ünï": 1}}
    p = {s: {t: 1 + 10**9 * (c.get(t, 0) + 5) // (sum(c.values()) + 15) for t in ("cat", "dog", "Ünï")} for s, c in counts.items()}
    q = {t: 1 + 10**9 * (sum(c.get(t, 0) for c in counts.values()) + 5) // 22 for t in ("cat", "dog", "Ünï")}
    pairs = {(s, o): sum(abs(p[s][t] - p[o][t]) for t in q) for s in counts for o in counts if s != o}
    assert {k[1::2]: v[0] for k, v in got.items() if k[2] == "pair"} == pairs
    terms = {(s, t): p[s][t] - q[t] for s in counts for t in counts[s] if p[s][t] > q[t]}
    assert {k[1::2]: v[0] for k, v in got.items() if k[2] == "term"} == terms
    assert sorted(v[1] for k, v in got.items() if k[1:3] == ("a", "pair")) == [1, 2]


def test_divergence_in_blocks_and_chunks(spark, sf_dir, monkeypatch):
    docs = rows.table(spark, sf_dir, "documents")
    whole = {tuple(r) for r in divergence.audit(docs).collect()}
    monkeypatch.setattr(divergence, "WIDTH", 16)
    monkeypatch.setattr(divergence, "CHUNK", 1)
    monkeypatch.setattr(divergence, "_HELD", 50)
    assert {tuple(r) for r in divergence.audit(docs).collect()} == whole


def test_forest_shares_equal_subtrees():
    table = np.array([[1, 0, 0, 0, 1, 0, 0, 0], [1, 0, 0, 0, 1, 0, 0, 0], [0, 0, 0, 0, 7, 0, 0, 0]])
    forest = divergence.Forest(table)
    assert forest.nodes[-1][0, 0] == forest.nodes[-1][1, 0] != forest.nodes[-1][2, 0]
    assert forest.nodes[2][0, 0] == forest.nodes[2][0, 1]
    share = np.array([10, 100, 1000])
    assert forest.price(0, 1, share, share) == 0 and forest.price(0, 2, share, share) == 90 + 900
    assert forest.occupied(2).tolist() == [4]


def test_shares_beyond_64_bits():
    big = np.array([0, 10**15, 9 * 10**15])
    assert divergence.shares(big, 10**16, 3).tolist() == [1 + 10**9 * (int(c) + 5) // (10**16 + 15) for c in big]


def test_whitening_factors():
    draw = np.random.default_rng(1)
    for size, rank in ((7, 7), (8, 3), (1, 1), (33, 33)):
        a = draw.normal(size=(size, rank)) * 10.0 ** draw.integers(-1, 2, rank)
        factor, order = whiten.pivoted_cholesky(a @ a.T)
        assert np.allclose(factor @ factor.T, a @ a.T, rtol=1e-9, atol=1e-9 * np.abs(a @ a.T).max())
        assert np.allclose(factor[order], np.tril(factor[order]))
        values, vectors = whiten.eigenpairs(a @ a.T)
        assert np.allclose(values[:rank], np.linalg.eigvalsh(a @ a.T)[::-1][:rank], rtol=1e-6)
        assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-9)


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[0.1, 0.2, -0.5], [1.5, -0.25, 0.0], [0.1, 0.2, -0.5], [3.0, 3.0, 1.0], [-2.0, 0.5, 0.75]]
    bad = [None, [], [1.0, None, 2.0], [nan, 0.0, 0.0], [inf, 0.0, 0.0], [1.0], [1.0, 2.0]]
    df = spark.createDataFrame([(i, v, i) for i, v in enumerate(good + bad)], "vec_id long, embedding array<float>, n int")
    got = whiten.coordinates(df).toPandas()
    x = np.floor(256 * np.array(good, np.float32).astype(float)).astype(int)
    u = np.unique(x, axis=0)
    n, sums = len(u), u.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(u.T, bias=True))
    assert set(got.vec_id) == set(range(5)) and set(got.n) == {4} and got.component.max() == 3
    for i, r in enumerate(got.drop_duplicates("vec_id").sort_values("vec_id").itertuples()):
        assert r.deviation == ((n * x[i] - sums) ** 2).sum()
    z = (x - sums / n) @ vectors[:, ::-1] / np.sqrt(values[::-1])
    found = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.allclose(np.abs(found), np.abs(z), atol=1e-9) and got.identity_error.max() < 1e-9


@pytest.mark.parametrize("data", [[], [[1.0, 2.0]] * 3, [None, None], [[], []]])
def test_whitening_without_variance(spark, data):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "vec_id long, embedding array<float>")
    found = whiten.coordinates(df)
    assert found.count() == 0 and found.columns[-1] == "identity_error"


def test_whitening_of_huge_numbers(spark):
    df = spark.createDataFrame([(1, [1e18, 0.0]), (2, [-1e18, 1.0]), (3, [0.0, 1e17])], "vec_id long, embedding array<double>")
    assert whiten.coordinates(df).where(F.col("deviation").isNotNull()).count() == 0
    assert whiten.coordinates(df).count() == 6
