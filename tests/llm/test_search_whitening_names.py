"""Ranked search, whitening and exact duplicates against SQL or brute force, and on odd rows."""

import collections
import hashlib
import math
import re

import numpy as np
import pyarrow as pa
import pytest

from adlattice.llm import block_names, queries, strata_index, whitening
from tests.oracle import compare, duck

FOLDER = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_against_sql(spark, name):
    same, message = compare(queries.QUERIES[name](spark, FOLDER), queries.ORACLE[name], duck(FOLDER))
    assert same, message


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# Ranked search

def plain_ranks(docs, items, k):
    terms = [(doc, collections.Counter(TERM.findall(lowered(text)))) for doc, text in docs]
    terms = [(doc, c, sum(c.values())) for doc, c in terms if c]
    count, total = len(terms), sum(n for _, _, n in terms)
    df = collections.Counter(t for _, c, _ in terms for t in c)
    asked = collections.defaultdict(collections.Counter)
    for item, text in items:
        if item is not None:
            asked[item].update(TERM.findall(lowered(text)))
    out = []
    for item, wanted in asked.items():
        scored = []
        for doc, c, n in terms:
            m = 75 + 25 * n * count // total
            score = sum(r * math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                        for t, r in wanted.items() if c[t])
            if score > 0:
                scored.append((-score, doc is None, doc))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def ranks(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


ODD_DOCS = [(0, None), (1, ""), (2, " .;- "), (3, "Alpha beta"), (3, "Alpha beta"), (4, "alpha ALPHA été Été"), (None, "alpha beta gamma"),
            (None, "alpha beta gamma"), (5, "beta " * 5000), (6, "x" * 70_000), (7, "a1-b2_c3"), (8, "gamma alpha beta"), (9, "delta")]
ODD_ITEMS = [(1, "alpha Beta alpha"), (2, None), (3, ""), (4, "Été x1 c3"), (5, "unknown words"), (6, "gamma"), (6, "delta"), (None, "alpha"), (7, "x" * 70_000)]


@pytest.mark.parametrize("k", [1, 3, 20])
def test_odd_rows_are_ranked_as_by_brute_force(spark, k):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in ODD_DOCS], "doc_id long, text string, m int, terms string").repartition(3)
    items = spark.createDataFrame([(i, t, 2) for i, t in ODD_ITEMS], "item_id long, text string, rank int")
    assert ranks(strata_index.rank_documents(docs, items, k)) == plain_ranks(ODD_DOCS, ODD_ITEMS, k)


def test_one_hot_stratum_many_blocks_and_passes(spark, monkeypatch):
    """All documents but a few are of one length; blocks are small and every item is a pass of its own."""
    monkeypatch.setattr(strata_index, "DOCS_PER_BLOCK", 16)
    monkeypatch.setattr(strata_index, "POSTINGS_PER_PART", 500)
    monkeypatch.setattr(strata_index, "TERMS_PER_PASS", 6)
    draw = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(draw.choice(words, 12 if i < 900 else int(draw.integers(1, 80))))) for i in range(1000)]
    items = [(i, " ".join(draw.choice(words, 5))) for i in range(4)]
    found = strata_index.rank_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
                                        spark.createDataFrame(items, "item_id long, text string"), 10)
    assert ranks(found) == plain_ranks(docs, items, 10)


def test_terms_of_a_text_longer_than_a_part(monkeypatch):
    monkeypatch.setattr(strata_index, "BLOCK", 64)
    texts = ["Alpha beta " * 40, "y" * 300 + " alpha", "", None, "alpha" + ";" * 200 + "beta" + "é" * 100]
    words = pa.array(["alpha", "beta", "y" * 300], pa.large_string())
    n, row, place, tf = strata_index.count_terms(pa.array(texts), words)
    assert n.tolist() == [len(TERM.findall(lowered(t))) for t in texts]
    assert list(zip(row.tolist(), place.tolist(), tf.tolist(), strict=True)) == [(0, 0, 40), (0, 1, 40), (1, 0, 1), (1, 2, 1), (4, 0, 1)]


def test_ranks_of_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    texts = spark.createDataFrame([(1, "alpha")], "doc_id long, text string")
    for d, i in ((docs, items), (docs, some), (texts, items)):
        assert strata_index.rank_documents(d, i).collect() == []


# Whitening

@pytest.mark.parametrize("d", [1, 2, 5, 64])
@pytest.mark.parametrize("kind", ["plain", "equal", "pairs", "flat"])
def test_leading_pairs(d, kind):
    draw = np.random.default_rng(d)
    b = draw.normal(size=(d, d))
    turn = np.linalg.qr(b)[0]
    a = {"plain": b @ b.T, "equal": np.eye(d) * 3.0, "pairs": turn @ np.diag(np.repeat(np.arange(1.0, d // 2 + 2), 2)[:d]) @ turn.T,
         "flat": np.outer(b[0], b[0])}[kind]
    a, k = (a + a.T) / 2, min(32, d)
    values, vectors = whitening.leading_pairs(a, k)
    scale = np.abs(a).max() * d
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:k], atol=1e-13 * scale, rtol=0)
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-13) and np.allclose(a @ vectors, vectors * values, atol=1e-12 * scale, rtol=0)


def test_counts_number_every_eigenvalue():
    a = np.diag([5.0, 3.0, 3.0, 1.0])
    diagonal, beside, _ = whitening.tridiagonal(a)
    assert [whitening.count_above(diagonal, beside, s) for s in (6, 4, 2, 0)] == [0, 1, 3, 4]


def plain_whitening(vectors):
    x = np.floor(64 * np.asarray(vectors, np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(32, int((values > 1e-12 * np.trace(covariance)).sum()))
    return ((n * x - sums) ** 2).sum(axis=1), centred @ axes[:, :k] / np.sqrt(values[:k]), values[:k] / np.trace(covariance)


def held_against_brute_force(rows, out):
    """``rows`` are the (id, vector) that remain, ids unique."""
    deviation, white, explained = plain_whitening([v for _, v in rows])
    assert sorted(out.component.unique()) == list(range(1, white.shape[1] + 1)) and len(out) == white.size
    have = out.pivot(index="vec_id", columns="component", values="whitened").loc[[i for i, _ in rows]].to_numpy()
    signs = np.sign((have * white).sum(axis=0))  # either sign, but the same for all rows
    assert np.allclose(have, white * signs, atol=1e-8)
    by_id = out.groupby("vec_id").first().loc[[i for i, _ in rows]]
    assert by_id.deviation.tolist() == deviation.tolist() and set(out.n) == {len(rows)}
    assert np.allclose(out.groupby("component").explained.first(), explained, rtol=1e-9)
    assert out.identity_error.nunique() == 1 and out.identity_error.iloc[0] < 1e-9


def test_whitened_embeddings(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    out = queries.op12_spectrum_whitening(spark, FOLDER).toPandas()
    held_against_brute_force([(r["vec_id"], r["embedding"]) for r in rows], out)


def test_whitening_of_odd_rows(spark):
    draw = np.random.default_rng(4)
    good = [(i, [float(x) for x in draw.normal(size=6) * [5, 4, 3, 2, 1, 0]]) for i in range(400)]
    good += [(1000, good[0][1]), (1001, good[0][1])]  # repeated vectors
    bad = [(2000, None), (2001, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2002, [float("nan")] * 6), (2003, [1.0, float("inf"), 0.0, 0.0, 0.0, 0.0]),
           (2004, [1.0, 2.0]), (2005, [])]
    df = spark.createDataFrame([(i, v, 1, "n") for i, v in good + bad], "vec_id long, embedding array<double>, component int, n string").repartition(5)
    out = whitening.whiten(df).toPandas()
    assert set(out.component) == {1, 2, 3, 4, 5}  # nothing varies along the sixth
    held_against_brute_force(good, out)


def test_whitening_without_spread(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [0.5, 0.5])], [(None, [0.5, 0.5]), (1, [0.5, 0.5])]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).count() == 0
    out = whitening.whiten(spark.createDataFrame([(None, [0.5, 0.5]), (None, [1.5, 0.5])], schema)).collect()
    assert [(r["vec_id"], r["component"], round(abs(r["whitened"]), 9), r["deviation"]) for r in out] == [(None, 1, 1.0, 64 * 64)] * 2


# Exact duplicates

def plain_groups(rows):
    groups = collections.defaultdict(list)
    for doc, text in rows:
        groups[lowered(text)].append(doc)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(doc, keep, len(ids), doc == keep, hashlib.sha256(text.encode()).hexdigest()) for doc in ids]
    return sorted(out, key=str)


def named_rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


@pytest.mark.parametrize("size", [1, 7, 1024])
def test_odd_rows_are_grouped_by_their_bytes(spark, size):
    rows = [(0, None), (1, ""), (2, "ABC"), (3, "abc"), (3, "abc"), (4, "abcabcabc"), (5, "abcabcab"), (6, "É"), (7, "é"), (8, "é"), (None, "é"),
            (None, "alone"), (None, "Alone"), (9, "x" * 5000), (10, "x" * 4999), (11, "X" * 5000), (12, "x" * 4999 + "y"), (13, "\x00"), (14, " ")]
    df = spark.createDataFrame([(i, t, 1, "r") for i, t in rows], "doc_id long, text string, name int, row string").repartition(3)
    assert named_rows(block_names.exact_duplicates(df, size)) == plain_groups(rows)


def test_hot_groups_and_shared_blocks(spark):
    """A third of all rows are copies, and many texts differ in one block only."""
    draw = np.random.default_rng(6)
    base = "".join(draw.choice(list("abcdef "), 400))
    rows = [(i, base) for i in range(1500)]
    rows += [(2000 + i, base[: i % 400] + "Z" + base[i % 400 + 1 :]) for i in range(1500)]
    rows += [(4000 + i, f"{i // 2} " * (1 + i % 7)) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert named_rows(block_names.exact_duplicates(df, 16)) == plain_groups(rows)


def test_duplicates_of_an_empty_table(spark):
    assert block_names.exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
