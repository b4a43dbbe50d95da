"""Exact duplicates, collocations and whitening: brute force, edges and damage."""

import collections
import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from longhouse.llm import collocations, exactdedup, whitening

SF = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, keep_id string, digest string, n long, __doc string, `a.b` long"


# --- exact duplicates ----------------------------------------------------------------------------


def by_force(rows):
    """(id, keep, size) of each row, and how many rows of each text stay."""
    groups = collections.defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    out = []
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids)) for i in ids]
    return sorted(out, key=str), len(groups)


@pytest.mark.parametrize("digest", [exactdedup.sha256, lambda t: F.unhex(F.lpad(F.hex(F.crc32(t.cast("binary")) % 3), 2, "0"))])
def test_groups_of_equal_texts(spark, digest):
    """Also where the digest tells next to nothing: full texts are compared."""
    draw = random.Random(5)
    texts = ["", None, "a", "A", "a ", "é", "é", "word " * 50_000, *[f"t{i}" for i in range(20)]]
    rows = [(i, draw.choice(texts)) for i in range(400)] + [(500 + i, "hot") for i in range(300)]
    rows += [(None, "lost"), (None, "lost"), (None, "a"), (399, "twice"), (399, "twice"), (7, "twice")]
    docs = spark.createDataFrame([(i, t, "en", "k", "d", 1, "x", 2) for i, t in rows], DOCS).repartition(7)
    got = exactdedup.duplicates(docs, digest=digest).collect()
    want, kept = by_force(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=str) == want
    stays = [r for r in got if r.kept]
    assert len(stays) == kept and all(r.doc_id == r.keep_id for r in stays)
    assert exactdedup.duplicates(docs.limit(0), digest=digest).count() == 0


def test_one_row_of_each_text_stays(spark):
    rows = [(1, "a"), (3, "a"), (3, "a"), (2, "A"), (None, None), (4, ""), (None, "n"), (None, "n")]
    docs = spark.createDataFrame([(i, t, "en", "k", "d", 1, "x", 2) for i, t in rows], DOCS)
    kept = exactdedup.keep_one(docs)
    assert kept.schema == docs.schema
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == [(2, "A"), (3, "a"), (4, ""), (None, "n")]
    lower = exactdedup.keep_one(docs, F.lower)
    assert sorted(((r.doc_id, r.text) for r in lower.collect()), key=str) == [(3, "a"), (4, ""), (None, "n")]
    assert exactdedup.keep_one(docs.limit(0)).count() == 0


def test_equal_texts_meet_in_steps(spark):
    """Full texts are a key of each aggregate, and the first is made before rows move."""
    rows = spark.createDataFrame([(1, "t", b"0")], "doc_id long, text string, digest binary")
    plan = exactdedup.combine(rows)._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"HashAggregate\(keys=\[([^]]*)\]", plan)
    assert len(keys) == 4 and all("text" in k and "digest" in k for k in keys)
    assert sum("salt" in k for k in keys) == 2


def test_shas_are_those_of_the_texts(spark):
    got = entry.queries()["op11_salted_combining"](spark, SF).collect()
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    assert {r.doc_id: r.text_sha256 for r in got} == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in docs}


# --- collocations --------------------------------------------------------------------------------


def phrases_by_force(rows, longest, least, top):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        data = (text or "").encode().lower()
        for piece in re.split(rb"[.,;:!?\x0a-\x0d]", data):
            words = re.findall(rb"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, seen in counts.items():
        often = {g: n for g, n in seen.items() if n >= least and len(g) > 1}
        found = []
        for g, a in often.items():
            cuts = [(1000 * a * totals[lang] // (seen[g[:k]] * seen[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            inside = (h[i : i + len(g)] == g for h, n in often.items() if len(h) > len(g) and n >= a for i in range(len(h) - len(g) + 1))
            if not any(inside):
                found.append((-score, -a, b" ".join(g), seen[g[:k]], seen[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def some_texts(seed, n):
    draw = random.Random(seed)
    words = ["a", "B", "the", "ÉT", "x\x1cy", " ", "longer", "w0", "w1", "w2", "w3"]
    marks = [" ", "  ", "\t", " ", " ", ", ", ".", "\n", "\x0b", " - ", "\x85 "]
    for _ in range(n):
        yield "".join(draw.choice(words) + draw.choice(marks) for _ in range(draw.randrange(60)))


@pytest.mark.parametrize("small", [False, True])
def test_phrases_equal_brute_force(spark, monkeypatch, small):
    rows = [(t, ["en", "de", None][i % 3]) for i, t in enumerate(some_texts(1, 300))]
    rows += [(None, "en"), ("", None), ("one", "fr"), ("the a " * 3000, "en"), ("the a " * 3000, "en")]
    if small:  # tries burst, spill and lose their words all the time
        for name, value in {"BURST": 2, "ENTRIES": 20, "WORDS": 5, "CHUNK": 100, "FILTER_BITS": 1}.items():
            monkeypatch.setattr(collocations, name, value)
    docs = spark.createDataFrame([(t, lang, "p", 1) for t, lang in rows], "text string, lang string, phrase string, n long")
    for longest, least, top in ((5, 3, 50), (2, 1, 10**6), (3, 40, 5)):
        got = collocations.collocations(docs, longest, least, top).collect()
        assert sorted(map(tuple, got)) == phrases_by_force(rows, longest, least, top)
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_trie_bursts_and_is_cut_by_subtrees():
    draw = random.Random(3)
    trie, want = collocations.HatTrie(burst=3, depth=2), collections.Counter()
    for _ in range(300):
        batch = []
        for _ in range(10):
            phrase = b"".join(draw.randrange(1, 6).to_bytes(4, "little") for _ in range(draw.randrange(1, 6)))
            batch.append((phrase, draw.randrange(1, 9)))
        batch = sorted(batch) if draw.random() < 0.5 else batch
        trie.add(*map(list, zip(*batch)))
        for phrase, n in batch:
            want[phrase] += n
    assert len(trie) == len(want)
    depth, node = 0, trie.root
    while isinstance(node, collocations.Branch):
        node, depth = max(node.children.values(), key=len), depth + 1
    assert depth == 2
    got, (phrases, counts) = collections.Counter(), trie.cut(len(want) // 2)
    assert len(trie) <= len(want) // 2 and phrases
    left = trie.cut(0)
    assert len(trie) == 0 and not {p[:4] for p in phrases} & {p[:4] for p in left[0]}  # whole subtrees
    for part in ((phrases, counts), left):
        assert len(part[0]) == len(set(part[0]))
        got.update(dict(zip(*part)))
    assert got == want


def test_runs_are_sorted_and_read_back():
    counter = collocations.Counter(b"en", (1, 2, 3), 4, None, np.full(16, 2**64 - 1, np.uint64))
    words = [f"w{i % 37}é" for i in range(500)]
    assert list(counter.text(" ".join(words).encode())) == []
    want, seen, parts = collections.Counter(), collections.Counter(), {}
    for k in (1, 2, 3):
        want.update(" ".join(words[i : i + k]).encode() for i in range(len(words) - k + 1))
    for batch in counter.close():
        for row in batch.to_pylist():
            run = collocations.read_run(row["lengths"], row["phrases"], row["counts"]).to_pylist()
            # in the order of words, so that what begins alike lies together
            assert [r["phrase"].split() for r in run] == sorted(r["phrase"].split() for r in run)
            seen.update({r["phrase"]: r["n"] for r in run})
            for r in run:
                assert parts.setdefault(tuple(r["phrase"].split()[:2]), row["part"]) == row["part"]
    assert seen == want


def test_products_beyond_64_bits(spark, monkeypatch):
    """Scores are exact where 1000 a n and l r pass 2**64."""
    big = 3_000_000_019
    grams = [("en", "x", big * 7), ("en", "y", big * 5), ("en", "x y", big * 3)]
    frame = spark.createDataFrame(grams, "lang string, phrase string, n long")
    totals = spark.createDataFrame([("en", big * 1_000_003)], "lang string, n long")
    monkeypatch.setattr(collocations, "frequent_phrases", lambda *_: (frame, totals))
    (r,) = collocations.collocations(frame).collect()
    assert r.score == 1000 * r.a * r.n // (r.l * r.r) and 1000 * r.a * r.n > 2**64 and r.l * r.r > 2**64


# --- whitening -----------------------------------------------------------------------------------


def test_inertia_counts_eigenvalues():
    draw = np.random.default_rng(0)
    for n in (1, 2, 5, 12):
        for _ in range(50):
            a = draw.integers(-3, 4, (n, n)).astype(float)
            a += a.T
            values = np.linalg.eigvalsh(a)
            for shift in draw.uniform(-9, 9, 5):
                assert whitening.above(a, shift) == (values > shift).sum()
    assert whitening.above(np.zeros((3, 3)), 0.0) == 0
    assert whitening.above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


@pytest.mark.parametrize(
    "values", [[9, 5, 4, 1], [5, 5, 5, 1, 1, 0], [1] * 8, [1, 1 - 1e-13, 1 - 1e-9, 0.5], [0, 0], [7], [1e8, 1, 1e-4]]
)
def test_slices_find_every_leading_pair(values):
    draw = np.random.default_rng(len(values))
    q, _ = np.linalg.qr(draw.standard_normal((len(values), len(values))))
    a = q @ np.diag(np.array(values, float)) @ q.T
    a = (a + a.T) / 2
    pairs = whitening.leading(a, 8)
    want = [v for v in np.linalg.eigvalsh(a)[::-1] if v > 1e-12 * max(values)]
    assert np.allclose([p.value for p in pairs], want, rtol=1e-12, atol=1e-14 * max(values))
    vectors = np.array([p.vector for p in pairs]).reshape(-1, len(values))
    assert np.abs(vectors @ vectors.T - np.eye(len(pairs))).max(initial=0) < 1e-14
    for k, p in enumerate(pairs, 1):
        assert np.linalg.norm(a @ p.vector - p.value * p.vector) < 1e-13 * max(values)
        assert whitening.above(a, p.low) >= k > whitening.above(a, p.high)


def whitened_by_force(vectors):
    x = np.floor(1024.0 * np.array(vectors, np.float64)) + 100_000
    n, mean = len(x), x.mean(axis=0)
    values, axes = np.linalg.eigh((x - mean).T @ (x - mean) / n)
    values, axes = values[::-1], axes[:, ::-1]
    whole = x.astype(np.int64).astype(object)
    deviation = ((n * whole - whole.sum(axis=0)) ** 2).sum(axis=1)
    return (x - mean) @ axes / np.sqrt(np.maximum(values, 1e-300)), values, deviation


def test_whitened_rows_equal_an_eigensolver(spark):
    got = entry.queries()["op13_spectrum_slicing"](spark, SMALL).collect()
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SMALL}/embeddings.parquet' ORDER BY vec_id").fetchall()
    rows = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    w, values, deviation = whitened_by_force([v for _, v in rows])
    at = {i: k for k, (i, _) in enumerate(rows)}
    assert len(got) == 8 * len(rows) and {r.n for r in got} == {len(rows)}
    columns = np.zeros((len(rows), 8))
    for r in got:
        columns[at[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == deviation[at[r.vec_id]]
        assert math.isclose(r.explained, values[r.component - 1] / values.sum(), rel_tol=1e-9)
    for k in range(8):
        sign = np.sign(columns[:, k] @ w[:, k])
        assert np.abs(columns[:, k] - sign * w[:, k]).max() < 1e-7
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_whitening_edges(spark):
    schema = "vec_id long, embedding array<float>, n long, x string"
    rows = [
        (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (None, [3.0, 1.0]), (3, None), (4, []), (5, [None, 1.0]),
        (6, [math.nan, 1.0]), (7, [math.inf, 1.0]), (8, [1.0, 2.0, 3.0]), (9, [-5.0, 2.5]),
    ]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], schema)
    got = whitening.whiten(frame).collect()
    assert sorted(str(r.vec_id) for r in got if r.component == 1) == ["1", "1", "2", "9", "None"]
    assert {r.n for r in got} == {5} and {r.component for r in got} == {1, 2}
    assert got[0].identity_error < 1e-12
    assert whitening.whiten(frame.limit(0)).count() == 0
    assert whitening.whiten(frame.where("vec_id = 1")).count() == 0  # all equal
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i], 1, "x") for i in range(5)], schema)
    assert {r.component for r in whitening.whiten(flat).collect()} == {1}
    # numbers whose products pass a double's whole numbers
    large = spark.createDataFrame([(i, [float(i * 10**5), float((i * i) % 7)], 1, "x") for i in range(40)], schema)
    found = whitening.whiten(large).collect()
    w, values, deviation = whitened_by_force([[float(i * 10**5), float((i * i) % 7)] for i in range(40)])
    assert {(r.vec_id, r.deviation) for r in found} == {(i, d) for i, d in enumerate(deviation)}
    assert found[0].identity_error < 1e-9


def test_sums_do_not_depend_on_how_rows_lie(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    rows = whitening.usable(frame)
    one, other = whitening.fit(rows.coalesce(1)), whitening.fit(rows.repartition(5))
    assert [p.value for p in one.pairs] == [p.value for p in other.pairs]
    assert all((p.vector == q.vector).all() for p, q in zip(one.pairs, other.pairs))
