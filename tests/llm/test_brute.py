"""The operators against brute force, exact round trips and held-out accuracy."""

import base64
import collections
import itertools
import math
import mmap
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import check_oracle
from longhouse.session import stage
import corpus_pipeline
from longhouse.llm import (
    components,
    decontaminate,
    eliasfano,
    graphann,
    langid,
    mixing,
    ngramlm,
    queries,
    rtreejoin,
    sharding,
    urlfilter,
    warc,
)

SF = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert check_oracle.compare(spark, check_oracle.duck(SF), name, SF) is None


def test_all_ten_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1


def table(name, sf=SF):
    return duckdb.sql(f"SELECT * FROM '{sf}/{name}.parquet'").df()


# --- Hilbert curve -------------------------------------------------------------------------------


@pytest.mark.parametrize("dims", [2, 3])
def test_curve_visits_every_cell_by_single_steps(spark, dims):
    cells = spark.createDataFrame(list(itertools.product(range(8), repeat=dims)), [f"x{i}" for i in range(dims)])
    index = sharding.hilbert_index([F.col(f"x{i}") for i in range(dims)], 3)
    path = [tuple(r)[:dims] for r in cells.withColumn("h", index).orderBy("h").collect()]
    assert [r.h for r in cells.withColumn("h", index).orderBy("h").collect()] == list(range(8**dims))
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in itertools.pairwise(path))


def test_shards_are_runs_of_the_curve(spark):
    got = entry.queries()["op6_hilbert_sharding"](spark, SF).collect()
    docs = table("documents")
    assert len(got) == len(docs)
    text = dict(zip(docs.doc_id, docs.text))
    sizes = collections.Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(8))
    for r in got:
        data = text[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.grown_shard, r.law) == (len(data) + 1, zlib.crc32(data), None, "rows")
    in_order = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.hilbert for r in in_order] == sorted(r.hilbert for r in got)
    for shard in sizes:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sizes[shard]))


def test_written_shards_prune(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("size", sharding.text_size())
    sharding.write_shards(sharding.hilbert_shards(docs, 8), str(tmp_path / "out"), rows_per_file=16)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count()
    # row groups whose smallest and largest value let a scan skip them, by dimension
    groups = []
    for path in (tmp_path / "out").rglob("*.parquet"):
        meta = pq.ParquetFile(path).metadata
        for g in range(meta.num_row_groups):
            columns = (meta.row_group(g).column(c) for c in range(meta.num_columns))
            groups.append({c.path_in_schema: (c.statistics.min, c.statistics.max) for c in columns})
    assert len(groups) > 30
    sizes = sorted(r["size"] for r in docs.collect())
    wanted = {"source": "src0", "lang": "de", "size": sizes[len(sizes) // 20]}
    for column, value in wanted.items():
        skipped = sum(not g[column][0] <= value <= g[column][1] for g in groups)
        assert skipped > len(groups) / 3, (column, skipped, len(groups))


def test_names_keep_their_order_on_the_curve(spark):
    few = spark.createDataFrame([("b",), ("é",), ("a",), (None,), ("b",)], "name string")
    bounds = sharding.name_bounds(few, "name")
    assert bounds == ["a", "b", "é"]
    at = {r.name: r.at for r in few.withColumn("at", sharding.name_coordinate("name", bounds)).collect()}
    assert at == {"a": 0, "b": 10, "é": 21, None: 0}
    many = spark.range(1000).select(F.format_string("n%04d", "id").alias("name"))
    bounds = sharding.name_bounds(many, "name")
    assert len(bounds) == 32 and bounds[:2] == ["n0000", "n0031"]
    got = many.withColumn("at", sharding.name_coordinate("name", bounds)).orderBy("name").collect()
    assert [r["at"] for r in got] == sorted(r["at"] for r in got) and got[-1]["at"] == 31


def test_equal_rows_are_many_tasks(spark):
    docs = spark.range(0, 20_000, 1, 32).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"), F.lit("s").alias("source"),
        F.lit("en").alias("lang"), F.lit(1).alias("__run"), F.lit(2).alias("__cell"),
    )
    got = sharding.hilbert_shards(docs, 4, run_bytes=10_000)
    assert got.columns == [*docs.columns, "shard", "slot", "hilbert"]
    files = [f.removeprefix("file:") for f in got.inputFiles() if "/curve-runs" in f]
    assert max(pq.ParquetFile(f).metadata.num_rows for f in files) < 10_000
    slots = got.groupBy("shard").agg(F.count_distinct("slot").alias("n"), F.max("slot").alias("last")).collect()
    assert sorted((r.shard, r.n, r.last) for r in slots) == [(s, 5000, 4999) for s in range(4)]


# --- mixing --------------------------------------------------------------------------------------


def test_counts_are_poisson_of_the_rate(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("s").alias("source"))
    for rate in (0.3, 2.5, 40.0):
        counts = collections.Counter(r.doc_id for r in mixing.mix(docs, epochs=rate).select("doc_id").collect())
        all_ = np.array([counts.get(i, 0) for i in range(20_000)])
        assert abs(all_.mean() - rate) < 5 * math.sqrt(rate / 20_000)
        assert abs(all_.var() / rate - 1) < 0.1
        zero = math.exp(-rate)
        assert abs((all_ == 0).mean() - zero) < 5 * math.sqrt(zero / 20_000) + 1e-9


# --- Elias-Fano and the language model ------------------------------------------------------------


def test_elias_fano_access_and_find():
    draw = np.random.default_rng(0)
    for n, universe in ((0, 10), (1, 1), (5, 5), (1000, 1000), (1000, 10**12), (20_000, 30_000), (3, 2**50)):
        values = np.sort(draw.integers(0, universe, n)).astype(np.uint64)
        coded = eliasfano.EliasFano.encode(values, universe)
        assert (coded.access(np.arange(n)) == values).all()
        asked = np.concatenate([values, draw.integers(0, universe + 100, 500).astype(np.uint64)])
        found = coded.find(asked)
        known = np.isin(asked, values)
        assert ((found >= 0) == known).all() and (values[found[known]] == asked[known]).all()


def test_level_from_a_memory_map(tmp_path):
    draw = random.Random(1)
    pairs = sorted({(draw.randrange(50) * 3, draw.randrange(1000)) for _ in range(2000)})
    counts = [draw.randrange(1, 9) for _ in pairs]
    arrays = [np.array(a) for a in (*zip(*pairs), counts)]
    level = eliasfano.Level.build(arrays[0].astype(np.uint64), arrays[1].astype(np.uint64), arrays[2], 0.75)
    path = tmp_path / "level"
    path.write_bytes(level.to_bytes())
    with path.open("rb") as f, mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ) as view:
        mapped = eliasfano.Level.map(view)
        asked = [(c, w) for c in range(0, 160, 2) for w in range(0, 1100, 7)]
        rank = mapped.context_ranks(np.array([c for c, _ in asked]))
        share = mapped.share.values(mapped.shares(rank, np.array([w for _, w in asked])))
        rest = mapped.rest.values(mapped.rests(rank))
        total, kinds, of = collections.Counter(), collections.Counter(), dict(zip(pairs, counts))
        for (c, _), n in of.items():
            total[c] += n
            kinds[c] += 1
        for (c, w), s, r in zip(asked, share.tolist(), rest.tolist()):
            assert s == pytest.approx((of[c, w] - 0.75) / total[c] if (c, w) in of else 0, rel=1e-3)
            assert r == pytest.approx(0.75 * kinds[c] / total[c] if c in total else 0, rel=1e-3)
        del mapped, rank, share, rest


def scores_by_force(tokens, held, order):
    """Absolute discounting from the longest context down, over sequences that begin after one end mark."""
    grams, total, kinds = collections.Counter(), collections.Counter(), collections.Counter()
    for i, t in tokens.items():
        if not held[i]:
            grams.update((w,) for w in t)
            for n in range(2, order + 1):
                padded = [b"", *t]
                grams.update(tuple(padded[k : k + n]) for k in range(len(padded) - n + 1))
    for g, n in grams.items():
        if len(g) > 1:
            total[g[:-1]] += n
            kinds[g[:-1]] += 1
    n, v = sum(c for g, c in grams.items() if len(g) == 1), sum(len(g) == 1 for g in grams)
    out = {}
    for i, t in tokens.items():
        base = score = 0.0
        padded = [b"", *t]
        for k in range(1, len(padded)):
            word = padded[k]
            base += math.log10((grams[(word,)] + 1) / (n + v + 1))
            p = max(grams[(word,)] - 0.75, 0) / n + 0.75 * v / n / (v + 1)
            for m in range(1, min(order - 1, k) + 1):
                context = tuple(padded[k - m : k])
                if total[context]:
                    p = max(grams[(*context, word)] - 0.75, 0) / total[context] + 0.75 * kinds[context] / total[context] * p
            score += math.log10(p)
        out[i] = (sum(grams[(w,)] > 0 for w in t), n, base, score)
    return out


# with few tokens for a shard, frequent contexts are dealt over several
@pytest.mark.parametrize("order, shard_tokens", [(2, 5000), (3, 5000), (3, 300), (2, 100), (4, 1000)])
def test_language_model_equals_brute_force(spark, monkeypatch, order, shard_tokens):
    monkeypatch.setattr(ngramlm, "SHARD_TOKENS", shard_tokens)
    docs = table("documents")
    tokens = {i: [*words(t), b""] for i, t in zip(docs.doc_id, docs.text)}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select(
        "doc_id", "text", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2).alias("train")
    )
    scores, tries = ngramlm.train_and_score(rows, order=order)
    got = {r.doc_id: r for r in scores.collect()}
    want = scores_by_force(tokens, held, order)
    assert set(got) == set(tokens)
    for i, t in tokens.items():
        r, (n_known, n, base, score) = got[i], want[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), n_known, n)
        assert r.base_score == pytest.approx(base, abs=1e-6)
        assert r.score == pytest.approx(score, abs=1e-3 * len(t) + 1e-6)
    unseen = [i for i in tokens if held[i]]
    assert sum(got[i].score for i in unseen) > sum(got[i].base_score for i in unseen)
    levels = [eliasfano.map_trie(r.first) for r in tries.collect()]
    assert {len(t) for t in levels} == {order - 1}
    # each level's contexts are the n-grams of the level above
    assert all(low.numbers["m"] == high.numbers["n"] for t in levels for high, low in itertools.pairwise(t))


def test_tries_are_asked_once_for_each_ngram(monkeypatch):
    """Five blocks with the same n-grams, a sixth with others: before, each block's were looked up."""
    ids = lambda *v: ngramlm.pack(np.array(v, np.uint32))
    none = (ids(), ngramlm.pack(np.zeros(0, np.uint64)))
    # pairs 1 2, 1 3 and 4 2, then 1 2 5 and 4 2 5; last words and counts, contexts as steps
    same = ngramlm._Asked(*none, [ids(1, 0, 3), ids(2, 3, 2), ids(1, 1, 0), ids(0, 2), ids(5, 5), ids(1, 0)])
    more = ngramlm._Asked(*none, [ids(1, 3), ids(3, 9), ids(2, 0), ids(1), ids(7), ids(0)])
    union = ngramlm._Union([same] * 5 + [more])
    trie = eliasfano.map_trie(ngramlm.build_trie(union, 0.75))
    assert [level.numbers["n"] for level in trie] == [2, 1]
    looked, find = [], eliasfano.EliasFano.find
    monkeypatch.setattr(eliasfano.EliasFano, "find", lambda own, x, *a: looked.append(len(x)) or find(own, x, *a))
    said = list(ngramlm.ask_trie(trie, union))
    # contexts 1 and 4, the pairs after 1, the triple after 1 2; a last look at no frequent context
    assert looked == [2, 2, 1, 0]
    assert len(said) == 6 and all(s == said[0] for s in said[:5])
    shares = [level.share.values(ngramlm.unpack_codes(x)) for level, x in zip(trie, said[0][0])]
    rests = [level.rest.values(ngramlm.unpack_codes(x)) for level, x in zip(trie, said[0][1])]
    # 5 times 1 2 and 7 times 1 3, 5 times 1 2 5
    assert shares[0] == pytest.approx([4.25 / 12, 6.25 / 12, 0], rel=1e-4)
    assert shares[1] == pytest.approx([4.25 / 5, 0], rel=1e-4)
    assert rests[0] == pytest.approx([0.75 * 2 / 12, 0], rel=1e-4)
    assert rests[1] == pytest.approx([0.75 / 5, 0, 0], rel=1e-4)
    assert (trie[0].share.values(ngramlm.unpack_codes(said[5][0][0])) > 0).tolist() == [True, False]


def test_words_are_told_with_one_shuffle(spark, monkeypatch):
    """Words went to their shards twice, to count them and to number them."""
    dealt = []
    real = ngramlm._word_messages
    count = spark.sparkContext.accumulator(0)

    def messages(blocks, shards):
        def tell(frames):
            for frame in frames:
                count.add(len(frame))
                yield frame

        made = real(blocks, shards)
        dealt.append(made.count())
        return made.mapInPandas(tell, made.schema)

    monkeypatch.setattr(ngramlm, "_word_messages", messages)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", F.lit(True).alias("train"))
    scores, _ = ngramlm.train_and_score(docs)
    assert scores.count() == docs.count()
    assert count.value == dealt[0] > 0


@pytest.mark.parametrize("piece", [1 << 19, 12, 1])
def test_words_are_cut_as_bytes_split(monkeypatch, piece):
    monkeypatch.setattr(ngramlm, "PIECE_BYTES", piece)
    texts = [b"", b" \t", b"A b\x00\x1c\x1f c", b"\n\x0b\x0c\rx", "Ä\u00a0É \u2003z".encode(), b"\xff\xfe Q", b"one", b" two "]
    for text in [*texts, b"\n".join(texts)]:
        cut, stops = ngramlm.cut_words(text)
        assert cut.to_pylist() == text.lower().split() == WORD.findall(text.lower())
        assert [m.end() for m in WORD.finditer(text)] == stops.tolist()
    row = ngramlm._block(7, list(range(len(texts))), [True] * len(texts), texts)
    found = ngramlm.unpack_words(row["words"])
    tokens = [found[t] for t in ngramlm.unpack(row["tokens"])]
    assert tokens == [w for t in texts for w in [*t.lower().split(), ngramlm.END]]
    assert ngramlm.unpack(row["lengths"]).tolist() == [len(t.split()) + 1 for t in texts]
    for some in ([b""], [b"a", b"", b"b"], [b"", b"a"], [b"a", b""]):
        assert ngramlm.word_array(ngramlm.pack_words(some)).to_pylist() == some


@pytest.mark.parametrize("bits", [1, 20, 57, 64])
@pytest.mark.parametrize("n", [0, 1, 2, 64, 1000])
def test_distinct_equals_unique(bits, n):
    keys = np.random.default_rng(n).integers(0, 1 << bits, n, np.uint64, endpoint=False) if bits < 64 else np.full(n, 2**64 - 1, np.uint64)
    keys[n // 2 :] = keys[: n - n // 2]
    for got, want in zip(ngramlm.distinct(keys.copy(), bits), np.unique(keys, return_inverse=True)):
        assert got.tolist() == want.tolist()


def test_set_bits_are_found_in_words():
    draw = np.random.default_rng(0)
    every = [0x8000000000000000, 1, 2**64 - 1, 0xFF00FF, *draw.integers(0, 2**64, 50, np.uint64).tolist()]
    for word in every:
        at = [i for i in range(64) if word >> i & 1]
        got = eliasfano.EliasFano._in_word(np.full(len(at), word, np.uint64), np.arange(len(at)))
        assert got.tolist() == at


def test_language_model_query(spark):
    got = {r.doc_id: r for r in entry.queries()["op2_elias_fano_trie"](spark, SF).collect()}
    docs = table("documents")
    tokens = {i: [*words(t), b""] for i, t in zip(docs.doc_id, docs.text)}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    for i, (n_known, n, base, score) in scores_by_force(tokens, held, ngramlm.ORDER).items():
        r = got[i]
        assert (r.held_out, r.n_known, r.train_tokens) == (held[i], n_known, n)
        assert (r.base_score, r.score) == (pytest.approx(base, abs=1e-6), pytest.approx(score, abs=1e-3 * len(tokens[i])))


# --- URL models ----------------------------------------------------------------------------------


def test_url_scores_equal_brute_force(spark):
    rules = queries.URL_RULES
    got = entry.queries()["op3_url_language_models"](spark, SF).collect()
    pages = table("pages")
    urls = dict(zip(pages.page_id, pages.url))

    def fold(url):
        text = re.sub(r"(?s)^.*?://", "", url, count=1).lower()
        return "^^^" + re.sub(r"(?s)[^a-z0./-]", "*", re.sub("[0-9]", "0", text)) + "$"

    grams = [[collections.Counter() for _ in range(4)] for _ in range(2)]
    for r in got:
        if r.rule and zlib.crc32(urls[r.page_id].encode()) % 5:
            text = fold(urls[r.page_id])
            for at in range(3, len(text)):
                for k in range(4):
                    grams[r.verdict == "allow"][k][text[at - k : at + 1]] += 1
    sums, kinds = ([[collections.Counter() for _ in range(4)] for _ in range(2)] for _ in range(2))
    for side in range(2):
        for k in range(4):
            for g, n in grams[side][k].items():
                sums[side][k][g[:-1]] += n
                kinds[side][k][g[:-1]] += 1

    def log(side, text, at):
        p = 1 / urlfilter.SYMBOLS
        for k in range(4):
            g = text[at - k : at + 1]
            n, t = sums[side][k][g[:-1]], kinds[side][k][g[:-1]]
            if n:
                p = grams[side][k][g] / (n + t) + t / (n + t) * p
        return math.log(p)

    for r in got:
        matching = [q for q in rules if fits(q[0], r.host, r.path)]
        best = max(matching, key=lambda q: len(q[0]), default=(None, None))
        assert r.rule == best[0]
        if best[0]:
            assert r.verdict == best[1] and r.score is None
        else:
            text = fold(urls[r.page_id])
            score = sum(log(1, text, at) - log(0, text, at) for at in range(3, len(text))) / (len(text) - 3)
            assert r.score == pytest.approx(score, abs=1e-5)
            assert r.verdict == ("allow" if r.score >= r.threshold else "block")


def fits(rule, host, path):
    at, slash, rest = rule.partition("/")
    return (host == at or host.endswith("." + at)) and path.startswith(slash + rest)


# --- language ID ---------------------------------------------------------------------------------


@pytest.mark.parametrize("languages", [2, 4, 5, 12, 60])
def test_codewords_lie_apart(languages):
    code = langid.codewords(languages).astype(int)
    apart = (code.shape[1] - code @ code.T) // 2
    nearest = apart[~np.eye(languages, dtype=bool)].min()
    assert nearest >= max(1, code.shape[1] // 4)
    assert (np.abs(code.sum(axis=0)) < languages).all()


def test_held_out_languages(spark):
    got = {r.doc_id: r for r in entry.queries()["op4_output_code_language"](spark, SMALL).collect()}
    docs = table("documents", SMALL)
    held = [(got[i], lang) for i, lang in zip(docs.doc_id, docs.lang) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(got) == len(docs) and all(r.held_out for r, _ in held)
    assert np.mean([r.lang_pred == lang for r, lang in held]) > 0.98


SAID = "the cat and the dog went over the hill with a stone and some bread for the day"


def test_repeated_rows_are_one_text(spark):
    """Rows that repeat id and text share a hash: however many they are, their language is learned."""
    german = [(i, f"der Hund und die Katze gingen mit dem Brot über den Berg Nummer {i}", "de") for i in range(500)]
    for doc_id in range(4):
        same = spark.range(20_000).select(
            F.lit(doc_id).cast("long").alias("doc_id"), F.lit(SAID).alias("text"), F.lit("en").alias("lang")
        )
        assert langid.learn(same).languages == ["en"]
        both = same.unionByName(spark.createDataFrame(german, same.schema))
        assert langid.learn(both).languages == ["de", "en"]
    found = langid.identified(both.limit(50), same).collect()
    assert {r.lang_pred for r in found} == {"en"}


def test_only_the_most_frequent_languages_are_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 3)
    rows = [(100 * k + i, f"word{k} text{k} number {i}", f"l{k}") for k in range(6) for i in range(10 + k)]
    model = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["l3", "l4", "l5"]


def grams_by_hand(text):
    fold = bytes(32 if b < 128 and not chr(b).isalpha() else b for b in range(256))
    data = b" " + b" ".join(text.lower().encode().translate(fold).split()) + b" "
    counts = collections.Counter()
    for n in langid.GRAMS:
        factor = 0x9E3779B1 * (2 * n + 1) & 0xFFFFFFFF
        for i in range(len(data) - n + 1):
            code = int.from_bytes(data[i : i + n], "big") * factor & 0xFFFFFFFF
            counts[code >> 32 - (langid.FEATURES.bit_length() - 1)] += 1
    total = sum(counts.values())
    return {k: math.sqrt(v / total) for k, v in counts.items()}


def test_decoding_equals_brute_force(spark):
    """The nearest codeword by weighted log losses, bit by bit, for every text."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.learn(docs)
    got = {r.doc_id: r for r in langid.identify(docs.where("doc_id < 60"), model).collect()}
    for doc_id, r in got.items():
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score, r.ambiguous) == ("und", 0.0, False)
            continue
        x = grams_by_hand(r.text)
        losses = []
        for k in range(len(model.languages)):
            loss = 0.0
            for bit in range(model.code.shape[1]):
                margin = sum(v * float(model.slopes[f, bit]) for f, v in x.items()) + float(model.offsets[bit])
                loss += float(model.weights[k, bit]) * math.log1p(math.exp(-margin * int(model.code[k, bit])))
            losses.append(loss)
        odds = [math.exp(min(losses) - loss) for loss in losses]
        share = sorted((o / sum(odds) for o in odds), reverse=True)
        assert r.lang_pred == model.languages[losses.index(min(losses))]
        assert r.score == pytest.approx(share[0], abs=1e-4)
        if abs(share[1] / share[0] - langid.AMBIGUOUS) > 1e-3:
            assert r.ambiguous == (share[1] > langid.AMBIGUOUS * share[0])


def test_language_stage_keeps_clean_texts_at_the_stated_rate(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where(langid.has_letter())
    n = docs.count()
    assert n - corpus_pipeline.language(spark, docs, SF).count() <= max(2, langid.FALSE_DROPS * n)


def test_language_stage_without_labels_keeps_texts(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    fold = next(i for i in range(99) if zlib.crc32(str(i).encode()) % corpus_pipeline.FOLDS == corpus_pipeline.HELD_OUT)
    unlabelled = [(1, "some words", None, "s", 1), (2, "12 --", None, "s", 1), (3, None, None, "s", 1), (4, "Ü", None, "s", 1)]
    single = [(fold, "a clean document", "en", "s", 1)]
    for rows, want in ((unlabelled, [1, 4]), (single, [fold])):
        kept = corpus_pipeline.language(spark, spark.createDataFrame(rows, schema), SF)
        assert kept.schema == spark.createDataFrame(rows, schema).schema
        assert sorted(r.doc_id for r in kept.collect()) == want


def test_language_stage_drops_junk_with_letters(spark):
    """Junk that isn't labelled like the corpus's clean texts goes, all of the corpus stays."""
    draw = random.Random(12)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    clean = docs.collect()
    keys = lambda: "".join(draw.choice("asdfjkl") for _ in range(draw.randrange(3, 12)))
    other = "kissa koira talo järvi metsä tämä että ovat mutta kuin hänen oli sekä joka vuonna myös".split()
    junk = []
    for size in (500, 2000, 3500):
        for _ in range(20):
            junk.append(base64.b64encode(draw.randbytes(size)).decode())
            junk.append(draw.randbytes(size // 2).hex())
            junk.append(" ".join(keys() for _ in range(size // 8)))
            junk.append(" ".join(draw.choice(other) + draw.choice(other) for _ in range(size // 6)))
    rows = [(1_000_000 + n, t, None, "junk", len(t)) for n, t in enumerate(junk)]
    kept = corpus_pipeline.language(spark, docs.unionByName(spark.createDataFrame(rows, docs.schema)), SMALL).collect()
    assert sum(r.doc_id >= 1_000_000 for r in kept) <= 0.05 * len(junk)
    lost = {r.doc_id for r in clean} - {r.doc_id for r in kept}
    assert len(lost) <= 0.005 * len(clean)


# --- decontamination -----------------------------------------------------------------------------


def edited(text, edits, draw):
    out = list(text)
    for at in sorted(draw.sample(range(len(out)), edits), reverse=True):
        kind = draw.randrange(3)
        if kind == 0:
            out[at] = "#"
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, "#")
    return "".join(out)


def distance_to_part(pattern, text):
    """Least edit distance of the pattern to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        above, row = row, [i]
        for j, t in enumerate(text, 1):
            row.append(min(above[j - 1] + (p != t), above[j] + 1, row[j - 1] + 1))
    return min(row)


def test_every_region_within_budget_is_found():
    draw = random.Random(3)
    items = ["".join(draw.choice("abcdefgh ") for _ in range(n)) for n in (40, 96, 250, 60)]
    cut = [(i, s, r) for i, t in enumerate(items) for s, r in decontaminate.regions_of(decontaminate.normalise(t))]
    index = decontaminate.Index(*map(list, zip(*cut)))
    texts = []
    for _ in range(150):
        item, start, region = draw.choice(cut)
        noise = ["".join(draw.choice("abcdefgh ") for _ in range(draw.randrange(200))) for _ in range(2)]
        body = edited(region, draw.randrange(0, decontaminate.budget(len(region)) + 4), draw)
        texts.append(decontaminate.normalise(noise[0] + body + noise[1]))
    got = collections.defaultdict(dict)
    for k, item, start, distance, _, _ in index.scan(texts):
        got[k][item, start] = min(distance, got[k].get((item, start), 99))
    for k, text in enumerate(texts):
        want = {}
        for item, start, region in cut:
            d = distance_to_part(region, text)
            if d <= decontaminate.budget(len(region)):
                want[item, start] = d
        assert got[k] == want


def test_leaks_hold_all_verbatim_items(spark, monkeypatch):
    docs, items = table("documents", SMALL), table("benchmark", SMALL)
    plain = {i: decontaminate.normalise(t) for i, t in zip(items.item_id, items.text)}
    want = {
        (d, i) for d, t in zip(docs.doc_id, docs.text) for i, x in plain.items() if x in decontaminate.normalise(t)
    }
    one = entry.queries()["op8_qgram_decontamination"](spark, SMALL).collect()
    assert want <= {(r.doc_id, r.item_id) for r in one}
    # several blocks of the benchmark give the same
    monkeypatch.setattr(decontaminate, "BLOCK_REGIONS", 50)
    many = entry.queries()["op8_qgram_decontamination"](spark, SMALL).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))


def _sections(items):
    return [(i, s, t) for i, x in enumerate(items) for s, t in decontaminate.sections_of(decontaminate.normalise(x))]


def test_passages_are_found_wherever_they_begin():
    draw = random.Random(8)
    items = ["".join(draw.choice("abcdefgh ") for _ in range(n)).strip() for n in (60, 200, 390, 1500)]
    items = [decontaminate.normalise(x) for x in items]
    noise = lambda: "".join(draw.choice("abcdefgh ") for _ in range(draw.randrange(300)))
    scan = decontaminate.Passages(*map(list, zip(*_sections(items)))).scan
    texts, want = [], []
    for length in (50, 51, 80, 100, 120):
        for _ in range(40):
            item = draw.choice([i for i, x in enumerate(items) if len(x) >= length + 2])
            start = draw.randrange(len(items[item]) - length + 1)
            part = items[item][start : start + length]
            if part != part.strip():
                continue
            head = decontaminate.normalise(noise() + " x")
            texts.append(decontaminate.normalise(f"{head} {part} x{noise()}"))
            want.append((item, len(head) + 1, len(head) + 1 + length))
    got = collections.defaultdict(list)
    for k, item, _, _, from_, to in scan(texts):
        got[k].append((item, from_, to))
    for k, (item, from_, to) in enumerate(want):
        assert any(i == item and a <= from_ and b >= to for i, a, b in got[k])
        # where it is found is where it stands, but for some edits' room
        assert all(from_ - 16 <= a and b <= to + 16 for _, a, b in got[k])
    # clean texts, and shorter passages in them, hold nothing
    assert not scan([decontaminate.normalise(noise()) for _ in range(200)])
    assert not scan([decontaminate.normalise(f"{noise()} # {items[3][s : s + 30]} # {noise()}") for s in range(0, 1400, 50)])


def test_items_with_replaced_words_are_found():
    draw = random.Random(9)
    word = lambda: "".join(draw.choice("abcdefghijklm") for _ in range(draw.randrange(3, 9)))
    items = [" ".join(word() for _ in range(40)) for _ in range(20)]
    texts = []
    for x in items:
        for every in (8, 10):
            own = x.split()
            for at in range(draw.randrange(every), len(own), every):
                own[at] = word()
            texts.append(" ".join([word() for _ in range(30)] + own + [word() for _ in range(30)]))
    scan = decontaminate.Passages(*map(list, zip(*_sections(items)))).scan
    assert {(h[0], h[1]) for h in scan(texts)} == {(k, k // 2) for k in range(len(texts))}


def test_short_items_match_as_whole_words(spark):
    benchmark = spark.createDataFrame([(1, "Big cat"), (2, "zoo"), (3, "What is 2+2?"), (4, " "), (5, "é")], "item_id long, text string")
    texts = ["a big  CAT sat", "the big cats", "a zoo.", "zoology", "so: what is 2+2? four", "café", "É", "zoo", None, "big", "cat"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.item_id): (r.regions, r.distance, r.from_char, r.to_char) for r in decontaminate.leaks(docs, benchmark).collect()}
    assert got == {(0, 1): (0, 0, 2, 9), (2, 2): (0, 0, 2, 5), (4, 3): (0, 0, 4, 16), (6, 5): (0, 0, 0, 1), (7, 2): (0, 0, 0, 3)}
    assert {r.doc_id for r in decontaminate.keep_clean(docs, benchmark).collect()} == {1, 3, 5, 8, 9, 10}


def test_excerpts_planted_in_documents(spark):
    """Half an item or less, at random offsets, through both entry points; clean documents stay."""
    draw = random.Random(10)
    items = [(i, decontaminate.normalise(t)) for i, t in zip(*[table("benchmark")[c] for c in ("item_id", "text")])]
    items = [(i, t) for i, t in items if len(t) >= 160]
    rows, want = [], set()
    for n in range(60):
        item, text = draw.choice(items)
        start = draw.randrange(len(text) - 60)
        rows.append((n, f"w{n} some text before {text[start : start + 60]} and some after {n}"))
        want.add((n, item))
    rows += [(1000 + n, f"w{n} some text before and some after {n}") for n in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert want <= {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark).collect()}
    assert {r.doc_id for r in decontaminate.keep_clean(docs, benchmark).collect()} == set(range(1000, 1060))


# --- neighbours ----------------------------------------------------------------------------------


def test_neighbours_recall(spark, monkeypatch):
    monkeypatch.setattr(graphann, "SHARD_ROWS", 150)
    got = entry.queries()["op5_pruned_graph_neighbours"](spark, SMALL).collect()
    table_ = table("embeddings", SMALL)
    ids, x = table_.vec_id.to_numpy(), np.stack(table_.embedding).astype(np.float64)
    hits = []
    for q in ids[ids % 100 == 0]:
        far = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        near = [i for i in np.lexsort((ids, far)) if ids[i] != q][:10]
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, _, _ in own] == list(range(1, 11))
        assert all(s == pytest.approx(far[ids == v][0], abs=1e-12) for _, v, s in own)
        hits.append(len({v for _, v, _ in own} & set(ids[near].tolist())) / 10)
    assert np.mean(hits) >= 0.95


def test_a_graph_is_built_once_whatever_the_queries(spark, monkeypatch):
    monkeypatch.setattr(graphann, "QUERY_BLOCK", 2)
    staged = []
    monkeypatch.setattr(graphann, "stage", lambda df, label: (staged.append(label), stage(df, label))[1])
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    found = graphann.nearest(vectors, vectors.where("vec_id % 10 = 0"), 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") > 3 and "FlatMapGroupsInPandas" not in plan
    assert staged.count("ann-graphs") == 1
    assert found.count() == 3 * vectors.where("vec_id % 10 = 0").count()


# --- components and the Jaccard join ---------------------------------------------------------------


def brute_components(nodes, edges):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    draw = random.Random(5)
    edges = [(draw.randrange(400), draw.randrange(400)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 6000 + i) for i in range(50)] + [(7, 7)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = brute_components({n for e in edges for n in e}, edges)
    assert {n: label for n, label in got.items()} == {n: w for n, w in want.items() if n in got}
    assert {n for e in edges for n in e if e[0] != e[1]} <= set(got)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_join(rows, size, similar):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    links = [
        (a, b)
        for a, b in itertools.combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= similar * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), c) for i, c in brute_components(sets, links).items()}


@pytest.fixture(scope="module")
def near_copies():
    """Texts around the threshold, chains of them, and a large cluster of near copies."""
    draw = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, n = [], 0

    def add(tokens):
        nonlocal n
        rows.append((n, " ".join(tokens)))
        n += 1

    for size in (1, 2, 3, 8, 12, 13, 30, 60, 150, 400):
        for _ in range(4):
            base = [draw.choice(vocabulary) for _ in range(size)]
            add(base)
            add(base)
            for edits in (1, 1, 2, 3, 6, 12):
                other = list(base)
                for _ in range(edits):
                    other[draw.randrange(size)] = draw.choice(vocabulary)
                if draw.random() < 0.5:
                    other = other[: max(1, size - edits)]
                add(other)
    base = [draw.choice(vocabulary) for _ in range(120)]
    for k in range(60):
        other = list(base)
        other[draw.randrange(120)] = f"x{k}"
        add(other)
    passage = [draw.choice(vocabulary) for _ in range(60)]
    for _ in range(40):
        add([draw.choice(vocabulary) for _ in range(20)] + passage + [draw.choice(vocabulary) for _ in range(20)])
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("size", "similar", "task"), [(3, 90, 2000), (5, 80, 2000), (3, 90, 7), (5, 80, 10)])
def test_join_equals_brute_force(spark, near_copies, monkeypatch, size, similar, task):
    """Small tasks make large clusters take the way over pivots and blocks."""
    monkeypatch.setattr(rtreejoin, "TASK_SETS", task)
    docs = spark.createDataFrame(near_copies, "doc_id long, text string")
    got = rtreejoin.jaccard_components(docs, size, similar).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_join(near_copies, size, similar)


def test_shared_passages_bring_no_sets_together(spark):
    """Of texts that share half of their words, those that are linked meet, and no others."""
    draw = random.Random(23)
    vocabulary = [f"w{i}" for i in range(5000)]
    passage = [draw.choice(vocabulary) for _ in range(100)]
    texts = []
    for _ in range(60):
        texts.append([draw.choice(vocabulary) for _ in range(50)] + passage + [draw.choice(vocabulary) for _ in range(50)])
    for k in range(0, 60, 6):
        texts.append([*texts[k][:20], "changed", *texts[k][21:]])
    texts = [" ".join(t) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rank = rtreejoin.bucket_ranks(rtreejoin.document_sets(docs, 5).where("buckets IS NOT NULL"))
    with np.errstate(over="ignore"):
        codes, sizes = rtreejoin.shingle_sets(texts, 5)
        sig, owner, level = rtreejoin.signatures(codes, sizes, 80, rank)
    runs = {}
    for s, o, lv in zip(sig.tolist(), owner.tolist(), level.tolist()):
        runs.setdefault((s, lv), set()).add(o)
    met = {pair for run in runs.values() for pair in itertools.combinations(sorted(run), 2)}
    assert met == {(k, 60 + k // 6) for k in range(0, 60, 6)}
    sets = np.split(codes, np.cumsum(sizes)[:-1])
    linked = {
        (i, j)
        for i, j in itertools.combinations(range(len(sets)), 2)
        if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))
    }
    assert linked == met


# --- archives ------------------------------------------------------------------------------------


def test_dictionary_leads_the_archive():
    draw = random.Random(2)
    records = [
        warc.record(i, f"http://x/{i}", "response", None, "D" * 32, " ".join(draw.choices("abcdefg", k=400)).encode(), "t")
        for i in range(200)
    ]
    out = list(warc.frames(iter(records)))
    assert len(out) == 201 and int.from_bytes(out[0][:4], "little") == warc.DICTIONARY_FRAME
    content = warc.EMPTY_FRAME.encode().join(out)
    back = list(warc.read_records(warc.open_archive(content)))
    assert [h["WARC-Record-ID"] for h, _ in back] == [f"<urn:page:{i}>" for i in range(200)]
    alone = list(warc.frames(iter(records[:1])))
    assert len(alone) == 1 and len(list(warc.read_records(warc.open_archive(alone[0])))) == 1


# --- pipeline ------------------------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    """Each stage's decisions against brute force over its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    junk = [(90_001, "12 34 --", "en", "src0", 8), (90_002, None, "en", "src0", 0)]
    docs = docs.unionByName(spark.createDataFrame(junk, docs.schema))
    kept = {}
    for number, (name, apply) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        path = str(tmp_path / name)
        apply(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        if number < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = (before, docs.collect())
    before, after = kept["language_id"]
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == {90_001, 90_002}
    before, after = kept["ngram_jaccard_join"]
    want = {c for _, c in brute_join([(r.doc_id, r.text) for r in before], 5, 80).values()}
    assert sorted(r.doc_id for r in after) == sorted(want)
    before, after = kept["benchmark_decontamination"]
    plain = [decontaminate.normalise(t) for t in table("benchmark").text]
    leaked = {r.doc_id for r in before if any(x in decontaminate.normalise(r.text) for x in plain)}
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == leaked
    before, after = kept["mixing"]
    assert {r.doc_id for r in after} <= {r.doc_id for r in before}
    before, after = kept["sharding"]
    assert sorted(r.doc_id for r in before) == sorted(r.doc_id for r in after)
    sizes = collections.Counter(r.shard for r in after)
    assert max(sizes.values()) - min(sizes.values()) <= 1
