"""Nulls, empty tables, clashing names, repeated rows: every operator has a defined result."""

import math

import pytest

from longhouse.llm import (
    chat,
    decontaminate,
    graphann,
    langid,
    mixing,
    ngramlm,
    rtreejoin,
    sharding,
    urlfilter,
    warc,
)
from longhouse.session import fresh_dir

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard int, rate string, copy string"
LONG = "word " * 60_000


@pytest.fixture(scope="module")
def docs(spark):
    english = "the cat and the dog went over the hill with a stone and some bread for the day"
    german = "der Hund und die Katze gingen mit dem Brot über den Berg und das Haus für den Tag"
    rows = [
        (1, english, "en", "a", 10, 5, "x", "y"),
        (1, english, "en", "a", 10, 5, "x", "y"),
        (2, german, "de", "a", 10, None, None, None),
        (3, None, "en", None, None, 1, "", ""),
        (4, "", None, "b", 0, 1, "", ""),
        (5, "1234 !!! ---", "en", "b", 0, 1, "", ""),
        (None, english + " more", "en", "a", 3, 1, "", ""),
        (7, LONG, "en", "a", 3, 1, "", ""),
        (8, "two words", None, "a", 3, 1, "", ""),
        (9, english.upper(), "en", "c", 3, 1, "", ""),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def test_language(docs, no_docs):
    found = {(r.doc_id, r.text): r for r in langid.identified(docs, docs).collect()}
    by_id = {i: r for (i, _), r in found.items()}
    assert by_id[1].lang_pred == "en" and by_id[2].lang_pred == "de"
    for und in (3, 4, 5):
        assert (by_id[und].lang_pred, by_id[und].score, by_id[und].ambiguous) == ("und", 0.0, False)
    assert all(0 <= r.score <= 1 for r in found.values())
    assert by_id[1].shard == 5
    assert langid.identified(no_docs, docs).count() == 0
    unlearned = langid.identified(docs, no_docs).collect()
    assert len(unlearned) == 10 and {r.lang_pred for r in unlearned} == {"und"}
    kept = langid.keep_identified(docs, docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 1, 2, 7, 8, 9]


def test_language_model(docs, no_docs):
    from pyspark.sql import functions as F

    rows = docs.select("doc_id", "text", F.when(F.col("doc_id") != 2, True).alias("train"))
    scores, tries = ngramlm.train_and_score(rows)
    got = scores.collect()
    assert len(got) == 10 and tries.count() > 0
    empty = [r for r in got if r.n_tokens == 1]
    assert {r.doc_id for r in empty} == {3, 4}
    assert all(r.score < 0 and r.base_score < 0 and math.isfinite(r.score) for r in got)
    assert [r.n_tokens for r in got if r.doc_id == 7] == [60_001]
    assert sum(r.doc_id is None for r in got) == 1
    # a null flag and a false one don't train
    train = sum(r.n_tokens for r in got if r.doc_id not in (None, 2))
    assert {r.train_tokens for r in got} == {train}
    none, _ = ngramlm.train_and_score(no_docs.select("doc_id", "text", F.lit(True).alias("train")))
    assert none.count() == 0
    untrained, _ = ngramlm.train_and_score(docs.select("doc_id", "text", F.lit(False).alias("train")))
    assert {(r.score, r.base_score, r.n_known) for r in untrained.collect()} == {(0.0, 0.0, 0)}


def test_decontamination(spark, docs, no_docs):
    items = "item_id long, text string, doc_id long"
    passage = "the cat and the dog went over the hill with a stone and some bread for the day"
    benchmark = spark.createDataFrame([(1, passage, 9), (2, None, 9), (3, "", 9), (4, "short", 9), (1, passage, 8)], items)
    found = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(docs, benchmark).collect()}
    assert set(found) == {(1, 1), (None, 1), (9, 1)}
    assert (found[1, 1].distance, found[1, 1].from_char) == (0, 0)
    kept = decontaminate.keep_clean(docs, benchmark)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5, 7, 8]
    nothing = spark.createDataFrame([], items)
    assert decontaminate.leaks(docs, nothing).count() == 0
    assert decontaminate.keep_clean(docs, nothing).count() == 10
    assert decontaminate.leaks(no_docs, benchmark).count() == 0


def test_join(docs, no_docs):
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in rtreejoin.jaccard_components(docs).collect())
    assert got == [
        (0, 17, 1),
        (1, 16, 1),
        (1, 16, 1),
        (2, 16, 2),
        (3, 0, 3),
        (4, 0, 4),
        (5, 1, 5),
        (7, 1, 7),
        (8, 1, 8),
        (9, 16, 1),
    ]
    kept = rtreejoin.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 5, 7, 8]
    assert rtreejoin.jaccard_components(no_docs).count() == 0
    assert rtreejoin.keep_one(no_docs).count() == 0


def test_mixing(docs, no_docs):
    mixed = mixing.mix(docs, epochs=20.0)
    got = mixed.collect()
    assert mixed.columns == [c for c in docs.columns if c not in ("rate", "copy")] + ["copy", "rate", "shuffle_key"]
    assert {r.source for r in got} == {"a", "b", "c", None}
    keys = [r.shuffle_key for r in got]
    assert keys == sorted(keys)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(docs, epochs=20.0).collect()), key=str)
    assert mixing.mix(no_docs).count() == 0
    only = mixing.mix(docs, weights={"b": 1.0}, epochs=20.0).collect()
    assert {r.source for r in only} == {"b"}
    assert mixing.mix(docs, weights={}).count() == 0
    assert {r.source for r in mixing.mix(docs, weights={None: 2.0}, epochs=20.0).collect()} == {None}
    with pytest.raises(ValueError):
        mixing.mix(docs, weights={"a": -1.0})


def test_sharding(docs, no_docs):
    got = sharding.hilbert_shards(docs, 4).collect()
    assert len(got) == 10
    for shard in range(4):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots))) and len(slots) in (2, 3)
    assert sharding.hilbert_shards(no_docs).count() == 0
    assert {r.shard for r in sharding.hilbert_shards(docs.limit(2), 8).collect()} <= set(range(8))


def test_urls(spark):
    pages = "page_id long, url string, host string, score string"
    urls = [
        "http://a.com/x", "http://a.com/y", "http://b.net/x", "http://b.net/y", "http://b.net/z", "http://a.com/z",
        "HTTP://A.COM/x", "http://notcom/", None, "", "no scheme", "http://x.org", "http://x.org?q", "://", "http://é.org/ß",
        "http://a.com",
    ]
    rows = spark.createDataFrame([(i, u, "h", "s") for i, u in enumerate(urls)] + [(None, urls[0], "h", "s")] * 2, pages)
    got = urlfilter.judge(rows, [("com/", "allow"), ("net/", "block"), ("a.com/z", "block")]).collect()
    assert len(got) == len(urls) + 2
    by_id = {r.page_id: r for r in got}
    assert [by_id[i].rule for i in (0, 2, 5, 6, 7, 8, 15)] == ["com/", "net/", "a.com/z", "com/", None, None, None]
    assert [by_id[i].verdict for i in (0, 2, 5)] == ["allow", "block", "block"]
    assert (by_id[6].host, by_id[6].path, by_id[8].host, by_id[10].path) == ("a.com", "/x", "", "")
    assert (by_id[11].host, by_id[11].path, by_id[12].path) == ("x.org", "", "")
    assert all(r.verdict in ("allow", "block") for r in got)
    assert all((r.score is None) == (r.rule is not None) for r in got)
    assert urlfilter.judge(rows.limit(0), [("com/", "allow")]).count() == 0
    unruled = urlfilter.judge(rows, []).collect()
    assert {(r.verdict, r.score) for r in unruled} == {("allow", 0.0)}


def test_chat(spark):
    turns = "conv_id long, turn long, role string, text string, formatted string"
    nasty = r"a\ <|turn|> \\<s> <|end|>[INST]<<|text|>" + "\n<"
    rows = [
        (1, 0, "user", nasty, "f"),
        (1, 1, "assistant", r"back\slash", "f"),
        (1, 1, "assistant", r"back\slash", "f"),
        (2, None, None, None, "f"),
        (2, 0, "assistant", "", "f"),
        (None, 0, "<|text|>", "é" * 70_000, "f"),
        (None, 1, "assistant", "end\\", "f"),
    ]
    frame = spark.createDataFrame(rows, turns)
    whole = chat.format_conversations(frame)
    read = {r.conv_id: r for r in chat.read_back(whole).collect()}
    assert all(r.identical for r in read.values())
    assert [tuple(t) for t in read[1].turns] == [r[2:4] for r in rows[:3]]
    assert [tuple(t) for t in read[2].turns] == [("", ""), ("assistant", "")]
    assert [tuple(t) for t in read[None].turns] == [r[2:4] for r in rows[5:]]
    assert read[1].loss_text == r"back\slash" * 2
    for c in chat.CONTROLS[3:]:
        assert all(c not in r.formatted for r in read.values())
    assert chat.digest(chat.read_back(chat.format_conversations(frame.limit(0)))).count() == 0


def test_neighbours(spark):
    schema = "vec_id long, embedding array<float>, rank int"
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [0.0, 1.0], 1), (4, [0.9, 0.1], 1), (4, [0.9, 0.1], 1),
        (5, None, 1), (6, [0.0, 0.0], 1), (7, [math.nan, 1.0], 1), (8, [None, 1.0], 1), (9, [math.inf, 1.0], 1),
        (None, [1.0, 1.0], 1), (10, [], 1), (11, [1.0, 2.0, 3.0], 1),
    ]
    vectors = spark.createDataFrame(rows, schema)
    got = {}
    for r in graphann.nearest(vectors, vectors, 2).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert got == {1: [(1, 2), (2, 4)], 2: [(1, 1), (2, 4)], 3: [(1, 4), (2, 1)], 4: [(1, 1), (2, 2)]}
    assert graphann.nearest(vectors.limit(0), vectors, 2).count() == 0
    assert graphann.nearest(vectors, vectors.limit(0), 2).count() == 0


def test_archives(spark):
    schema = "page_id long, url string, html string, sha1 string, first string"
    rows = [
        (3, "http://x/\r\nWARC-Type: evil", "same", "s", "f"), (1, None, "same", "s", "f"), (2, "u", None, "s", "f"),
        (5, "u", "", "s", "f"), (None, "u", "same", "s", "f"), (1, "u", "same", "s", "f"), (6, "u", "é" * 100_000, "s", "f"),
        (7, "u", "WARC/1.1\r\n\r\nP*M\x18\0\0\0\0", "s", "f"),
    ]
    path = fresh_dir(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(rows, schema), path)
    got = [(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.read_archives(spark, path).collect()]
    assert sorted(got, key=str) == sorted(
        [
            (3, "revisit", 1, 4), (1, "response", None, 4), (2, "response", None, 0), (5, "revisit", 2, 0),
            (None, "revisit", 1, 4), (1, "response", None, 4), (6, "response", None, 200_000), (7, "response", None, 20),
        ],
        key=str,
    )
    path = fresh_dir(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(rows, schema), path, min_payload=5)
    assert {r.record_type for r in warc.read_archives(spark, path).collect()} == {"response"}
    path = fresh_dir(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([], schema), path)
    assert warc.read_archives(spark, path).count() == 0
