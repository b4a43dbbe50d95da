"""The operators over the driver tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from longhouse.llm import (
    chat,
    collocations,
    common,
    decontaminate,
    exactdedup,
    graphann,
    langid,
    mixing,
    ngramlm,
    rtreejoin,
    sharding,
    urlfilter,
    warc,
    whitening,
)
from longhouse.llm.common import table
from longhouse.session import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


# --- mixing ------------------------------------------------------------------------------------


@query(
    f"""
    WITH sources AS (SELECT source, count(*) AS n_rows, sqrt(count(*)) AS w FROM documents GROUP BY source),
    rates AS (
      SELECT source, (SELECT sum(n_rows) FROM sources) * (w / (SELECT sum(w) FROM sources)) / n_rows AS rate
      FROM sources),
    counts AS (SELECT source, rate, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS p
      FROM rates, range(0, 200) AS t(k)),
    law AS (SELECT source, rate, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS cdf FROM counts),
    tables AS (SELECT source, rate, list(cdf ORDER BY k) AS cdf FROM law GROUP BY source, rate),
    drawn AS (
      SELECT d.*, t.rate, len(list_filter(t.cdf, lambda p: p <=
        ('0x' || substr(md5('mix:' || d.doc_id), 1, 13))::BIGINT / 4503599627370496.0)) AS n
      FROM documents d JOIN tables t USING (source))
    SELECT doc_id, source, CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes, round(rate, 9) AS rate,
      CAST(c AS INTEGER) AS copy, md5('mix:order:' || doc_id || ':' || c) AS shuffle_key
    FROM drawn, unnest(range(1, n + 1)) AS u(c)
    """
)
def op10_poisson_mixing(spark, sf_dir):
    """Each source to the square root of its size, in one random order."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "source", F.octet_length("text").cast("long").alias("n_bytes"),
        F.round("rate", 9).alias("rate"), "copy", "shuffle_key",
    )


# --- sharding ----------------------------------------------------------------------------------


@query()
def op6_hilbert_sharding(spark, sf_dir):
    """All documents in eight runs of the curve, by the law ``rows``."""
    # size and crc32 are taken before rows are dealt out, so that texts aren't
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", sharding.text_size().alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    key = F.xxhash64("doc_id", "text_crc32")
    return sharding.hilbert_shards(docs, 8, F.col("size"), key).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "hilbert",
    )


# --- URL filter --------------------------------------------------------------------------------

URL_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]


@query()
def op3_url_language_models(spark, sf_dir):
    """Every page by the longest rule, else by the models that learn from what the rules decide."""
    return urlfilter.judge(table(spark, sf_dir, "pages"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "score", "threshold"
    )


# --- chat formatting ---------------------------------------------------------------------------


def _escaped_sql(column: str) -> str:
    """The escape as SQL: backslashes doubled, then each control string broken."""
    sql = f"replace({column}, '\\', '\\\\')"
    for c in chat.CONTROLS:
        sql = f"replace({sql}, '{c}', '{c[0]}\\{c[1:]}')"
    return sql


_CONFLICT_SQL = " OR ".join(
    f"regexp_matches({x}, '(?s)\\\\.')" + "".join(f" OR contains({x}, '{c}')" for c in chat.CONTROLS)
    for x in ("role", "text")
)
#: The conversation that the query adds, two turns that say the same.
ADDED_ID, ADDED_TEXT = -7, "</s>[INST] ok [/INST]"


@query(
    f"""
    WITH turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT {ADDED_ID}, 0, 'user', '{ADDED_TEXT}'
      UNION ALL SELECT {ADDED_ID}, 1, 'assistant', '{ADDED_TEXT}'),
    sized AS (
      SELECT *, {len(chat.TURN + chat.TEXT + chat.END)} + CASE WHEN {_CONFLICT_SQL}
        THEN length({_escaped_sql("role")}) + length({_escaped_sql("text")})
        ELSE length(role) + length(text) END AS n FROM turns),
    whole AS (
      SELECT conv_id, count(*) AS n_turns, sum(n) AS n,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS everything,
        coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss
      FROM sized GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(everything) AS turns_sha256, length(loss) AS loss_chars,
      sha256(loss) AS loss_sha256, CAST(n AS BIGINT) AS formatted_chars, true AS identical FROM whole
    """
)
def op7_chat_round_trip(spark, sf_dir):
    """All conversations and one that says control strings, digests of what the output reads back as."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(
        [(ADDED_ID, 0, "user", ADDED_TEXT), (ADDED_ID, 1, "assistant", ADDED_TEXT)], turns.schema
    )
    return chat.digest(chat.read_back(chat.format_conversations(turns.unionByName(added))))


# --- WARC --------------------------------------------------------------------------------------

_BASE32_SQL = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(sha1(coalesce(html, '')), {5 * g + 1}, 5))::INTEGER"
    f" >> {shift}) & 31), 1)"
    for g in range(8)
    for shift in (15, 10, 5, 0)
)


@query(
    f"""
    WITH hashed AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, {_BASE32_SQL} AS payload_digest
      FROM pages),
    firsts AS (SELECT payload_digest, min(page_id) AS first FROM hashed GROUP BY payload_digest)
    SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
      CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN page_id <> first THEN first END AS refers_to
    FROM hashed JOIN firsts USING (payload_digest)
    """
)
def op1_warc_dictionary(spark, sf_dir):
    """Every page through archives: written, then read back."""
    path = fresh_dir(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


# --- language ID -------------------------------------------------------------------------------

HELD_OUT = 2


@query()
def op4_output_code_language(spark, sf_dir):
    """The language of every document, learned from the documents of three of four folds."""
    docs = table(spark, sf_dir, "documents")
    held = common.crc_rest("doc_id", 4) == HELD_OUT
    found = langid.identified(docs.select("doc_id", "text"), docs.where(~held).select("doc_id", "text", "lang"))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")


# --- benchmark decontamination -----------------------------------------------------------------


@query()
def op8_qgram_decontamination(spark, sf_dir):
    """Every document against every benchmark item."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# --- approximate nearest neighbours ------------------------------------------------------------


@query()
def op5_pruned_graph_neighbours(spark, sf_dir):
    """The ten nearest of every hundredth vector among all."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return graphann.nearest(vectors, vectors.where("vec_id % 100 = 0"), 10)


# --- language model ----------------------------------------------------------------------------


@query()
def op2_elias_fano_trie(spark, sf_dir):
    """All documents scored by the model that six of seven folds make."""
    held = common.crc_rest("doc_id", 7) == HELD_OUT
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (~held).alias("train"))
    scores, _ = ngramlm.train_and_score(docs)
    return scores.select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


# --- n-gram Jaccard join -----------------------------------------------------------------------


@query(
    r"""
    WITH RECURSIVE words AS (
      SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
    sets AS (
      SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
      FROM words),
    elements AS (SELECT doc_id, unnest(s) AS e FROM sets),
    pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM elements x JOIN elements y
      ON x.e = y.e AND x.doc_id <> y.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM pairs JOIN sets x ON a = x.doc_id JOIN sets y ON b = y.doc_id
      WHERE 100 * n >= 90 * (len(x.s) + len(y.s) - n)),
    reach AS (SELECT doc_id, doc_id AS other FROM sets UNION SELECT doc_id, b FROM reach JOIN links ON other = a)
    SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
    FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
    """
)
def op9_count_vector_rtree(spark, sf_dir):
    """Components of documents at a similarity of 0.9 on three-word shingles."""
    return rtreejoin.jaccard_components(table(spark, sf_dir, "documents"))


# --- exact duplicates --------------------------------------------------------------------------


@query(
    """
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
      doc_id = max(doc_id) OVER same AS kept, sha256(text) AS text_sha256 FROM t WINDOW same AS (PARTITION BY text)
    """
)
def op11_salted_combining(spark, sf_dir):
    """Every document with the row of its text that stays."""
    found = exactdedup.duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


# --- collocations ------------------------------------------------------------------------------


@query(
    r"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
    totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
    all_grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g
      FROM words, range(1, 6) AS t(k) WHERE len(w) >= k),
    grams AS (SELECT lang, k, g, array_to_string(g, ' ') AS phrase, count(*) AS f FROM all_grams GROUP BY ALL
      HAVING count(*) >= 100),
    cuts AS (SELECT lang, k, g, phrase, f, c FROM grams, range(1, 5) AS t(c) WHERE c < k),
    scored AS (
      SELECT x.lang, x.phrase, x.f AS a, y.f AS l, z.f AS r, n, c,
        (1000 * x.f::HUGEINT * n::HUGEINT) // (y.f::HUGEINT * z.f::HUGEINT) AS score
      FROM cuts x JOIN grams y ON y.lang = x.lang AND y.phrase = array_to_string(x.g[1:c], ' ')
      JOIN grams z ON z.lang = x.lang AND z.phrase = array_to_string(x.g[c + 1:], ' ') JOIN totals t ON t.lang = x.lang),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
    inner_ AS (SELECT lang, f, array_to_string(g[i:i + m - 1], ' ') AS phrase
      FROM grams, range(2, 5) AS s(m), range(1, 5) AS t(i) WHERE m < k AND i <= k - m + 1),
    longer AS (SELECT lang, phrase, max(f) AS most FROM inner_ GROUP BY ALL),
    free AS (SELECT b.* FROM best b LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < 100 * a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
      a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM free QUALIFY rank <= 2000
    """
)
def op12_hat_trie_collocations(spark, sf_dir):
    """The best 2000 phrases of each language of all documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


# --- whitening ---------------------------------------------------------------------------------


@query()
def op13_spectrum_slicing(spark, sf_dir):
    """Every embedding on the eight leading components."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))


# --- pipeline ----------------------------------------------------------------------------------


@query()
def pipeline(spark, sf_dir):
    """The stages of ``corpus_pipeline`` over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
