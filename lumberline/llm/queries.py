"""The registered queries of the operators, with their production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lumberline.datasets import read_table
from lumberline.llm import (
    conversation_repair,
    embedding_dedup,
    importance,
    line_dedup,
    mixing_lm,
    mixing_sources,
    packing,
    sentencepiece_codec,
    simhash,
    substring_dedup,
    topk,
    toxicity,
    warc,
)
from lumberline.llm.common import OWN, crc_mod

#: The tokenizers of packing and of encoding.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: The pages table has no time of capture.
CAPTURED = "2024-01-01T00:00:00Z"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten sources or more share."""
    found = line_dedup.drop_shared_lines(documents(spark, sf_dir))
    return found.select(
        "doc_id", F.col(OWN + "lines").alias("n_lines"), F.col(OWN + "removed").alias("n_removed"), "text"
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = documents(spark, sf_dir).select("doc_id", "text")
    found = substring_dedup.drop_repeated_passages(own)
    return found.select(
        "doc_id", F.col(OWN + "words").alias("n_words"), F.col(OWN + "removed").alias("n_removed"),
        F.sha2(F.col(OWN + "kept").cast("binary"), 256).alias("kept_sha256"),
    )


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(documents(spark, sf_dir))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return topk.top_k(rows, rows["vec_id"] % 20 == 0)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of all pages, with their blocks as text."""
    pages = read_table(spark, sf_dir, "pages")
    made = warc.derive(warc.responses(pages, "page_id", "url", "html", CAPTURED), keep="page_id")
    return made.withColumn("block", F.col("block").cast("string"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), WORD_BPE)


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_lm.score_documents(documents(spark, sf_dir))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select(
        "doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), F.col(OWN + "score").alias("score"),
        F.when(F.col(OWN + "score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every document, and whether they decode to its text."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    back = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, PIECE_MODEL), PIECE_MODEL)
    return back.select(
        "doc_id", F.col(OWN + "ids").alias("ids"), F.size(OWN + "ids").cast("long").alias("n_ids"),
        (F.coalesce("text", F.lit("")) == F.col(OWN + "decoded")).alias("round_trip"),
    )


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = importance.resample(docs, read_table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    names = {"n_features": "features", "weight": "weight", "score": "score", "rank": "rank"}
    return found.select("doc_id", *[F.col(OWN + own).alias(name) for name, own in names.items()])


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repair of every conversation after damage; one whose rows are all gone has nothing to repair."""
    rows = read_table(spark, sf_dir, "conversations")
    found = conversation_repair.repair_conversations(conversation_repair.damage(rows))
    keys = rows.select("conv_id", conversation_repair.key_of(F.col("conv_id")).alias("key")).distinct()
    all_of = keys.join(found.conversations, "key", "left").join(found.digests(), "key", "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return all_of.select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    found = mixing_sources.mix(docs, mixing_sources.repeating_weights(docs), keep=["doc_id"])
    size, copies = F.col(OWN + "size"), F.col(OWN + "copies")
    return found.select(
        "doc_id", size.alias("size"), F.col(OWN + "source_size").alias("source_size"), F.col(OWN + "target").alias("target"),
        (copies * size).alias("taken"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_substring_dedup, op3_embedding_dedup, op4_simhash, op5_topk, op6_warc,
        op7_packing, op8_lm_scoring, op9_toxicity, op10_sentencepiece, op11_importance,
        op12_conversation_repair, op13_source_mix,
    )
}


#: Lines end at a line feed; blanks around them don't count; a site is a source.
_LINE_DEDUP = f"""
WITH parts AS (
  SELECT doc_id, text, source, string_split(text, chr(10)) AS lines FROM documents),
lines AS (
  SELECT doc_id, source, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM parts),
plain AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS word FROM lines),
shared AS (
  SELECT word FROM plain WHERE word <> '' GROUP BY word HAVING count(DISTINCT source) >= {line_dedup.MIN_SITES}),
kept AS (
  SELECT doc_id, count(*) AS n_lines, count(s.word) AS n_removed,
         string_agg(line, chr(10) ORDER BY place) FILTER (WHERE s.word IS NULL) AS rest
  FROM plain LEFT JOIN shared s ON plain.word = s.word GROUP BY doc_id)
SELECT p.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN n_removed > 0 THEN coalesce(rest, '') ELSE p.text END AS text
FROM parts p LEFT JOIN kept k ON p.doc_id = k.doc_id"""

_WORDS = r"[^\x20\x09-\x0D]+"
_SUBSTRING_DEDUP = f"""
WITH parts AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '{_WORDS}'), []) AS words FROM documents),
words AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS place, len(words) AS n_words FROM parts),
windows AS (
  SELECT doc_id, place, word,
         CASE WHEN place + {substring_dedup.WINDOW} <= n_words THEN string_agg(word, ' ') OVER (
           PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND {substring_dedup.WINDOW - 1} FOLLOWING) END AS passage
  FROM words),
again AS (
  SELECT doc_id, place, word, passage IS NOT NULL
         AND row_number() OVER (PARTITION BY passage ORDER BY doc_id, place) > 1 AS repeated FROM windows),
judged AS (
  SELECT doc_id, place, word, bool_or(repeated) OVER (
    PARTITION BY doc_id ORDER BY place ROWS BETWEEN {substring_dedup.WINDOW - 1} PRECEDING AND CURRENT ROW) AS gone
  FROM again),
kept AS (
  SELECT doc_id, count(*) AS n_words, count_if(gone)::BIGINT AS n_removed,
         string_agg(word, ' ' ORDER BY place) FILTER (WHERE NOT gone) AS rest
  FROM judged GROUP BY doc_id)
SELECT p.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(rest, '')) AS kept_sha256
FROM parts p LEFT JOIN kept k ON p.doc_id = k.doc_id"""

#: Vectors that take part: none is null, no component is null or not finite.
_VECTORS = """
WITH vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)"""
_TOPK = f"""{_VECTORS},
whole AS (SELECT vec_id, [floor({topk.SCALE} * x) FOR x IN v] AS v FROM vectors),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
         vec_id, score
  FROM scored)
SELECT * FROM ranked WHERE rank <= {topk.K}"""

#: crc32 of the UTF-8 bytes of ``word``; its table follows from the polynomial.
_CRC_TABLE = """
crc_steps AS (
  SELECT i AS n, i::BIGINT AS c, 0 AS step FROM range(256) t(i)
  UNION ALL
  SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM crc_steps WHERE step < 8),
crc_table AS (SELECT list(c ORDER BY n) AS crc FROM crc_steps WHERE step = 8)"""
_CRC = """xor(list_reduce(
    [('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT FOR i IN range(length(hex(encode(word))) // 2)],
    lambda c, b: xor(c >> 8, crc[xor(c & 255, b) + 1]), 4294967295::BIGINT), 4294967295)"""
#: With runs of one word a text's features are its words; lines don't matter.
_IMPORTANCE_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_IMPORTANCE = f"""
WITH RECURSIVE {_CRC_TABLE},
docs AS (
  SELECT row_number() OVER () AS row, doc_id,
         coalesce(regexp_extract_all({_LOWER}, '{_IMPORTANCE_WORDS}'), []) AS words FROM documents),
own AS (SELECT row, unnest(words) AS word FROM docs),
wanted AS (SELECT unnest(regexp_extract_all({_LOWER}, '{_IMPORTANCE_WORDS}')) AS word FROM benchmark),
bucket_of AS (
  SELECT word, {_CRC} % {importance.BUCKETS} AS bucket
  FROM (SELECT word FROM own UNION SELECT word FROM wanted), crc_table),
s AS (SELECT bucket, count(*) AS n FROM own JOIN bucket_of USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM wanted JOIN bucket_of USING (word) GROUP BY bucket),
sums AS (SELECT (SELECT count(*) FROM own) AS s, (SELECT count(*) FROM wanted) AS t),
gains AS (
  SELECT s.bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1) * (sums.s + {importance.BUCKETS}))::DOUBLE
                                   / ((s.n + 1) * (sums.t + {importance.BUCKETS}))::DOUBLE))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket), sums),
weighed AS (
  SELECT row, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM own JOIN bucket_of USING (word) JOIN gains USING (bucket) GROUP BY row),
scored AS (
  SELECT row, doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
         + floor(-1000 * ln(-ln((('0x' || substr(sha256(concat('{importance.SEED}:', doc_id)), 1, 8))::UBIGINT + 0.5::DOUBLE)
                                / 4294967296)))::BIGINT AS score
  FROM docs LEFT JOIN weighed USING (row)),
ranked AS (
  SELECT row, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
  FROM scored WHERE n_features >= {importance.LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {importance.PERCENT} * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (row)"""

#: Sources in the order in which they reach their limits; the first ones stay there, the others share the rest.
_SOURCE_MIX = f"""
WITH sized AS (
  SELECT doc_id, text, source, coalesce(len(regexp_extract_all(text, '{_WORDS}')), 0)::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS size FROM sized GROUP BY source),
weights AS (SELECT source, size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM sources),
filled AS (
  SELECT *, row_number() OVER steps AS k, coalesce(sum({mixing_sources.MOST} * size) OVER before, 0)::DOUBLE AS cut,
         sum(w) OVER ()::DOUBLE - coalesce(sum(w) OVER before, 0)::DOUBLE AS free, sum(size) OVER ()::DOUBLE AS total
  FROM weights
  WINDOW steps AS (ORDER BY size::DOUBLE / w, source NULLS LAST),
         before AS (ORDER BY size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT total - cut AS left_over, free AS shared FROM filled WHERE (total - cut) * w / free <= {mixing_sources.MOST} * size ORDER BY k LIMIT 1),
targets AS (
  SELECT source, size, least(left_over * w / shared, ({mixing_sources.MOST} * size)::DOUBLE) AS target,
         ('0x' || substr(sha256(concat('{mixing_sources.SEED}:', source)), 1, 8))::UBIGINT::DOUBLE / 4294967296 AS start
  FROM filled, level),
placed AS (
  SELECT doc_id, s.size, t.size AS source_size, target, start, CASE WHEN t.size > 0 THEN target / t.size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY s.source ORDER BY s.size, doc_id, text) AS place
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, ((floor(place * rate + start) - floor((place - 1) * rate + start)) * size)::BIGINT AS taken
FROM placed"""

#: The cheapest edits row by row, by the initial that the output so far ends in; at most two turns are inserted between rows.
_REPAIR = f"""
WITH RECURSIVE {_CRC_TABLE},
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS word FROM conversations),
faults AS (SELECT *, {_CRC} % 20 AS fault FROM keyed, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE fault WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM faults WHERE fault <> 0),
placed AS (
  SELECT *, regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS ended, substr(role, 1, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
judged AS (
  SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before,
         CASE WHEN ended = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN ended[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS kind
  FROM placed),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count_if(kind = 'blank')::BIGINT AS blank, count_if(kind = 'duplicate')::BIGINT AS duplicate,
         count_if(kind = 'truncated')::BIGINT AS truncated,
         count_if(i > 1 AND before || initial NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal
  FROM judged GROUP BY conv_id),
inserted(p, q, more, edit, said) AS (
  VALUES ('', '', 0, '', []::VARCHAR[]), ('', 'u', 5, 'I', ['user:']), ('', 'a', 10, 'II', ['user:', 'assistant:']),
         ('s', 's', 0, '', []), ('s', 'u', 5, 'I', ['user:']), ('s', 'a', 10, 'II', ['user:', 'assistant:']),
         ('u', 'u', 0, '', []), ('u', 'a', 5, 'I', ['assistant:']),
         ('a', 'a', 0, '', []), ('a', 'u', 5, 'I', ['user:'])),
best AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, '' AS state, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS said FROM judged
  UNION ALL
  SELECT conv_id, i, state, m.cost, m.audit, m.said FROM (
    SELECT conv_id, i, way.state AS state,
           min({{'cost': cost + way.cost, 'audit': audit || way.edit, 'said': list_concat(said, way.said)}}) AS m
    FROM (
      SELECT r.conv_id, r.i, b.cost + n.more AS cost, b.audit || n.edit AS audit, list_concat(b.said, n.said) AS said,
             unnest([
               {{'ok': true, 'state': n.q, 'cost': 2, 'edit': 'D', 'said': []::VARCHAR[]}},
               {{'ok': stays AND r.initial <> '' AND contains(may, r.initial), 'state': r.initial, 'cost': cut, 'edit': 'K',
                 'said': [r.role || ':' || r.text]}},
               {{'ok': stays AND contains(may, 'u'), 'state': 'u', 'cost': 1 + cut, 'edit': 'R', 'said': ['user:' || r.text]}},
               {{'ok': stays AND contains(may, 'a'), 'state': 'a', 'cost': 1 + cut, 'edit': 'R', 'said': ['assistant:' || r.text]}}
             ]) AS way
      FROM best b JOIN inserted n ON b.state = n.p
      JOIN (SELECT *, kind IN ('fine', 'truncated') AS stays, CASE kind WHEN 'truncated' THEN 5 ELSE 0 END AS cut FROM judged) r
        ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1
      JOIN (VALUES ('', 'su'), ('s', 'u'), ('u', 'a'), ('a', 'u')) f(state, may) ON f.state = n.q)
    WHERE way.ok GROUP BY conv_id, i, way.state)),
ended AS (
  SELECT b.conv_id, min({{'cost': cost + more, 'audit': audit || edit, 'said': list_concat(b.said, n.said)}}) AS m
  FROM best b JOIN inserted n ON b.state = n.p
  WHERE n.q IN ('', 'a') AND b.i = (SELECT max(i) FROM judged j WHERE j.conv_id IS NOT DISTINCT FROM b.conv_id)
  GROUP BY b.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(m.cost, 0)::BIGINT AS cost,
       coalesce(m.audit, '') AS audit, sha256(coalesce(array_to_string(m.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id"""

#: Links and components, packing, trained models, 64-bit hashes of shingles and the tokenizer are beyond SQL.
ORACLE: dict[str, str] = {
    "op1_line_dedup": _LINE_DEDUP,
    "op2_substring_dedup": _SUBSTRING_DEDUP,
    "op5_topk": _TOPK,
    "op11_importance": _IMPORTANCE,
    "op12_conversation_repair": _REPAIR,
    "op13_source_mix": _SOURCE_MIX,
}
