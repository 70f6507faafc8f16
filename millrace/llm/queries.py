"""The operators as queries over the given tables, and SQL for those that have it."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import alignment, chat, decontaminate, pieces, prefix_trie, quality, sharding, simhash, token_files, toxicity, urls, vectors, wrappers
from millrace.llm.shared import held_out

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

WORD_TOKENIZER, BYTE_TOKENIZER, PIECES = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"
END = 1
#: From here on a text counts as toxic; as good.
TOXIC_FROM, GOOD_FROM = 0.5, 0.3
RULES = (
    urls.Rule("com", "/", "allow"),
    urls.Rule("example.com", "/en/", "block"),
    urls.Rule("www.example.com", "/en/", "allow"),
    urls.Rule("net", "/es/", "block"),
    urls.Rule("net", "/fr/", "block"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_token_files(spark, sf_dir):
    path = public_tokenizers.path(WORD_TOKENIZER)
    return token_files.digests(token_files.write_token_files(table(spark, sf_dir, "documents"), path, END))


@query
def op2_decontamination(spark, sf_dir):
    """The benchmark items in each document that holds any."""
    found = decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("containment", F.round(F.col("shared") / F.col("size"), 6))


@query
def op3_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, distance=4)


@query
def op4_url_filter(spark, sf_dir):
    return urls.judge_urls(table(spark, sf_dir, "pages"), RULES)


def _scored(documents: DataFrame, score: Column, least: float) -> DataFrame:
    rows = documents.select("doc_id", held_out().alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= least).cast("int"))


@query
def op5_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    return _scored(documents, model.score(F.col("text")), TOXIC_FROM)


@query
def op6_quality(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    model = quality.fit(documents, table(spark, sf_dir, "labels"))
    return _scored(documents, model.score(F.col("text")), GOOD_FROM)


@query
def op7_sharding(spark, sf_dir):
    return sharding.assign_shards(table(spark, sf_dir, "documents"), shards=24)


@query
def op8_near_vectors(spark, sf_dir):
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.93)


@query
def op9_perspectives(spark, sf_dir):
    """The rendered dialogues as their digests, and the masks as text."""
    rows = chat.perspectives(table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string")))
    return rows.select(
        "conv_id",
        "perspective",
        "part",
        "n_turns",
        F.length("rendered").cast("long").alias("n_chars"),
        F.md5(F.col("rendered").cast("binary")).alias("rendered_md5"),
        F.array_join(spans, ",").alias("mask"),
    )


@query
def op10_pieces(spark, sf_dir):
    rows = pieces.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select("doc_id", "n_ids", F.crc32(joined.cast("binary")).alias("ids_crc32"), "round_trip")


@query
def op11_alignment(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    files = public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.path(PIECES)
    return alignment.align_corpus(documents, *files).documents


@query
def op12_prefix_trie(spark, sf_dir):
    turns = prefix_trie.digested(table(spark, sf_dir, "conversations"))
    trie = prefix_trie.prefix_trie(prefix_trie.with_shared_beginnings(turns, every=5, most=9))
    nodes = trie.nodes.join(prefix_trie.end_digests(trie.ends), prefix_trie.KEY, "left")
    none = F.sha2(F.lit("").cast("binary"), 256)
    return nodes.withColumn("ends_sha256", F.coalesce("ends_sha256", none)).drop(*prefix_trie.KEY)


@query
def op13_main_text(spark, sf_dir):
    return wrappers.main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


ORACLES["op2_decontamination"] = r"""
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') FROM benchmark
), shingles AS (
  SELECT DISTINCT kind, id, array_to_string(w[i : i + 4], ' ') AS s
  FROM words, unnest(range(1, len(w) - 3)) AS t(i)
), sizes AS (SELECT id AS item_id, count(*) AS size FROM shingles WHERE kind = 'b' GROUP BY ALL)
SELECT d.id AS doc_id, b.id AS item_id, CAST(count(*) AS INTEGER) AS shared,
       CAST(any_value(size) AS INTEGER) AS size, round(count(*) / any_value(size), 6) AS containment
FROM shingles d JOIN shingles b ON d.kind = 'd' AND b.kind = 'b' AND d.s = b.s
JOIN sizes ON sizes.item_id = b.id
GROUP BY ALL HAVING count(*) * 1000 >= any_value(size) * 800
"""

ORACLES["op8_near_vectors"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), usable AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS u, b.vec_id AS v FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
   AND list_cosine_similarity(a.e, b.e) >= 0.93
), reach(u, v) AS (
  SELECT u, v FROM links
  UNION
  SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u
), least AS (SELECT u, min(v) AS m FROM reach GROUP BY u),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM v LEFT JOIN counts ON counts.u = vec_id LEFT JOIN least ON least.u = vec_id
"""

ORACLES["op9_perspectives"] = r"""
WITH turns AS (
  SELECT DISTINCT conv_id, turn,
    CASE WHEN coalesce(role, '') = '' THEN 'unknown' ELSE role END AS speaker,
    coalesce(text, '') AS text
  FROM conversations
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, speaker, text) - 1 AS place
  FROM turns
), people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker <> 'system'),
pieces AS (
  SELECT p.conv_id, q.perspective, place, CAST(floor(place / 64) AS BIGINT) AS part,
    speaker = perspective AS learn,
    CASE WHEN speaker = 'system' THEN '<|system|>' WHEN speaker = perspective THEN '<|assistant|>'
         ELSE '<|user|>' || speaker END || chr(10) AS head,
    text || CASE WHEN speaker = perspective THEN '<|end|>' ELSE '' END AS body,
    CASE WHEN speaker = perspective THEN chr(10) ELSE '<|end|>' || chr(10) END AS tail
  FROM placed p JOIN people q ON p.conv_id IS NOT DISTINCT FROM q.conv_id
), measured AS (
  SELECT *, coalesce(sum(length(head || body || tail)) OVER (
    PARTITION BY conv_id, perspective, part ORDER BY place
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + length(head) AS s
  FROM pieces
)
SELECT conv_id, perspective, part, count(*) AS n_turns,
  sum(length(head || body || tail))::BIGINT AS n_chars,
  md5(string_agg(head || body || tail, '' ORDER BY place)) AS rendered_md5,
  coalesce(string_agg(CASE WHEN learn THEN s || '-' || (s + length(body)) END, ',' ORDER BY place), '') AS mask
FROM measured GROUP BY conv_id, perspective, part
"""

ORACLES["op12_prefix_trie"] = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS own,
    list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda c, z: xor(c >> 1, 3988292384::BIGINT * (c & 1)))
    ) AS crc
  FROM turns GROUP BY conv_id
), hashed AS (SELECT *, xor(crc, 4294967295::BIGINT) % 9 AS h FROM convs),
rebuilt AS (
  SELECT c.conv_id, coalesce(l.own[1 : c.h], []) || c.own[c.h + 1 : ] AS path
  FROM hashed c LEFT JOIN hashed l ON l.conv_id = c.conv_id - c.conv_id % 5
), prefixes AS (
  SELECT conv_id, path[1 : d] AS prefix, d AS depth, len(path) = d AS ends
  FROM rebuilt, unnest(range(0, len(path) + 1)) AS t(d)
), nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM prefixes GROUP BY prefix, depth
), children AS (SELECT prefix[1 : depth - 1] AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
complete AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children,
    CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * octet_length(encode(prefix[depth].text)) END AS saved
  FROM nodes LEFT JOIN children USING (prefix)
), sums AS (
  SELECT prefix[1 : d] AS prefix, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS leaves, sum(saved) AS saved_sum
  FROM complete, unnest(range(0, depth + 1)) AS t(d) GROUP BY ALL
)
SELECT c.conv_id, c.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children,
  leaves::BIGINT AS n_leaves, saved_sum::BIGINT AS saved_tokens, c.ends_sha256
FROM complete c JOIN sums USING (prefix)
LEFT JOIN complete p ON c.depth > 0 AND p.prefix = c.prefix[1 : c.depth - 1]
"""
