"""Named queries of the corpus operators, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlens.llm import chat, fingerprints, jaccard, mixing, neighbours, packing, planes, repair, shards, tokens, toxicity, transducers, urls, whitening
from firmlens.session import scratch_path

RULES = [
    urls.Rule("net", "/", "block"), urls.Rule("example.net", "/en/", "allow"),
    urls.Rule("example.com", "/de/", "block"), urls.Rule("org", "/fr/", "allow"),
]
TEXT_TOKENIZER = "byte_bpe_50k.json"
COUNT_TOKENIZER = "word_bpe_49k.json"
LISTED_HOSTS = r"(^|\.)ads[.-]"  # the listed urls are those of pages on hosts with such a label


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Every page judged by the four rules, else by the list of advertising urls."""
    pages = _table(spark, folder, "pages")
    listed = pages.where(urls.host_of(F.col("url")).rlike(LISTED_HOSTS)).select("url")
    return urls.judge_urls(pages, RULES, listed).select("page_id", "host", "path", "rule", "verdict", "is_listed")


def op2_packed(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, each closed by id 2, packed into sequences of 1024 ids."""
    pieces = tokens.token_pieces(_table(spark, folder, "documents"), tokens.public_path(TEXT_TOKENIZER), 1024, 2)
    items = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(items, 1024)


def op3_byte_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in eight contiguous shards of nearly equal bytes."""
    return shards.byte_shards(_table(spark, folder, "documents"), 8)


def op4_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed to source weights 1, 2, 3, repeating, at most three epochs."""
    mixed = mixing.mix(_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every whole text and its edited text, with their likeness and that to the next document."""
    return fingerprints.fingerprints(_table(spark, folder, "documents"))


def op6_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors of every row whose id is divisible by 20."""
    return neighbours.search(_table(spark, folder, "embeddings"), 20, 20)


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every whole text, against a limit of 2048."""
    return transducers.count_tokens(_table(spark, folder, "documents"), tokens.public_path(COUNT_TOKENIZER), 2048)


def op8_id_planes(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of all documents written as bit planes and read back from the files."""
    files = planes.write_ids(_table(spark, folder, "documents"), scratch_path(spark, "ids"), tokens.public_path(TEXT_TOKENIZER), 0)
    return planes.read_ids(spark, files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document scored by compression distance; labels come from three quarters of the ids."""
    docs = _table(spark, folder, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, _table(spark, folder, "labels")))
    return scored.select("doc_id", F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", "predicted")


def op10_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles are similar to 0.9 at least."""
    return jaccard.similar_groups(_table(spark, folder, "documents"), 3, 90)


def op11_whitened(spark: SparkSession, folder: str) -> DataFrame:
    """Every embedding on the 16 leading components of the distinct integer vectors, whitened."""
    return whitening.whiten(_table(spark, folder, "embeddings"), 16).withColumn("deviation", F.col("deviation").cast("long"))


#: One conversation more, whose texts hold control strings of chat templates.
PLANTED_TEXT = r"\### Assistant: </turn> ok"


def op12_chat_examples(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one full of control strings, as prefix-target examples, judged by what the files hold."""
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role")
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role, F.lit(PLANTED_TEXT).alias("text"))
    return chat.digests(spark, chat.write_chat(rows.unionByName(planted), scratch_path(spark, "chat")))


def op13_repaired(spark: SparkSession, folder: str) -> DataFrame:
    """Faults and cheapest repairs of all conversations after the damage that their keys decide."""
    return repair.repair_damaged(_table(spark, folder, "conversations"))


_CANONICAL_SQL = r"""
  CASE WHEN contains(url, '://') THEN
    regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') ||
    CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END
  END"""

OP1_SQL = rf"""
WITH parts AS (
  SELECT page_id, url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path,
    list_sort(list_filter(string_split(coalesce(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), ''), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS params
  FROM pages
), keyed AS (
  SELECT *, {_CANONICAL_SQL} AS canonical_url FROM parts
), listed AS (
  SELECT DISTINCT canonical_url AS listed_url FROM keyed WHERE regexp_matches(host, '(^|\.)ads[.-]')
), ruled AS (
  SELECT k.*, l.listed_url IS NOT NULL AS is_listed, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
  END AS rule
  FROM keyed k LEFT JOIN listed l ON k.canonical_url = l.listed_url
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN is_listed THEN 'block' ELSE 'allow' END AS verdict, is_listed
FROM ruled
"""

# The level of the capped shares is found here by trying every source as the first one that is not capped.
OP4_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5('mix:' || doc_id::VARCHAR) AS k
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
), weighted AS (
  SELECT *, [1.0::DOUBLE, 2.0, 3.0][((row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1)::INT] AS w, 3.0::DOUBLE * source_size AS cap FROM totals
), levels AS (
  SELECT max(level) AS level FROM (
    SELECT a.source, ((SELECT sum(source_size) FROM totals) - coalesce(sum(b.cap) FILTER (b.cap / b.w < a.cap / a.w), 0)) / (sum(b.w) FILTER (b.cap / b.w >= a.cap / a.w)) AS level
    FROM weighted a, weighted b GROUP BY a.source, a.cap, a.w
  )
), targets AS (
  SELECT source, source_size, least(cap, w * level) AS target, floor(least(cap, w * level) + 0.5)::BIGINT AS budget FROM weighted, levels
), placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.budget,
    CASE WHEN t.source_size > 0 THEN t.budget // t.source_size ELSE 0 END AS epochs,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, budget - epochs * source_size - start)))::BIGINT AS taken FROM placed
"""

_ESCAPED = r"replace(replace(replace({}, '\', '\\'), '##', '#\#'), '</', '<\/')"
OP12_SQL = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, r, '{PLANTED_TEXT}' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
), sized AS (
  SELECT *, 4 + length(replace({_ESCAPED.format('role')}, ':', '\:')) + 2 + length({_ESCAPED.format('text')}) + 8 AS chars FROM rows
), placed AS (
  SELECT *, sum(chars) OVER same AS upto, row_number() OVER same AS place, role = 'assistant' AS trained
  FROM sized WINDOW same AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (trained), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (trained), '')) AS loss_sha256,
  (coalesce(sum(upto) FILTER (trained), 0) + CASE WHEN coalesce(max(place) FILTER (trained), 0) < max(place) THEN max(upto) ELSE 0 END)::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id
"""

QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_packed": op2_packed,
    "op3_byte_shards": op3_byte_shards,
    "op4_source_mix": op4_source_mix,
    "op5_fingerprints": op5_fingerprints,
    "op6_neighbours": op6_neighbours,
    "op7_token_counts": op7_token_counts,
    "op8_id_planes": op8_id_planes,
    "op9_toxicity": op9_toxicity,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_whitened": op11_whitened,
    "op12_chat_examples": op12_chat_examples,
    "op13_repaired": op13_repaired,
}
SQL_TEXTS = {"op1_url_filter": OP1_SQL, "op4_source_mix": OP4_SQL, "op12_chat_examples": OP12_SQL}
