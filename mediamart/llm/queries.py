"""The operators on the given tables with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediamart.llm import chat, decontaminate, exact, near, packing, pii, quality, sharding, token_counts, toxicity, vector_queries, warc
from mediamart.llm.common import table


def fold(of: int) -> Column:
    """crc32 of the id as text, modulo ``of``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % of


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.assign(table(spark, sf_dir, "documents"), hash_all=True).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256")
    )


OP1_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learn = labels.filter(fold(5) != 0).select("doc_id", F.col("quality").alias("label"))
    held = F.coalesce(fold(5) == 0, F.lit(False))
    return quality.score(docs, learn).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.group(table(spark, sf_dir, "documents")).drop("row_key")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    counts = [
        F.size(F.filter(F.col("base.kind"), pii.same(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
        pii.written(F.concat("base", "terms")).alias("spans"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as flat files of 16-bit ids, counted from the files alone.  ``file`` is the number of
    the part file."""
    import public_tokenizers

    folder = token_counts.write_flat(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    found = token_counts.counts(token_counts.blocks(spark, folder, 2), 2, 2)
    return found.withColumn("file", F.regexp_extract("file", "part-([0-9]+)", 1).cast("int"))


#: Tools of the derived calls, and what each lets through.
TOOLS = {
    "search": {
        "type": "object",
        "properties": {"query": {"type": "string", "minLength": 1, "maxLength": 1500}, "size": {"type": "integer", "maximum": 4000}},
        "required": ["query", "size"],
        "additionalProperties": False,
    },
    "count": {"type": "object", "properties": {"query": {"type": "string"}, "size": {"type": "integer", "minimum": 40}}, "required": ["query"]},
    "note": {"type": "object", "properties": {"query": {"type": "string"}}, "additionalProperties": False},
}


def tool_messages(conversations: DataFrame) -> DataFrame:
    """Conversations as tool use: each assistant turn calls a tool with its text and needs the result of the call
    before; a user turn is the result of the turn before, in every eleventh conversation of the turn after."""
    conv, turn = F.col("conv_id"), F.col("turn")
    name = lambda t: F.concat(conv.cast("string"), F.lit("-"), t.cast("string"))
    text = F.coalesce("text", F.lit(""))
    arguments = F.to_json(F.struct(F.length(text).alias("size"), text.alias("query")))
    broken = (conv + turn) % 17 == 0
    call = F.struct(
        name(turn).alias("id"),
        F.element_at(F.array(*map(F.lit, TOOLS)), (turn % 3 + 1).cast("int")).alias("name"),
        F.when(broken, F.concat(arguments, F.lit(" and"))).otherwise(arguments).alias("arguments"),
        F.when(turn >= 2, F.array(name(turn - 2))).otherwise(F.array().cast("array<string>")).alias("needs"),
    )
    answered = F.when(conv % 11 == 0, name(turn + 1)).when(turn >= 1, name(turn - 1))
    return conversations.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.when(F.col("role") == "assistant", F.array(call)).otherwise(F.array().cast(f"array<{chat.CALL}>")).alias("calls"),
        F.when(F.col("role") == "user", answered).alias("result_of"),
    )


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = chat.link(tool_messages(table(spark, sf_dir, "conversations")), TOOLS)
    return chat.transcripts(linked).select(
        "conv_id", "position", "turn", "kind", "call_id", "link", "cyclic", "valid", "fault", "json"
    )


def captures(pages: DataFrame) -> DataFrame:
    """Pages as captures: each page is a full response, and its URL is visited again 100 to 149 ticks
    later with the ETag of the page as it was; every tenth answer carries another one."""
    digest = F.sha2(F.coalesce("html", F.lit("")), 256)
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"'))
    hour = F.date_format(F.timestamp_seconds(F.col("page_id") * 60), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    first = F.struct(
        (F.col("page_id") * 2).alias("record_id"),
        (F.col("page_id") * 2).alias("time"),
        F.lit("response").alias("kind"),
        F.create_map(
            F.lit("ETag"), tag, F.lit("Content-Type"), F.lit("text/html"), F.lit("Cache-Control"), F.lit("max-age=60"),
            F.lit("Date"), hour,
        ).alias("headers"),
        digest.alias("payload_digest"),
    )
    again = F.struct(
        (F.col("page_id") * 2 + 1).alias("record_id"),
        ((F.col("page_id") + 100 + F.col("page_id") % 50) * 2 + 1).alias("time"),
        F.lit("revisit").alias("kind"),
        F.create_map(
            F.lit("ETag"), F.when(F.col("page_id") % 10 == 0, F.concat(F.lit("W/"), F.reverse(tag))).otherwise(F.concat(F.lit("W/"), tag)),
            F.lit("Content-Type"), F.lit("text/plain"), F.lit("Cache-Control"), F.lit("max-age=600"),
        ).alias("headers"),
        F.lit(None).cast("string").alias("payload_digest"),
    )
    return pages.select("url", F.explode(F.array(first, again)).alias("capture")).select("url", "capture.*")


def op8_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolve(captures(table(spark, sf_dir, "pages")), window=4_096)
    names = F.array_sort(F.map_keys("headers"))
    line = F.array_join(F.transform(names, lambda k: F.concat(k, F.lit("="), F.col("headers")[k])), ";")
    return found.select("record_id", "url_key", "response_id", "outcome", line.alias("headers"), "payload_digest")


OP8_SQL = r"""
WITH parts AS (
  SELECT page_id, sha256(coalesce(html, '')) AS digest,
         regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare
  FROM pages
), keyed AS (
  SELECT page_id, digest,
         regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^www[0-9]*\.|:(80|443)$', '', 'g')
         || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '')
         || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS url_key
  FROM (SELECT *, list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
          lambda p: p <> '' AND NOT regexp_matches(p, '(?i)^(utm_[a-z]+|ref|fbclid|gclid|sessionid|phpsessid)(=|$)'))) AS kept
        FROM parts)
), responses AS (
  SELECT page_id * 2 AS record_id, page_id * 2 AS time, url_key, digest,
         '"' || left(digest, 16) || '"' AS tag,
         strftime(make_timestamp(page_id * 60000000), '%Y-%m-%dT%H:%M:%SZ') AS date
  FROM keyed
), revisits AS (
  SELECT page_id * 2 + 1 AS record_id, (page_id + 100 + page_id % 50) * 2 + 1 AS time, url_key,
         'W/' || CASE WHEN page_id % 10 = 0 THEN reverse('"' || left(digest, 16) || '"')
                      ELSE '"' || left(digest, 16) || '"' END AS tag
  FROM keyed
), matched AS (
  SELECT v.record_id, v.url_key, r.record_id AS response_id, v.tag AS new_tag, r.tag, r.digest, r.date
  FROM revisits v ASOF LEFT JOIN responses r ON v.url_key = r.url_key AND v.time >= r.time
)
SELECT record_id, url_key, response_id,
       CASE WHEN response_id IS NULL THEN 'missing' WHEN 'W/' || tag = new_tag THEN 'resolved' ELSE 'changed' END AS outcome,
       CASE WHEN 'W/' || tag = new_tag
            THEN 'cache-control=max-age=600;content-type=text/html;date=' || date || ';etag=' || new_tag END AS headers,
       CASE WHEN 'W/' || tag = new_tag THEN digest END AS payload_digest
FROM matched
"""


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(fold(3) != 1).select("doc_id", F.col("toxic").alias("label")))
    held = F.coalesce(fold(3) == 1, F.lit(False))
    return docs.select("doc_id", held.alias("held_out"), toxicity.scored(model).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.7).cast("int")
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("row_key")


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``rows``: shard sizes at most one row apart."""
    text = F.coalesce("text", F.lit(""))
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_quality": op2_quality,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_packing": op4_packing,
    "op5_personal_data": op5_personal_data,
    "op6_token_counts": op6_token_counts,
    "op7_tool_calls": op7_tool_calls,
    "op8_revisits": op8_revisits,
    "op9_toxicity": op9_toxicity,
    "op10_decontamination": op10_decontamination,
    "op12_sharding": op12_sharding,
    **vector_queries.QUERIES,
}

ORACLES = {"op1_exact_dedup": OP1_SQL, "op8_revisits": OP8_SQL, **vector_queries.ORACLES}
