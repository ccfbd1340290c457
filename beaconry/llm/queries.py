"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from beaconry.llm import ann, conversations, fingerprint, langid, linededup, packing, pieces, quality, setjoin, sharding, spelling, tokenfile, warc
from beaconry.llm.store import materialise

# Bytes of text that one shard may hold.
SHARD_BYTES = 16 << 20


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = quality.fit(docs, labels.where(~quality.held_out(F.col("doc_id"))))
    return quality.score(docs, model)


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return scored.select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.3).cast("int").alias("predicted"),
    )


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    read = warc.read_records(warc.write_archives(_table(spark, folder, "pages")), payloads=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = linededup.dedup_lines(_table(spark, folder, "documents"), report=True)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    read = tokenfile.read_token_files(tokenfile.write_token_files(_table(spark, folder, "documents"), path, end_id=2))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_vantage_trees(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return ann.search(ann.build_index(vectors), vectors.where("vec_id % 100 = 0"), k=10)


def op6_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    rows = fingerprint.compare_documents(_table(spark, folder, "documents"))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint.as_text(F.col("fingerprint")).alias("fingerprint"),
        fingerprint.as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next",
    )


def op7_extendible_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return sharding.read_shards(spark, sharding.write_shards(sharding.shard_documents(docs, SHARD_BYTES)), ["doc_id"])


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    coded = pieces.encode_pieces(_table(spark, folder, "documents").select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"), F.sha2("decoded", 256).alias("decoded_sha256"), "parity")


def op9_harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack_documents(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_chosen_path_join(spark: SparkSession, folder: str) -> DataFrame:
    return setjoin.similar_documents(_table(spark, folder, "documents"))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.damaged_and_repaired(_table(spark, folder, "conversations"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    words = spelling.vocabulary(_table(spark, folder, "documents"), misspell=True)
    return spelling.variants(materialise(words, "spelling-words"))


def op13_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    read = langid.predict(docs.select("doc_id", "text"), model)
    return read.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_quality, op2_warc, op3_line_dedup, op4_token_files, op5_vantage_trees, op6_fingerprints,
        op7_extendible_shards, op8_sentencepiece, op9_harmonic_packing, op10_chosen_path_join,
        op11_conversation_repair, op12_spelling_variants, op13_language_id, pipeline,
    )
}

_LINE_DEDUP = r"""
WITH numbered AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
  SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM numbered
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), owned AS (
  SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10 GROUP BY k
), judged AS (
  SELECT r, doc_id, line, pos, length(keyed.k) >= 10 AND doc_id <> owner AS gone FROM keyed LEFT JOIN owned ON keyed.k = owned.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT coalesce(gone, false)), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id
"""


def shards_sql(limit: int) -> str:
    return f"""
WITH hashed AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents
), sums AS (
  SELECT d::INTEGER AS d, h >> (60 - d::INTEGER) AS p, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows
  FROM hashed, generate_series(0, 60) AS g(d) GROUP BY 1, 2
), best AS (
  SELECT hashed.doc_id, n_bytes, h, min(s.d) AS depth FROM hashed
  JOIN sums s ON s.p = h >> (60 - s.d) AND (s.shard_bytes <= {limit} OR s.shard_rows = 1) GROUP BY ALL
)
SELECT doc_id, CASE WHEN depth = 0 THEN '' ELSE right(lpad(bin(h >> (60 - depth)), 64, '0'), depth) END AS shard,
  depth AS shard_depth, n_bytes, shard_bytes, shard_rows
FROM best JOIN sums ON sums.d = depth AND sums.p = h >> (60 - depth)
"""


_WARC = """
SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM (
  SELECT page_id, html, digest, max(page_id) OVER (PARTITION BY digest) AS owner,
    array_to_string(['ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
      (1 + ((('0x' || substr(padded, (1 + (5 * i) // 4)::BIGINT, 3))::INTEGER >> (7 - (5 * i) % 4)::INTEGER) & 31))::INTEGER] FOR i IN range(32)], '') AS payload_digest
  FROM (SELECT *, sha1(coalesce(html, '')) AS digest, sha1(coalesce(html, '')) || '00' AS padded FROM pages)
)
"""


def _crc32(key: str) -> str:
    """Unsigned crc32 of a text, bit by bit."""
    byte = f"CASE WHEN i % 8 = 0 THEN ('0x' || substr(hex(encode({key})), (i // 4 + 1)::BIGINT, 2))::BIGINT ELSE 0 END"
    step = f"xor(xor(c, {byte}) >> 1, 3988292384 * (xor(c, {byte}) & 1))"
    return f"xor(list_reduce(generate_series(0::BIGINT, 8 * strlen({key}) - 1), lambda c, i: {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_CONVERSATIONS = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations
), marked AS (SELECT *, {_crc32("k")} % 20 AS fault FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM marked WHERE fault <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i, trim(text, {_SPACE}) AS bare FROM damaged
), judged AS (
  SELECT *, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
    left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed
), faults AS (
  SELECT *, NOT blank AND NOT duplicate AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated FROM judged
), inserts(s, w, c, t, said) AS (VALUES
  (0, '', 0, 0, []), (0, 'I', 5, 2, ['user:']), (0, 'II', 10, 3, ['user:', 'assistant:']), (1, '', 0, 1, []), (1, 'I', 5, 2, ['user:']),
  (1, 'II', 10, 3, ['user:', 'assistant:']), (2, '', 0, 2, []), (2, 'I', 5, 3, ['assistant:']), (3, '', 0, 3, []), (3, 'I', 5, 2, ['user:'])
), keeps(s, initial, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
renames(s, t, named) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
ways AS (
  SELECT conv_id, i, s.s, s.t, s.c + 2 AS c, s.w || 'D' AS w, s.said FROM faults, inserts s
  UNION ALL SELECT conv_id, i, s.s, k.t, s.c + 5 * truncated::INTEGER, s.w || 'K', list_append(s.said, role || ':' || text)
    FROM faults f, inserts s JOIN keeps k ON k.s = s.t WHERE NOT blank AND NOT duplicate AND k.initial = f.initial
  UNION ALL SELECT conv_id, i, s.s, r.t, s.c + 1 + 5 * truncated::INTEGER, s.w || 'R', list_append(s.said, named || ':' || text)
    FROM faults, inserts s JOIN renames r ON r.s = s.t WHERE NOT blank AND NOT duplicate
), best AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS said FROM faults
  UNION ALL
  SELECT conv_id, i, state, cost, audit, said FROM (
    SELECT b.conv_id, w.i, w.t AS state, b.cost + w.c AS cost, b.audit || w.w AS audit, list_concat(b.said, w.said) AS said,
      row_number() OVER (PARTITION BY b.conv_id, w.t ORDER BY b.cost + w.c, b.audit || w.w) AS nth
    FROM best b JOIN ways w ON w.conv_id IS NOT DISTINCT FROM b.conv_id AND w.i = b.i + 1 AND w.s = b.state
  ) WHERE nth = 1
), sizes AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
    count(*) FILTER (WHERE duplicate) AS duplicate, count(*) FILTER (WHERE truncated) AS truncated,
    count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id
), closings(state, c, w, said) AS (VALUES (0, 0, '', []), (1, 10, 'II', ['user:', 'assistant:']), (2, 5, 'I', ['assistant:']), (3, 0, '', [])),
done AS (
  SELECT b.conv_id, b.cost + c.c AS cost, b.audit || c.w AS audit, list_concat(b.said, c.said) AS said, z.* EXCLUDE (conv_id),
    row_number() OVER (PARTITION BY b.conv_id ORDER BY b.cost + c.c, b.audit || c.w) AS nth
  FROM best b JOIN sizes z ON z.conv_id IS NOT DISTINCT FROM b.conv_id AND z.n = b.i JOIN closings c USING (state)
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN (SELECT * FROM done WHERE nth = 1) d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
"""

_SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS d, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{{7,}}')) AS run
  FROM documents
), counted AS (SELECT d || ':' || run AS k, run, count(*) AS times FROM runs GROUP BY d, run),
hashed AS (SELECT run, times, {_crc32("k")} AS h FROM counted),
changed AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, times FROM hashed
), words AS (SELECT word, sum(times)::BIGINT AS n FROM changed WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
dels AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS d FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other FROM dels a JOIN dels b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word FROM words a JOIN dels b ON a.word = b.d
  UNION SELECT b.word, a.word FROM words a JOIN dels b ON a.word = b.d
), ranked AS (
  SELECT near.word, other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
    row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) AS nth
  FROM near JOIN words o ON o.word = other
), best AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form, CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN (SELECT * FROM ranked WHERE nth = 1) r ON r.word = w.word
), climbed AS (
  SELECT word, word AS top, 0 AS step FROM best
  UNION ALL SELECT c.word, b.form, step + 1 FROM climbed c JOIN best b ON b.word = c.top WHERE b.form IS NOT NULL
)
SELECT best.word, form, top AS root, n, n_near, form_n FROM best JOIN (SELECT word, arg_max(top, step) AS top FROM climbed GROUP BY word) c ON c.word = best.word
"""

ORACLE: dict[str, str] = {
    "op2_warc": _WARC, "op3_line_dedup": _LINE_DEDUP, "op7_extendible_shards": shards_sql(SHARD_BYTES),
    "op11_conversation_repair": _CONVERSATIONS, "op12_spelling_variants": _SPELLING,
}
