"""The operators as queries on the provided tables, and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import new_folder, table
from orderloom.llm.conversation_repair import damaged, repair
from orderloom.llm.exact_dedup import exact_groups
from orderloom.llm.extraction import extract
from orderloom.llm.language import identify
from orderloom.llm.mixing import mix
from orderloom.llm.neighbours import nearest
from orderloom.llm.ngram_join import near_duplicates
from orderloom.llm.packing import pack
from orderloom.llm.ranked_search import search_ranked
from orderloom.llm.sentence_pieces import encode_texts
from orderloom.llm.substring_dedup import drop_repeats
from orderloom.llm.token_files import token_round_trip
from orderloom.llm.warc import archive_captures

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@register
def op1_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = archive_captures(table(spark, sf_dir, "pages"), new_folder(spark, "warc"))
    number = F.substring_index(F.col("capture_id"), ":", -1).try_cast("long")
    return captures.select(
        number.alias("page_id"), "payload_bytes", "payload_digest",
        F.col("response.type").alias("record_type"),
        F.substring_index("response.refers_to", ":", -1).try_cast("long").alias("refers_to"),
        F.col("request").isNotNull().alias("has_request"), F.size("metadata").alias("n_metadata"))


CHECKS["op1_warc_captures"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, encode(coalesce(html, '')) AS b FROM pages),
f AS (SELECT page_id, octet_length(b) AS n, sha256(h) AS d,
             min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND first_id <> page_id THEN first_id END AS refers_to,
       true AS has_request, CAST(1 AS INTEGER) AS n_metadata
FROM f
"""


@register
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_round_trip(table(spark, sf_dir, "documents"), new_folder(spark, "tokens"), WORD_BPE, spaced=False,
                            end_id=2)


@register
def op8_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", F.col("_copy").alias("copy"), F.col("_copies").alias("copies"),
                        F.round("_rate", 9).alias("rate"), F.col("_shuffle").alias("shuffle_key"))


# k copies where the Poisson distribution at the document's hash has k steps at or below it
POISSON_SQL = """
m AS (SELECT *, length(coalesce(text, '')) + 1 AS mass FROM {docs}),
s AS (SELECT source, sum(mass) AS mass, sqrt(sum(mass)) AS weight FROM m GROUP BY source),
r AS (SELECT source, (SELECT sum(mass) FROM s) * weight / (SELECT sum(weight) FROM s) / mass AS rate FROM s),
c AS (
  SELECT source, rate, 0 AS k, -rate AS ln_p, exp(-rate) AS total FROM r
  UNION ALL
  SELECT source, rate, k + 1, ln_p + ln(rate) - ln(k + 1), total + exp(ln_p + ln(rate) - ln(k + 1))
  FROM c WHERE k < ceil(rate + 12 * sqrt(rate) + 30)),
u AS (SELECT *, CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT)
             / 4503599627370496.0::DOUBLE AS at FROM m),
n AS (SELECT u.*, c.rate, c.copies FROM u JOIN (SELECT source, any_value(rate) AS rate, list(total) AS totals
      FROM c GROUP BY source) AS t ON t.source IS NOT DISTINCT FROM u.source,
      LATERAL (SELECT t.rate AS rate, len(list_filter(t.totals, lambda x: x <= u.at)) AS copies) AS c)
"""
CHECKS["op8_poisson_mix"] = "WITH RECURSIVE " + POISSON_SQL.format(docs="documents") + """
SELECT doc_id, source, CAST(copy AS INTEGER) AS copy, CAST(copies AS INTEGER) AS copies, round(rate, 9) AS rate,
       CAST('0x' || substr(md5('mix/order:' || doc_id || ':' || copy), 1, 13) AS BIGINT)
         / 4503599627370496.0::DOUBLE AS shuffle_key
FROM n, LATERAL (SELECT unnest(range(1, copies + 1)) AS copy) AS e
"""


@register
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"), keep="largest")


CHECKS["op9_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@register
def op10_concat_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), BYTE_BPE, spaced=True, end_id=0)


@register
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@register
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(table(spark, sf_dir, "documents"))


@register
def op7_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@register
def op5_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


@register
def op3_boosted_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


@register
def op11_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encode_texts(table(spark, sf_dir, "documents"), PIECE_BPE, end=2, decoded=True)
    written = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(written, 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@register
def op12_branch_and_bound_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations")), absent="dropped")


# a table of the best prefix per conversation, rows read and place in the pattern; places are 0 nothing yet, 1 after s,
# 2 after u, 3 after a
CHECKS["op12_branch_and_bound_repair"] = """
WITH RECURSIVE c AS (
  SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS conv, conv_id, turn, coalesce(role, ' ') AS role,
         coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
k AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''),
        lambda ch: ascii(ch)::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, z: xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295::BIGINT) % 20 AS kind FROM c),
d AS (SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS nth FROM k WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, nth) AS i,
             rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said FROM d),
r AS (SELECT conv, i, turn, role, text, left(role, 1) AS initial,
             CASE WHEN said = '' THEN 'blank'
                  WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'duplicate'
                  WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS fault FROM o),
n AS (SELECT conv, count(*) AS n, count(*) FILTER (fault = 'blank') AS blank,
             count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
             coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM r GROUP BY conv),
p AS (SELECT conv, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM (
        SELECT conv, lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial AS pair FROM r) GROUP BY conv),
m(place, put, lines, to_place) AS (VALUES
  (0, '', []::VARCHAR[], 0), (0, 'I', ['user:'], 2), (0, 'II', ['user:', 'assistant:'], 3),
  (1, '', [], 1), (1, 'I', ['user:'], 2), (1, 'II', ['user:', 'assistant:'], 3),
  (2, '', [], 2), (2, 'I', ['assistant:'], 3), (3, '', [], 3), (3, 'I', ['user:'], 2)),
s AS (
  SELECT DISTINCT conv, 0::BIGINT AS i, 0 AS place, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines FROM c
  UNION ALL
  SELECT conv, i, place, cost, audit, lines FROM (
    SELECT *, row_number() OVER (PARTITION BY conv, place ORDER BY cost, audit) AS best FROM (
      SELECT s.conv, s.i + 1 AS i, s.audit || m.put || e.edit AS audit,
             s.cost + 3 * length(m.put) + CASE e.edit WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
               + CASE WHEN e.edit <> 'D' AND fault = 'truncated' THEN 3 ELSE 0 END AS cost,
             CASE WHEN e.edit = 'D' THEN m.to_place WHEN e.edit = 'K' AND initial = 's' THEN 1
                  WHEN m.to_place = 2 THEN 3 ELSE 2 END AS place,
             s.lines || m.lines || CASE e.edit WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [role || ':' || text]
               ELSE [CASE WHEN m.to_place = 2 THEN 'assistant:' ELSE 'user:' END || text] END AS lines
      FROM s JOIN m USING (place) JOIN r ON r.conv = s.conv AND r.i = s.i + 1,
           (VALUES ('D'), ('K'), ('R')) AS e(edit)
      WHERE e.edit = 'D' OR fault NOT IN ('blank', 'duplicate') AND (e.edit = 'R' OR (initial = 's' AND m.to_place = 0)
            OR initial = CASE WHEN m.to_place = 2 THEN 'a' ELSE 'u' END)))
  WHERE best = 1),
f AS (SELECT s.conv, s.cost + 3 * length(m.put) AS cost, s.audit || m.put AS audit, s.lines || m.lines AS lines
      FROM s JOIN m USING (place) LEFT JOIN n ON n.conv = s.conv
      WHERE s.i = coalesce(n.n, 0) AND m.to_place IN (0, 3)
      QUALIFY row_number() OVER (PARTITION BY s.conv ORDER BY s.cost + 3 * length(m.put), s.audit || m.put) = 1)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit,
       sha256(array_to_string(lines, chr(10))) AS repaired_sha256
FROM (SELECT DISTINCT conv, conv_id FROM c) JOIN f USING (conv) LEFT JOIN n USING (conv) LEFT JOIN p USING (conv)
"""


@register
def op13_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


CHECKS["op13_block_max_search"] = r"""
WITH d AS (SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(lower_ascii, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
           FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                   AS lower_ascii FROM documents)),
held AS (SELECT doc, doc_id, len(terms) AS n, terms FROM d WHERE len(terms) > 0),
whole AS (SELECT count(*) AS total, sum(n)::BIGINT AS length FROM held),
tf AS (SELECT doc, doc_id, n, term, count(*) AS tf FROM (SELECT doc, doc_id, n, unnest(terms) AS term FROM held) AS u
       GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * total + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, whole),
items AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scored AS (SELECT item_id, doc, doc_id,
             sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * total) // length))))::BIGINT AS score
           FROM items JOIN w USING (term) JOIN tf USING (term), whole GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
           FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
