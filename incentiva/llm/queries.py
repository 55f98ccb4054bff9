"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat as _chat
from . import conversation_repair as _conversation_repair
from . import decontaminate as _decontaminate
from . import embedding_dedup as _embedding_dedup
from . import filter_audit as _filter_audit
from . import html_text as _html_text
from . import line_dedup as _line_dedup
from . import language as _language
from . import multiset_hash as _multiset_hash
from . import near_dup as _near_dup
from . import pieces as _pieces
from . import pii as _pii
from . import warc as _warc
from .common import Stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = _decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return _decontaminate.digest(found)


OP1_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + 9], ' ') AS pattern
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), lengths AS (
  SELECT DISTINCT k FROM windows
), doc_windows AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS pattern
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, lengths WHERE len(w) >= k)
), found AS (
  SELECT d.doc_id, d.i, d.k, w.item_id FROM doc_windows d JOIN windows w ON d.k = w.k AND d.pattern = w.pattern
), hit AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id
), item AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT words.doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit ON words.doc_id = hit.doc_id LEFT JOIN item ON words.doc_id = item.doc_id
"""

def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _html_text.extract_text(_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document, as digests; round_trip: decoding gave the document's text."""
    found = _pieces.encode(_table(spark, sf_dir, "documents"), _pieces.load_pieces(), ["doc_id"])
    return found.select("doc_id", F.posexplode("samples").alias("sample", "s")).select(
        "doc_id", "sample", F.size("s.ids").cast("long").alias("n_pieces"), F.xxhash64("s.ids").alias("ids_hash"),
        "s.log_prob", "s.log_inclusion", "s.round_trip")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pii.digest(_pii.find_spans(_table(spark, sf_dir, "documents")))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user")
                                  .otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return _chat.digest(_chat.render(_chat.fold(_chat.log_of(rows))))


OP5_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), control AS (
  SELECT unnest(['\', '<s>', '</s>', '<|', '<<SYS>>', '<</SYS>>', '[INST]', '[/INST]']) AS c
), sizes AS (
  SELECT turns.*, length(role) + length(text) + 23 + (
    SELECT sum((length(role) - length(replace(role, c, '')) + length(text) - length(replace(text, c, ''))) // length(c)) FROM control) AS size
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(7 + sum(size) AS BIGINT) AS formatted_chars
FROM sizes GROUP BY conv_id
"""


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{Stage(spark, 'warc-archive').root}/warc"
    _warc.write_warc(_table(spark, sf_dir, "pages"), path)
    found = _warc.read_warc(spark, path)
    return found.select(
        _warc.page_id(F.col("record_id")).cast("bigint").alias("page_id"), "payload_bytes", "payload_digest",
        F.col("warc_type").alias("record_type"), _warc.page_id(F.col("refers_to")).cast("bigint").alias("refers_to"))


_QUINTETS = " || ".join(f"substr(alphabet, CAST((v[{i + 1}] >> {5 * (3 - k)}) & 31 AS BIGINT) + 1, 1)" for i in range(8) for k in range(4))
OP8_SQL = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' AS alphabet FROM pages
), groups AS (
  SELECT h, max(page_id) AS first FROM p GROUP BY h
), v AS (
  SELECT p.*, first, [CAST('0x' || substr(p.h, 5 * i + 1, 5) AS BIGINT) FOR i IN range(8)] AS v
  FROM p JOIN groups ON p.h = groups.h
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_QUINTETS} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM v
"""


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return _line_dedup.dedup_lines(docs).select(
        "doc_id", "deleted_lines", F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


def op7_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _multiset_hash.edited_report(_table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a row without doc_id has no remainder: it is learned from
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", held_out)
    model = _language.fit(docs.where("not held_out"))
    return _language.identify(docs.select("doc_id", "held_out", "text"), model).select(
        "doc_id", "held_out", "found.lang_pred", "found.score",
        F.size("found.spans").cast("long").alias("n_spans"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _near_dup.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conversation_repair.report(_table(spark, sf_dir, "conversations"))


# One recursion step per row: for each state of the grammar the least (cost, audit, text) so far. To a user or assistant turn
# leads a row kept or given that role, after an inserted turn where one is missing.
def _least(*ways: str) -> str:
    return f"list_sort([{', '.join(ways)}])[1]"


def _way(state: str, cost: str, edits: str, text: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || {edits}, 't': {state}.t || {text}}}"


def _turn(states: list[str], through: list[str], role: str) -> str:
    initial, other = role[0], "assistant" if role == "user" else "user"
    cost = f"(CASE WHEN r.i = '{initial}' THEN 0 ELSE 1 END + CASE WHEN r.cut THEN 5 ELSE 0 END)"
    edit = f"CASE WHEN r.i = '{initial}' THEN 'K' ELSE 'R' END"
    line = f"(chr(10) || CASE WHEN r.i = '{initial}' THEN r.role ELSE '{role}' END || ':' || r.text)"
    return ", ".join([_way(s, cost, edit, line) for s in states]
                     + [_way(s, f"(5 + {cost})", f"('I' || {edit})", f"(chr(10) || '{other}:' || {line})") for s in through])


_NONE = "{'c': CAST(1000000000000 AS BIGINT), 'a': '', 't': ''}"
_DELETED = [_way(f"d.s{k}", "2", "'D'", "''") for k in range(4)]
OP11_SQL = rf"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations
), bits AS (
  SELECT list(list_reduce([i, i, i, i, i, i, i, i, i], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc_table
  FROM (SELECT unnest(range(256)) AS i)
), crc AS (
  SELECT raw.*, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(name) + 1), lambda j: ascii(name[j]))),
                    lambda c, b: xor(c >> 8, crc_table[CAST(xor(c & 255, b) AS BIGINT) + 1])), 4294967295) % 20 AS kind
  FROM raw, bits
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS again
  FROM crc WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), again) AS pos,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, again) > 1 AS seen,
         NOT regexp_matches(text, '[^ 	-
]') AS empty, regexp_matches(text, '[^.!? 	-
][ 	-
]*\z') AS open
  FROM damaged
), r AS (
  SELECT conv_id, turn, role, text, pos, left(role, 1) AS i, empty AS blank, seen AND NOT empty AS duplicate, open AND NOT empty AND NOT seen AS cut,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM placed
), stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (cut) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n
  FROM r GROUP BY conv_id
), d AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS pos, {{'c': CAST(0 AS BIGINT), 'a': '', 't': ''}} AS s0, {_NONE} AS s1, {_NONE} AS s2, {_NONE} AS s3 FROM stats
  UNION ALL
  SELECT d.conv_id, r.pos,
         {_DELETED[0]},
         CASE WHEN r.blank OR r.duplicate OR r.i <> 's' THEN {_DELETED[1]}
              ELSE {_least(_DELETED[1], _way("d.s0", "CASE WHEN r.cut THEN 5 ELSE 0 END", "'K'", "(chr(10) || r.role || ':' || r.text)"))} END,
         CASE WHEN r.blank OR r.duplicate THEN {_DELETED[2]} ELSE {_least(_DELETED[2], _turn(["d.s0", "d.s1", "d.s3"], ["d.s2"], "user"))} END,
         CASE WHEN r.blank OR r.duplicate THEN {_DELETED[3]} ELSE {_least(_DELETED[3], _turn(["d.s2"], ["d.s0", "d.s1", "d.s3"], "assistant"))} END
  FROM d JOIN r ON r.conv_id IS NOT DISTINCT FROM d.conv_id AND r.pos = d.pos + 1
), done AS (
  SELECT stats.*, {_least("d.s0", _way("d.s1", "10", "'II'", "(chr(10) || 'user:' || chr(10) || 'assistant:')"),
                          _way("d.s2", "5", "'I'", "(chr(10) || 'assistant:')"), "d.s3")} AS w
  FROM stats JOIN d ON d.conv_id IS NOT DISTINCT FROM stats.conv_id AND d.pos = stats.n
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(w.c, 0) AS cost, coalesce(w.a, '') AS audit, sha256(coalesce(substr(w.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH docs AS (
  SELECT coalesce(source, '') AS part, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents
), fails AS (
  SELECT part, doc_id, len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
  FROM docs
), said AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), masks AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS n,
         count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM fails LEFT JOIN said USING (doc_id) GROUP BY part, mask
), bits AS (
  SELECT unnest([0, 1, 2, 3, 4]) AS k
), orders AS (
  SELECT [p.k, q.k, r.k, s.k, t.k] AS o FROM bits p, bits q, bits r, bits s, bits t WHERE len(list_distinct([p.k, q.k, r.k, s.k, t.k])) = 5
), steps AS (
  SELECT array_to_string(list_transform(o, lambda k: 'ABCDE'[k + 1]), '') AS filter_order, step, 1 << o[step] AS own,
         CAST(coalesce(list_sum(list_transform(o[1:step - 1], lambda k: 1 << k)), 0) AS INT) AS prior
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), counted AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN mask & (prior | own) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & own > 0 AND mask & prior = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & own > 0 AND mask & prior > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & own > 0 AND mask & prior = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & own > 0 AND mask & prior = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM masks, steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _embedding_dedup.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


OP13_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e,
         len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS fit
  FROM embeddings
), links AS (
  SELECT a.r, b.r AS other FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
  WHERE a.fit AND b.fit AND list_cosine_similarity(a.e, b.e) >= 0.93
), reached AS (
  SELECT r, r AS other FROM v UNION SELECT reached.r, links.other FROM reached JOIN links ON links.r = reached.other
), component AS (
  SELECT reached.r, min(v.vec_id) AS component_id FROM reached JOIN v ON v.r = reached.other GROUP BY reached.r
)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.r = v.r) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN component USING (r)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_html_text": op2_html_text,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_pii": op4_pii,
    "op5_chat": op5_chat,
    "op6_line_dedup": op6_line_dedup,
    "op7_multiset_fingerprint": op7_multiset_fingerprint,
    "op8_warc": op8_warc,
    "op9_language_id": op9_language_id,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_filter_audit": op12_filter_audit,
    "op13_embedding_near_dedup": op13_embedding_near_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": OP1_SQL,
    "op5_chat": OP5_SQL,
    "op8_warc": OP8_SQL,
    "op11_conversation_repair": OP11_SQL,
    "op12_filter_audit": OP12_SQL,
    "op13_embedding_near_dedup": OP13_SQL,
}
