"""One query an operator over its whole table, with the SQL it must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from switchback.llm import (
    bpe, chat, fill_middle, line_dedup, mixing, near_dedup, neighbours, repetition, resharding, secret_scan, syncmers, toxicity, whitening,
)
from switchback.llm.common import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def known_id(c: str) -> Column:
    """A doc_id again; the number that stands for none is null."""
    return F.when(F.col(c) != 2**63 - 1, F.col(c))


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_syncmers(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = syncmers.fingerprint_edits(docs, parts=4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    return made.select(
        known_id("doc").alias("doc_id"), F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        syncmers.as_text(F.col("hashes")).alias("fingerprint"), syncmers.as_text(F.col("edited_hashes")).alias("edited_fingerprint"),
        syncmers.likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        syncmers.likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )


@query
def op2_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op2_line_dedup"] = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT doc_id, pos, line, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT k.doc_id, k.pos, k.line, f.first_doc IS NOT NULL AND f.first_doc < k.doc_id AS gone FROM k LEFT JOIN f ON f.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query
def op3_resharding(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.xxhash64(text).alias("hash"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc")
    )
    # the layout before: five shards by checksum of the text
    made = resharding.reshard(rows.withColumn("old", F.pmod("crc", F.lit(5)).cast("int")), shards=8)
    return made.select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op4_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.col("spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    base = F.filter(spans, lambda s: s["kind"] != "format")
    return secret_scan.scan(docs, secret_scan.learn(docs)).select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(secret_scan.span_list(base), 256).alias("base_sha256"), secret_scan.span_list(spans).alias("spans"),
    )


@query
def op5_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    out = bpe.round_trip(docs, path, pattern)
    return out.select(
        "doc_id", bpe.n_tokens(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op7_chat(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "\\### Assistant: </turn> ok"
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"),
    )
    made = chat.format_conversations(rows.unionByName(own))
    turns = chat.read_back(F.col("formatted"))
    loss = F.array_join(chat.under_mask(F.col("formatted"), F.col("loss_spans")), "")
    lines = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = made.select("conv_id", F.char_length("formatted").cast("long").alias("formatted_chars"), turns.alias("turns"), lines.alias("lines"), loss.alias("loss"))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join("lines", ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


ORACLES["op7_chat"] = r"""
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT CAST(-7 AS BIGINT), CAST(0 AS BIGINT), 'user', chr(92) || '### Assistant: </turn> ok'
  UNION ALL SELECT CAST(-7 AS BIGINT), CAST(1 AS BIGINT), 'assistant', chr(92) || '### Assistant: </turn> ok'),
e AS (SELECT *, replace(replace(text, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|') AS safe,
  coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn) <> role, true) AS opens FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(safe) + CASE WHEN opens THEN 24 + length(role) ELSE 8 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query
def op8_minhash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = near_dedup.near_components(docs)
    return out.select(
        known_id("doc").alias("doc_id"), "n_shingles", known_id("component").alias("component_id"), (F.col("doc") == F.col("component")).alias("kept")
    )


ORACLES["op8_minhash"] = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
i AS (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 4))) AS k FROM w WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, k, k + 4), ' ') AS sh FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT p.x, p.y FROM p JOIN n a ON a.doc_id = p.x JOIN n b ON b.doc_id = p.y WHERE 100 * p.c >= 75 * (a.n + b.n - p.c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS seen FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.seen)
SELECT r.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.seen) AS component_id, min(r.seen) = r.doc_id AS kept
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""


@query
def op9_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = mixing.with_copies(docs)
    return out.select(
        "doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"), (F.col("__size") * F.col("__copies")).alias("taken"),
    )


ORACLES["op9_mixing"] = r"""
WITH s AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
b AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM s GROUP BY source),
r AS (SELECT source, source_size, CAST(row_number() OVER (ORDER BY source NULLS LAST) - 1 AS BIGINT) AS rk FROM b),
w AS (SELECT source, source_size, rk, CAST(CASE rk % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS BIGINT) AS weight FROM r),
o AS (SELECT *, CAST(row_number() OVER (ORDER BY CAST(source_size AS DOUBLE) / CAST(weight AS DOUBLE), rk) AS BIGINT) AS k FROM w),
n AS (SELECT a.source, a.source_size, a.weight, a.k,
    (SELECT CAST(sum(source_size) AS BIGINT) FROM w) - 3 * CAST(coalesce(sum(p.source_size), 0) AS BIGINT) AS num,
    (SELECT CAST(sum(weight) AS BIGINT) FROM w) - CAST(coalesce(sum(p.weight), 0) AS BIGINT) AS den
  FROM o a LEFT JOIN o p ON p.k < a.k GROUP BY a.source, a.source_size, a.weight, a.k),
f AS (SELECT min(k) AS k FROM n WHERE weight * num < 3 * source_size * den),
v AS (SELECT n.num, n.den, n.k FROM n JOIN f ON n.k = f.k),
t AS (SELECT n.source, n.source_size, CASE WHEN v.k IS NULL OR n.k < v.k THEN CAST(3 * n.source_size AS DOUBLE)
    ELSE CAST(n.weight * v.num AS DOUBLE) / CAST(v.den AS DOUBLE) END AS target FROM n LEFT JOIN v ON 1 = 1),
q AS (SELECT source, source_size, target, CASE WHEN source_size > 0 THEN least(CAST(3 AS DOUBLE), target / CAST(source_size AS DOUBLE)) ELSE CAST(0 AS DOUBLE) END AS rate FROM t),
u AS (SELECT s.doc_id, s.size, q.source_size, q.target, q.rate,
    CAST(CAST('0x' || substr(md5('mix:' || CAST(s.doc_id AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) / CAST(4503599627370496 AS DOUBLE) AS h
  FROM s JOIN q ON s.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target, size * (CAST(floor(rate) AS BIGINT) + CASE WHEN h < rate - floor(rate) THEN 1 ELSE 0 END) AS taken FROM u
"""


@query
def op10_repetition(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repetition.quality(docs).select("doc_id", "quality.*")


@query
def op11_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_fill_middle(spark, sf_dir):
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars", F.sha2("fim.output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("fim.output"), F.col("fim.form")), 256).alias("restored_sha256"),
    )


ORACLES["op12_fill_middle"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
t AS (SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
  CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
  CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, CAST(len(u) AS BIGINT) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
    WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM t),
p AS (SELECT doc_id, text, n, form, array_to_string(list_slice(u, 1, a), '') AS pre, array_to_string(list_slice(u, a + 1, b), '') AS mid,
  array_to_string(list_slice(u, b + 1, n), '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""


@query
def op13_neighbours(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = neighbours.learn(docs, table(spark, sf_dir, "labels"))
    return neighbours.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )
