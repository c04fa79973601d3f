"""One registered query per operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

import os
import string
from collections.abc import Callable
from functools import lru_cache

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    anchors, bitplanes, bpe_replay, html_tree, language, merkle, minhash, pii, preference, tiling, url_bloom, vafile, vptree,
)
from ledgerloom.llm.html_labelled import labelled_pages
from ledgerloom.llm.staging import new_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

LIBRARY_VOCABULARY = "byte_bpe_50k.json"
RANK_VOCABULARY = "byte_bpe_multi_50k.tiktoken"

# Rows carry whole texts, so fewer of them than Spark's default go to a Python worker at a time, and no more than these
# bytes, however long they are (a longer row goes alone).
ROWS_PER_BATCH = 2_000
BYTES_PER_BATCH = 8 << 20

# Rules of the URL query (host, path, verdict).
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. Python workers of a local session also find this package when the session was started
    elsewhere; on a cluster the package is shipped with the job. Sets the session's rows and bytes per Arrow batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(maxsize=1)
def page_model() -> html_tree.TreeModel:
    return html_tree.train(labelled_pages())


def op1_vantage_point_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_html_tree_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_tree.extract(table(spark, sf_dir, "pages"), page_model())


def op3_minhash_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_bit_plane_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-ids")
    docs = table(spark, sf_dir, "documents")
    bitplanes.write_token_ids(docs, path, public_tokenizers.path(LIBRARY_VOCABULARY), public_tokenizers.PATTERN, added=True)
    return bitplanes.digests(spark, path)


def op5_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANK_VOCABULARY)
    return bpe_replay.digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op6_blocked_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_bloom.judge_urls(table(spark, sf_dir, "pages"), listed)


def op7_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_traced_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op9_language_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs)
    found = language.identify(docs.select("doc_id", "text"), model)
    doc = found.select(F.col("row.doc_id").alias("doc_id"), "lang_pred", "score")
    return doc.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def conversation_pairs(conversations: DataFrame) -> DataFrame:
    """Preference pairs out of plain conversations: chosen is a conversation as it is; rejected is the same up to its
    last reply, with the last reply of the conversation numbered one higher in its place. Without an own or another
    reply there is no rejected side."""
    turns = conversations.select("conv_id", "turn", "role", "text").where("conv_id is not null and turn is not null")
    replies = turns.where("role = 'assistant'").groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    other = replies.select((F.col("conv_id") - 1).alias("conv_id"), F.col("last.text").alias("other_text"))
    swapped = replies.select("conv_id", F.col("last.turn").alias("last_turn")).join(other, "conv_id")
    before = turns.join(swapped.select("conv_id", "last_turn"), "conv_id").where("turn < last_turn")
    reply = swapped.select("conv_id", F.col("last_turn").alias("turn"), F.lit("assistant").alias("role"), F.col("other_text").alias("text"))
    rejected = before.select("conv_id", "turn", "role", "text").unionByName(reply)
    sides = turns.withColumn("side", F.lit("chosen")).unionByName(rejected.withColumn("side", F.lit("rejected")))
    return sides.withColumnRenamed("conv_id", "pair_id")


def op10_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.preference_turns(conversation_pairs(table(spark, sf_dir, "conversations")))


def op11_va_file_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.centroid_clusters(table(spark, sf_dir, "embeddings")).drop("centroid")


def op12_path_copying_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    third = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    return merkle.manifest(docs, columns, "lang", "doc_id", {"text": lower}, third).drop("copied")


def op13_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = anchors.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


_QUERIES = (
    op1_vantage_point_search, op2_html_tree_model, op3_minhash_bayes, op4_bit_plane_ids, op5_merge_replay,
    op6_blocked_bloom, op7_string_tiling, op8_traced_pii, op9_language_family, op10_preference_pairs,
    op11_va_file_clusters, op12_path_copying_manifest, op13_block_anchors,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in _QUERIES}


_OP3 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * k >= 75 * (p.n + q.n - k)),
reach(x, y) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
component AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c AS component_id, d.doc_id = c AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN component ON x = d.doc_id
"""

_OP6 = r"""
WITH rest AS (
  SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(rule_host, rule_path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC, verdict) AS k
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN (SELECT * FROM fits WHERE k = 1) f ON p.page_id = f.page_id
"""

_OP10 = r"""
WITH replies AS (
  SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant'
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1),
swapped AS (SELECT a.conv_id, a.turn AS last_turn, b.text AS other FROM replies a JOIN replies b ON b.conv_id = a.conv_id + 1),
rejected AS (
  SELECT c.conv_id, c.turn, c.role, c.text FROM conversations c JOIN swapped s ON s.conv_id = c.conv_id AND c.turn < s.last_turn
  UNION ALL SELECT conv_id, last_turn, 'assistant', other FROM swapped),
joined AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS pair_id, coalesce(c.turn, r.turn) AS turn, c.conv_id IS NOT NULL AS has_c, r.conv_id IS NOT NULL AS has_r,
    c.role AS c_role, c.text AS c_text, r.role AS r_role, r.text AS r_text,
    coalesce(c.conv_id IS NOT NULL AND r.conv_id IS NOT NULL AND c.role IS NOT DISTINCT FROM r.role AND c.text IS NOT DISTINCT FROM r.text, false) AS same
  FROM conversations c FULL JOIN rejected r ON c.conv_id = r.conv_id AND c.turn = r.turn),
marked AS (
  SELECT *, min(CASE WHEN NOT same THEN turn END) OVER (PARTITION BY pair_id) AS cut, bool_or(has_c) OVER (PARTITION BY pair_id) AS any_c,
    bool_or(has_r) OVER (PARTITION BY pair_id) AS any_r FROM joined),
lines AS (
  SELECT pair_id, turn, 'prompt' AS segment, c_role AS role, c_text AS text, cut, any_c, any_r FROM marked WHERE cut IS NULL OR turn < cut
  UNION ALL SELECT pair_id, turn, 'chosen', c_role, c_text, cut, any_c, any_r FROM marked WHERE turn >= cut AND has_c
  UNION ALL SELECT pair_id, turn, 'rejected', r_role, r_text, cut, any_c, any_r FROM marked WHERE turn >= cut AND has_r),
shown AS (
  SELECT *, '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS rendered,
    segment <> 'prompt' AND role IS NOT DISTINCT FROM 'assistant' AS trained FROM lines)
SELECT pair_id, segment, turn, role, rendered, length(rendered) AS n_chars,
  CAST(CASE WHEN trained THEN 5 + length(coalesce(role, 'unknown')) ELSE 0 END AS BIGINT) AS loss_start,
  CAST(CASE WHEN trained THEN length(rendered) - 1 ELSE 0 END AS BIGINT) AS loss_end,
  CASE WHEN NOT any_r THEN 'chosen_only' WHEN NOT any_c THEN 'rejected_only' WHEN cut IS NULL THEN 'identical' ELSE 'paired' END AS status
FROM shown
"""


def _op11(k: int = 40, rounds: int = 5) -> str:
    """The rounds of the clustering, one after the other."""
    near = """SELECT r, c, d FROM (
    SELECT r, c, list_sum(list_transform(range(1, 65), lambda i: (v[i] - m[i]) * (v[i] - m[i])))::BIGINT AS d FROM kept, c{0})
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1"""
    steps = []
    for i in range(rounds):
        steps.append(f"""a{i} AS MATERIALIZED ({near.format(i)}),
c{i + 1} AS MATERIALIZED (
  SELECT c{i}.c, coalesce(t.m, c{i}.m) AS m FROM c{i} LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS m FROM (
      SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM (
        SELECT c, unnest(range(1, 65)) AS i, unnest(v) AS x FROM a{i} JOIN kept USING (r)) GROUP BY c, i) GROUP BY c) t ON t.c = c{i}.c)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, v AS m FROM kept QUALIFY c < {k}),
{", ".join(steps)},
last AS MATERIALIZED ({near.format(rounds)})
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(m, ',')) AS centroid_sha256
FROM last JOIN kept USING (r) JOIN c{rounds} USING (c)
"""


def _op12(levels: int = 8, upper: int = 4) -> str:
    """Leaves, `levels` levels of the languages' trees (enough for 8 ** levels documents of one) and `upper` of the root's."""
    field = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0} END"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf = " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
    other = " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", lower))
    crc = """xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda a, b: list_reduce(
      list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""
    steps = []
    for i in range(levels + upper):
        grp = "grp" if i < levels else "''"
        if i == levels:
            steps.append(f"n{i} AS MATERIALIZED (SELECT '' AS grp, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n, h FROM m{i})")
        else:
            steps.append(f"n{i} AS MATERIALIZED (SELECT grp, pos, count(*) OVER (PARTITION BY grp) AS n, h FROM m{i})")
        steps.append(f"r{i} AS MATERIALIZED (SELECT grp, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM n{i} WHERE n > 1 GROUP BY grp, run)")
        steps.append(f"""m{i + 1} AS MATERIALIZED (
  SELECT grp, run AS pos, sha256(array_to_string(hs, '')) AS h FROM r{i} UNION ALL SELECT grp, pos, h FROM n{i} WHERE n = 1)""")
        top = "f AS unused" if i != levels else "m.h AS top"
        place = "d.pos" if i != levels else "(SELECT count(DISTINCT e.grp) FROM n0 e WHERE e.grp < d.grp)"
        steps.append(f"""q{i} AS MATERIALIZED (
  SELECT d.* EXCLUDE (pos), {place} AS pos FROM d{i} d),
d{i + 1} AS MATERIALIZED (
  SELECT d.* EXCLUDE (pos, f, sib), CASE WHEN hs IS NULL THEN d.pos ELSE d.pos // 8 END AS pos,
    CASE WHEN hs IS NULL THEN f ELSE sha256(array_to_string(list_concat(hs[:d.pos % 8], [f], hs[d.pos % 8 + 2:]), '')) END AS f,
    CASE WHEN hs IS NULL THEN sib ELSE sib || array_to_string(list_concat(hs[:d.pos % 8], hs[d.pos % 8 + 2:]), '') END AS sib
  FROM q{i} d LEFT JOIN r{i} r ON r.grp = {"d.grp" if i < levels else "''"} AND r.run = d.pos // 8)""")
    return f"""
WITH leaves AS MATERIALIZED (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '-' ELSE '=' || lang END AS grp, sha256({leaf}) AS leaf, sha256({other}) AS other, {crc} % 3 = 0 AS hit
  FROM documents),
d0 AS MATERIALIZED (
  SELECT doc_id, grp, leaf, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    CASE WHEN hit THEN other ELSE leaf END AS f, '' AS sib FROM leaves),
m0 AS MATERIALIZED (SELECT grp, pos, leaf AS h FROM d0),
{", ".join(steps)}
SELECT doc_id, leaf, s.h AS subroot, t.h AS root, sha256(sib) AS proof_sha256, f AS folded_root, f = t.h AS verified
FROM d{levels + upper} d JOIN m{levels} s ON s.grp = d.grp CROSS JOIN m{levels + upper} t
"""


_OP13 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
placed AS MATERIALIZED (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM words),
whole AS (
  SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS win FROM placed),
windows AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY sha256(array_to_string(win, ' ')) ORDER BY doc_id, i) > 1 AS later FROM whole WHERE len(win) = 20),
marked AS (
  SELECT doc_id, i, word, coalesce(max(later) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), false) AS gone
  FROM placed LEFT JOIN windows USING (doc_id, i))
SELECT d.doc_id, count(m.i) AS n_words, count(m.i) FILTER (m.gone) AS n_removed,
  sha256(coalesce(string_agg(m.word, ' ' ORDER BY m.i) FILTER (NOT m.gone), '')) AS kept_sha256
FROM documents d LEFT JOIN marked m ON m.doc_id = d.doc_id GROUP BY d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_minhash_bayes": _OP3, "op6_blocked_bloom": _OP6, "op10_preference_pairs": _OP10, "op11_va_file_clusters": _op11(),
        "op12_path_copying_manifest": _op12(), "op13_block_anchors": _OP13,
    }
