"""The queries opN_<name> and their DuckDB forms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.llm import toxicity
from genoweave.llm.common import table
from genoweave.llm.conversation_trie import regrown_trie
from genoweave.llm.html_text import extract_text
from genoweave.llm.merkle import with_next_edit
from genoweave.llm.mixing import mix_sources
from genoweave.llm.packing import pack
from genoweave.llm.personal_data import find_personal_data, report
from genoweave.llm.quality_rules import PRIOR, SHARES, SLACK, SPREAD, TAILS, quality_rules
from genoweave.llm.quotations import link_quotes
from genoweave.llm.simhash import simhash_components
from genoweave.llm.structure_repair import damaged, repair_report, turns
from genoweave.llm.substring_dedup import repeats
from genoweave.llm.token_counts import count_with_edits, sample_edits


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_with_edits(table(spark, sf_dir, "documents"), sample_edits(F.col("text")))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False)).alias("held_out")
    model = toxicity.fit(*toxicity.sample(docs, labels.filter(~held_out)))
    return toxicity.score(docs, model).select("doc_id", held_out, "score", "predicted")


def op7_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_quotes(table(spark, sf_dir, "conversations"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "shards", "first_shard")


def op9_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_next_edit(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regrown_trie(table(spark, sf_dir, "conversations"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(find_personal_data(table(spark, sf_dir, "documents")))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(damaged(turns(table(spark, sf_dir, "conversations"))))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_token_counts, op2_substring_dedup, op3_quality_rules, op4_html_text, op5_simhash, op6_toxicity, op7_quotation_links, op8_mix_sources, op9_merkle_fingerprints, op10_best_fit_packing,
            op11_conversation_trie, op12_personal_data, op13_structure_repair,
        )
    }


_Q = "quantile_disc({}, {})".format
_SPOTS = {f"{m}_{name}": (m, at) for m, q in TAILS.items() for name, at in (("foot", round(1 - q, 9)), ("mid", 0.5), ("tail", q))}
_SKETCH = "count(*) AS n, " + ", ".join(f"{_Q(m, at)} AS {spot}" for spot, (m, at) in _SPOTS.items())


def _shrunk(level: str, towards: str) -> str:
    """Quantiles of a level, drawn to those of the one above."""
    n = f"coalesce({level}.n, 0)"
    return ", ".join(f"({n} * coalesce({level}.{spot}, 0) + {PRIOR} * {towards}.{spot}) / ({n} + {PRIOR}.0::DOUBLE) AS {spot}" for spot in _SPOTS)


def _high(m: str) -> str:
    fence = f"o.{m}_tail + {SPREAD} * (o.{m}_tail - o.{m}_mid)"
    if m in SHARES:
        fence = f"o.{m}_tail, 1 - (1 - o.{m}_tail) * pow((1 - o.{m}_tail) / greatest(1 - o.{m}_mid, 1e-12), {SPREAD})"
    return f"greatest({fence}, g.{m}_tail) * (1 + {SLACK}) AS {m}_high"


_LOW = f"least(o.mean_word_foot + {SPREAD} * (o.mean_word_foot - o.mean_word_mid), g.mean_word_foot) * (1 - {SLACK}) AS mean_word_low"

OP3_SQL = rf"""
WITH base AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
spot AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM base WHERE len(w) >= 3),
win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c FROM spot),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM win, (VALUES (0), (1), (2)) v(k) WHERE c > 1 GROUP BY doc_id),
counted AS (
  SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines FROM base LEFT JOIN rep USING (doc_id)),
stats AS (
  SELECT *, n_symbols / greatest(n_words, 1)::DOUBLE AS symbol_ratio, n_dup_lines / greatest(n_lines, 1)::DOUBLE AS dup_line_ratio,
         n_repeat_words / greatest(n_words, 1)::DOUBLE AS repeat_ratio, word_chars / greatest(n_words, 1)::DOUBLE AS mean_word,
         (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM counted),
own AS (SELECT lang, source, {_SKETCH} FROM stats WHERE NOT base_failed GROUP BY lang, source),
by_lang AS (SELECT lang, {_SKETCH} FROM stats WHERE NOT base_failed GROUP BY lang),
every AS (SELECT {_SKETCH} FROM stats WHERE NOT base_failed),
grp AS (SELECT DISTINCT lang, source FROM stats),
lang_q AS (
  SELECT d.lang, {_shrunk("x", "a")} FROM (SELECT DISTINCT lang FROM stats) d
  LEFT JOIN by_lang x ON x.lang IS NOT DISTINCT FROM d.lang CROSS JOIN every a),
own_q AS (
  SELECT d.lang, d.source, {_shrunk("x", "g")} FROM grp d
  LEFT JOIN own x ON x.lang IS NOT DISTINCT FROM d.lang AND x.source IS NOT DISTINCT FROM d.source
  JOIN lang_q g ON g.lang IS NOT DISTINCT FROM d.lang),
lim AS (SELECT o.lang, o.source, {", ".join(map(_high, TAILS))}, {_LOW} FROM own_q o JOIN lang_q g ON g.lang IS NOT DISTINCT FROM o.lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce({" AND ".join(f"{m} <= {m}_high" for m in TAILS)} AND mean_word >= mean_word_low, true) AS kept
FROM stats s JOIN lim ON s.lang IS NOT DISTINCT FROM lim.lang AND s.source IS NOT DISTINCT FROM lim.source
"""


OP2_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, s, md5(array_to_string(w[s : s + 19], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM w WHERE len(w) >= 20)),
later AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY h ORDER BY doc_id, s) AS n FROM win) WHERE n > 1),
gone AS (SELECT doc_id, list_distinct(flatten(list(range(s, s + 20)))) AS g FROM later GROUP BY doc_id),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w WHERE len(w) > 0),
cut AS (SELECT doc_id, i FROM (SELECT doc_id, unnest(g) AS i FROM gone)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n FROM word ANTI JOIN cut USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w.w)::BIGINT AS n_words, (len(w.w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


OP7_SQL = r"""
WITH RECURSIVE m AS (SELECT conv_id, turn, role, coalesce(text, '') AS t, coalesce(turn, 9223372036854775807) AS o FROM conversations),
said_line AS (SELECT conv_id, o, role, t, unnest(string_split(t, chr(10))) AS x, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM (SELECT DISTINCT conv_id, o, role, t FROM m)),
line AS (
  SELECT conv_id, o, role, t, i, len(regexp_replace(regexp_extract(x, '^[ \t]*(?:>[ \t]?)+'), '[^>]', '', 'g')) AS level,
         regexp_replace(x, '^[ \t]*(?:>[ \t]?)+', '') AS body FROM said_line),
run AS (SELECT *, sum(CASE WHEN level = before THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id, o, role, t ORDER BY i) AS n
        FROM (SELECT *, lag(level) OVER (PARTITION BY conv_id, o, role, t ORDER BY i) AS before FROM line)),
passage AS (SELECT conv_id, o, role, t, n, any_value(level) AS level, string_agg(body, ' ' ORDER BY i) AS whole FROM run GROUP BY ALL),
raw AS (SELECT conv_id, o, role, t, n, level, whole AS u FROM passage UNION ALL SELECT conv_id, o, role, t, n, level, body FROM run),
norm AS (SELECT conv_id, o, role, t, n, level, lower(trim(regexp_replace(u, '[ \t\n\x0B\f\r]+', ' ', 'g'))) AS u FROM raw),
entire AS (SELECT conv_id, o, role, t, n, level, lower(trim(regexp_replace(whole, '[ \t\n\x0B\f\r]+', ' ', 'g'))) AS u FROM passage),
unit AS (SELECT * FROM norm UNION SELECT conv_id, o, role, t, n, level, unnest(string_split(regexp_replace(u, '([.!?]) ', '\1' || chr(10), 'g'), chr(10))) FROM entire),
orig AS (SELECT conv_id, u, min(o) AS ref FROM unit WHERE level = 0 AND u <> '' GROUP BY conv_id, u),
linked AS (SELECT q.*, ref FROM unit q JOIN orig f ON q.conv_id IS NOT DISTINCT FROM f.conv_id AND q.u = f.u WHERE q.level > 0 AND q.u <> '' AND ref < q.o),
vote AS (SELECT conv_id, o, ref, sum(length(u)) AS chars FROM linked WHERE level = 1 GROUP BY ALL),
top AS (SELECT conv_id, o, ref AS said FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, o ORDER BY chars DESC, ref DESC) AS k FROM vote) WHERE k = 1),
found AS (SELECT conv_id, o, count(DISTINCT n) AS n_linked FROM linked GROUP BY ALL),
own AS (
  SELECT conv_id, o, role, t, coalesce(string_agg(body, chr(10) ORDER BY i) FILTER (level = 0), '') AS text,
         count(DISTINCT n) FILTER (level > 0) AS n_passages, max(level) AS max_level FROM run GROUP BY ALL),
node AS (
  SELECT n.conv_id, n.o, said, previous, coalesce(said, previous) AS p
  FROM (SELECT conv_id, o, lag(o) OVER (PARTITION BY conv_id ORDER BY o) AS previous FROM (SELECT DISTINCT conv_id, o FROM m)) n
  LEFT JOIN top ON n.conv_id IS NOT DISTINCT FROM top.conv_id AND n.o = top.o),
tree AS (
  SELECT conv_id, o, [o] AS path, 0 AS depth FROM node WHERE p IS NULL
  UNION ALL SELECT n.conv_id, n.o, list_append(path, n.o), depth + 1 FROM node n JOIN tree t ON n.conv_id IS NOT DISTINCT FROM t.conv_id AND n.p = t.o),
walk AS (
  SELECT t.conv_id, t.o, path, depth, sum(CASE WHEN e.o IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY t.conv_id ORDER BY path) - 1 AS thread
  FROM tree t LEFT JOIN (SELECT conv_id, p, min(o) AS o FROM node WHERE p IS NOT NULL GROUP BY ALL) e ON t.conv_id IS NOT DISTINCT FROM e.conv_id AND t.o = e.o)
SELECT m.conv_id, m.turn, m.role, row_number() OVER (PARTITION BY m.conv_id ORDER BY path, m.role NULLS FIRST, m.t) - 1 AS position, nullif(p, 9223372036854775807) AS reply_to,
       depth::BIGINT AS depth, thread::BIGINT AS thread, said IS NOT NULL AS quoted,
       n_passages, coalesce(n_linked, 0)::BIGINT AS n_linked, max_level::BIGINT AS max_level, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS text
FROM m JOIN own ON m.conv_id IS NOT DISTINCT FROM own.conv_id AND m.o = own.o AND m.role IS NOT DISTINCT FROM own.role AND m.t = own.t
JOIN walk w ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.o = w.o JOIN node ON m.conv_id IS NOT DISTINCT FROM node.conv_id AND m.o = node.o
LEFT JOIN found f ON m.conv_id IS NOT DISTINCT FROM f.conv_id AND m.o = f.o
"""


#: The CRC-32 of a decimal number, byte by byte and bit by bit.
_CRC = "xor(list_reduce(list_concat([4294967295], list_transform(string_split({0}::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)), lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"

OP11_SQL = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
           FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT conv_id AS c, list(sha256(concat(strlen(r), ':', r, x)) ORDER BY i) AS k, list(strlen(x) ORDER BY i) AS z FROM t GROUP BY conv_id),
h AS (SELECT c, {_CRC.format("c")} % 9 AS h FROM s),
grown AS (
  SELECT s.c, list_concat(coalesce(b.k[1 : h], []), s.k[h + 1 :]) AS k, list_concat(coalesce(b.z[1 : h], []), s.z[h + 1 :]) AS z
  FROM s JOIN h ON h.c = s.c LEFT JOIN s b ON b.c = s.c - s.c % 5),
spot AS (
  SELECT c, d, len(k) AS n, md5(array_to_string(k[1 : d], '')) AS p, CASE WHEN d > 0 THEN md5(array_to_string(k[1 : d - 1], '')) END AS up, CASE WHEN d > 0 THEN z[d] ELSE 0 END AS size
  FROM (SELECT c, k, z, unnest(range(0, len(k) + 1)) AS d FROM grown)),
node AS (SELECT d, p, any_value(up) AS up, min(c) AS c, count(*) AS n, any_value(size) AS size, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '') AS ends FROM spot GROUP BY d, p),
kid AS (SELECT d - 1 AS d, up AS p, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
under AS (
  SELECT a.d, a.p, count(*) FILTER (kid.n IS NULL) AS leaves, sum((node.n - 1) * node.size)::BIGINT AS saved
  FROM node JOIN spot a ON a.c = node.c AND a.d <= node.d LEFT JOIN kid ON kid.d = node.d AND kid.p = node.p GROUP BY ALL)
SELECT node.c AS conv_id, node.d AS depth, parent.c AS parent_conv_id, node.n AS n_convs, coalesce(kid.n, 0) AS n_children, leaves AS n_leaves, saved AS saved_tokens, sha256(node.ends) AS ends_sha256
FROM node JOIN under ON under.d = node.d AND under.p = node.p LEFT JOIN kid ON kid.d = node.d AND kid.p = node.p LEFT JOIN node parent ON parent.d = node.d - 1 AND parent.p = node.up
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_conversation_trie": OP11_SQL, "op7_quotation_links": OP7_SQL, "op2_substring_dedup": OP2_SQL, "op3_quality_rules": OP3_SQL}
