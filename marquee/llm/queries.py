"""The registered queries of this subpackage, with production parameters, and the SQL that checks them where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.llm import chat, collocations, decontaminate, html_text, jaccard, lempel_ziv, licences, mixing, passages, pieces, quality, trie, warc
from marquee.llm.common import table


def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


def op2_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return passages.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "repeats_of", "text")


def op3_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lempel_ziv.fingerprints(table(spark, sf_dir, "documents"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_licences, op2_repeated_passages, op3_lz_fingerprint, op4_mix_sources, op5_html_text, op6_quality, op7_chat_format, op8_warc, op9_ngram_jaccard, op10_decontaminate, op11_prefix_trie, op12_pieces, op13_collocations)}

ORACLES = {
    "op7_chat_format": """
WITH turns AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM turns),
prefixes AS (SELECT *, list(struct_pack(r := role, t := text)) OVER (PARTITION BY conv_id ORDER BY k) AS prefix FROM numbered),
lasts AS (SELECT conv_id, max(k) AS n, arg_max(prefix, k) AS prefix FROM prefixes GROUP BY conv_id),
kept AS (SELECT min(conv_id) AS conv_id, n, prefix FROM lasts GROUP BY n, prefix),
maximal AS (SELECT conv_id, n FROM kept WHERE prefix NOT IN (
    SELECT p.prefix FROM prefixes p JOIN lasts l ON p.conv_id IS NOT DISTINCT FROM l.conv_id WHERE p.k < l.n))
SELECT m.conv_id, t.k, m.n, '<|' || t.role || '|>' || chr(10) || t.text || chr(10) || CASE WHEN t.k = m.n THEN '<|end|>' || chr(10) ELSE '' END AS rendered
FROM maximal m JOIN numbered t ON t.conv_id IS NOT DISTINCT FROM m.conv_id
""",
    "op8_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f
""",
    "op13_collocations": r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
runs AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS p FROM words, (VALUES (1), (2), (3)) t(k)
    WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, p, count(*) AS a FROM runs GROUP BY lang, k, p HAVING k = 1 OR count(*) >= 10),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS MATERIALIZED (SELECT lang, k, p, a, string_split(p, ' ') AS w FROM f WHERE k >= 2),
cuts AS (SELECT lang, p, k, a, cut, array_to_string(list_slice(w, 1, cut), ' ') AS first, array_to_string(list_slice(w, cut + 1, k), ' ') AS rest FROM cand, (VALUES (1), (2)) t(cut) WHERE cut < k),
judged AS (SELECT c.lang, c.p, c.a, cut, x.a AS l, y.a AS r, (1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a) AS score FROM cuts c
    JOIN f x ON x.lang = c.lang AND x.p = c.first JOIN f y ON y.lang = c.lang AND y.p = c.rest),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) AS pick FROM judged),
inside AS (SELECT lang, unnest([array_to_string(list_slice(w, 1, 2), ' '), array_to_string(list_slice(w, 2, 3), ' ')]) AS p, a FROM cand WHERE k = 3),
longer AS (SELECT lang, p, max(a) AS longest FROM inside GROUP BY lang, p),
ranked AS (SELECT b.lang, b.p AS phrase, b.a, l, r, score, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.p) AS rank
    FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.p = b.p WHERE pick = 1 AND (longest IS NULL OR 100 * longest < 50 * b.a))
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""",
    "op11_prefix_trie": """
WITH t AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, x: xor(c >> 1, (c & 1) * 3988292384))) AS crc_of),
turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k, coalesce(role, '') AS r,
    coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(struct_pack(r := r, x := x) ORDER BY k) AS turns FROM turns GROUP BY conv_id),
h AS (SELECT conv_id, turns, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda c, b: xor(c >> 8, crc_of[1 + (xor(c, b) & 255)]::BIGINT))) % 9 AS h FROM own, t),
built AS (SELECT a.conv_id, list_concat(coalesce(list_slice(b.turns, 1, a.h), []), list_slice(a.turns, a.h + 1, len(a.turns))) AS turns
    FROM h a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5),
places AS (SELECT conv_id, d, list_slice(turns, 1, d) AS node FROM built, unnest(range(len(turns) + 1)) AS u(d)),
nodes AS MATERIALIZED (SELECT node::VARCHAR AS node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(strlen(any_value(node)[d].x), 0) AS bytes, any_value(list_slice(node, 1, d - 1))::VARCHAR AS parent FROM places GROUP BY node, d),
names AS MATERIALIZED (SELECT conv_id, d, node::VARCHAR AS node FROM places),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY parent),
full_nodes AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (node)),
below AS (SELECT a.node, sum((f.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((f.n_convs - 1) * f.bytes)::BIGINT AS saved_tokens
    FROM full_nodes f JOIN names a ON a.conv_id = f.conv_id AND a.d <= f.d GROUP BY a.node),
ends AS (SELECT node::VARCHAR AS node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM (SELECT conv_id, turns AS node FROM built) GROUP BY node)
SELECT f.conv_id, f.d::BIGINT AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, b.n_leaves, b.saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM full_nodes f JOIN below b USING (node) LEFT JOIN nodes p ON f.d > 0 AND p.node = f.parent LEFT JOIN ends e ON e.node = f.node
""",
}
