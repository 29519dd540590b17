"""Registered queries of this package and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import bpe, chat, exact, html, lines, lm, merkle, mixing, phrases, quality, rules, simhash, toxicity
from plumbline.llm.frames import table


def op1_source_mix(spark: SparkSession, directory: str) -> DataFrame:
    return mixing.mix(table(spark, directory, "documents"))


def op2_quality_rules(spark: SparkSession, directory: str) -> DataFrame:
    judged = rules.judge(table(spark, directory, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", *rules.MEASURES, "base_failed", F.array_join("broken_rules", ",").alias("broken_rules"), "kept",
    )


def op3_simhash(spark: SparkSession, directory: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, directory, "documents"))


def op4_language_model(spark: SparkSession, directory: str) -> DataFrame:
    return lm.language_scores(table(spark, directory, "documents"))


def op5_byte_bpe(spark: SparkSession, directory: str) -> DataFrame:
    return bpe.digests(table(spark, directory, "documents"))


def op6_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    return toxicity.toxicity(table(spark, directory, "documents"), table(spark, directory, "labels"))


def op7_quality_mil(spark: SparkSession, directory: str) -> DataFrame:
    return quality.quality(table(spark, directory, "documents"), table(spark, directory, "labels"))


def op8_chat_format(spark: SparkSession, directory: str) -> DataFrame:
    return chat.format_chats(table(spark, directory, "conversations"))


def op9_exact_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return exact.decisions(table(spark, directory, "documents"))


def op10_html_text(spark: SparkSession, directory: str) -> DataFrame:
    return html.extract(table(spark, directory, "pages"))


def op11_collocations(spark: SparkSession, directory: str) -> DataFrame:
    return phrases.collocations(table(spark, directory, "documents"))


def op12_line_dedup(spark: SparkSession, directory: str) -> DataFrame:
    cleaned = lines.deduplicated(table(spark, directory, "documents"))
    return cleaned.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_merkle_manifest(spark: SparkSession, directory: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    proven = merkle.manifest(table(spark, directory, "documents"), found={"text": text})
    siblings = F.array_join(F.transform("proof", lambda step: F.concat(step["before"], step["after"])), "")
    folded = merkle.folded(F.col("found_leaf"), F.col("proof"))
    return proven.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_source_mix": op1_source_mix,
    "op2_quality_rules": op2_quality_rules,
    "op3_simhash": op3_simhash,
    "op4_language_model": op4_language_model,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_toxicity": op6_toxicity,
    "op7_quality_mil": op7_quality_mil,
    "op8_chat_format": op8_chat_format,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_html_text": op10_html_text,
    "op11_collocations": op11_collocations,
    "op12_line_dedup": op12_line_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}

# The thresholds are written out here, so that the SQL does not depend on the table under test.
RULES_SQL = r"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    words AS (
        SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i
        FROM (SELECT r, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM docs)
    ),
    seen AS (
        SELECT r, i, word, lag(word) OVER by_place AS before, list(word) OVER (by_place ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS eight
        FROM words WINDOW by_place AS (PARTITION BY r ORDER BY i)
    ),
    windows AS (SELECT *, CASE WHEN len(eight) = 8 THEN count(*) OVER (PARTITION BY r, eight) ELSE 0 END AS times FROM seen),
    covered AS (
        SELECT r, i, word, before, max(CASE WHEN times > 1 THEN 1 ELSE 0 END)
               OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS hit
        FROM windows
    ),
    by_word AS (
        SELECT r, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars, sum(hit)::BIGINT AS n_repeat_words,
               count(*) FILTER (WHERE word = before) AS n_adjacent,
               count(*) FILTER (WHERE list_contains(string_split('{stop}', ' '), lower(word))) AS n_stop_words
        FROM covered GROUP BY r
    ),
    lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs),
    by_line AS (
        SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
    ),
    measured AS (
        SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
               length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
               coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
               coalesce(n_stop_words, 0) AS n_stop_words, coalesce(n_adjacent, 0) AS n_adjacent
        FROM docs LEFT JOIN by_word USING (r) LEFT JOIN by_line USING (r)
    ),
    ratios AS (SELECT *, greatest(n_words, 1) AS w, greatest(n_lines, 1) AS l FROM measured),
    judged AS (
        SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
               concat_ws(',', CASE WHEN word_chars / w < 2 OR word_chars / w > 20 THEN 'word_length' END,
                         CASE WHEN n_symbols / w > 0.1 THEN 'symbols' END, CASE WHEN n_stop_words / w < 0.01 THEN 'stop_words' END,
                         CASE WHEN n_dup_lines / l > 0.5 THEN 'repeated_lines' END,
                         CASE WHEN n_adjacent / w > 0.3 THEN 'repeated_neighbours' END) AS broken_rules
        FROM ratios
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stop_words, n_adjacent, base_failed, broken_rules,
           NOT base_failed AND broken_rules = '' AS kept
    FROM judged
""".replace("{stop}", " ".join(rules.STOP_WORDS))

PHRASES_SQL = r"""
    WITH pieces AS (
        SELECT row_number() OVER () AS p, lang, piece FROM (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents)
    ),
    split AS (SELECT p, lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
    total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang),
    starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
    grams AS (SELECT lang, k, list_slice(w, i, i + k - 1) AS g FROM starts, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)),
    f AS (SELECT lang, k, g, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
    longer AS (SELECT lang, a, k, unnest([list_slice(g, 1, k - 1), list_slice(g, 2, k)]) AS g FROM f WHERE k > 2),
    stay AS (SELECT * FROM f WHERE k > 1 AND NOT EXISTS (SELECT 1 FROM longer AS b WHERE b.lang = f.lang AND b.g = f.g AND b.a >= f.a)),
    cuts AS (SELECT lang, k, g, a, unnest(range(1, k)) AS c FROM stay),
    scored AS (
        SELECT cuts.lang, cuts.g, cuts.a, c, h.a AS l, t.a AS r, n,
               (1000::HUGEINT * cuts.a * n // (h.a::HUGEINT * t.a))::BIGINT AS score
        FROM cuts JOIN total USING (lang)
        JOIN f AS h ON h.lang = cuts.lang AND h.g = list_slice(cuts.g, 1, c)
        JOIN f AS t ON t.lang = cuts.lang AND t.g = list_slice(cuts.g, c + 1, cuts.k)
    ),
    least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1),
    named AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM least)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM named QUALIFY rank <= 2000
"""

LINES_SQL = r"""
    WITH docs AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
    lines AS (SELECT row, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM docs),
    keyed AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
    ),
    told AS (
        SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
    ),
    judged AS (SELECT keyed.*, told.key IS NOT NULL AND doc_id <> first AS gone FROM keyed LEFT JOIN told USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM judged GROUP BY row, doc_id
"""

# Trees are numbered from 1 in the order of their sources; tree 0 has their roots as leaves.
MERKLE_SQL = r"""
    WITH RECURSIVE marked AS (
        SELECT *, list_reduce(
            list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ord(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT),
            lambda c, b: list_reduce(range(8), lambda x, _: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END), xor(c, b)),
            4294967295
        ) & 1 AS odd FROM documents
    ),
    framed AS (
        SELECT doc_id, source, {now} AS leaf_text, {found} AS found_text FROM marked
    ),
    leaves AS (
        SELECT doc_id, sha256(leaf_text) AS leaf, sha256(found_text) AS found, dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree,
               row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
        FROM framed
    ),
    low AS (
        SELECT tree, 0 AS level, i, n, leaf AS digest FROM leaves
        UNION ALL
        SELECT tree, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY i)) FROM low WHERE n > 1
        GROUP BY tree, level, i // 3, n
    ),
    roots AS (SELECT tree, digest AS subroot FROM low WHERE n = 1),
    high AS (
        SELECT 0 AS tree, 0 AS level, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n, subroot AS digest FROM roots
        UNION ALL
        SELECT tree, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY i)) FROM high WHERE n > 1
        GROUP BY tree, level, i // 3, n
    ),
    nodes AS (
        SELECT tree, level, i, n, coalesce(string_agg(digest, '' ORDER BY i) OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
               coalesce(string_agg(digest, '' ORDER BY i) OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
        FROM (SELECT * FROM low UNION ALL SELECT * FROM high) WHERE n > 1 WINDOW run AS (PARTITION BY tree, level, i // 3 ORDER BY i)
    ),
    walk AS (
        SELECT doc_id, tree AS own, tree, 0 AS level, i, n, found AS digest, '' AS proof FROM leaves
        UNION ALL
        SELECT doc_id, own, CASE WHEN w.n = 1 THEN 0 ELSE w.tree END, CASE WHEN w.n = 1 THEN 0 ELSE w.level + 1 END,
               CASE WHEN w.n = 1 THEN w.own - 1 ELSE w.i // 3 END,
               CASE WHEN w.n = 1 THEN (SELECT count(*) FROM roots) ELSE (w.n + 2) // 3 END,
               CASE WHEN w.n = 1 THEN w.digest ELSE sha256(before || w.digest || after) END,
               CASE WHEN w.n = 1 THEN proof ELSE proof || before || after END
        FROM walk AS w LEFT JOIN nodes ON nodes.tree = w.tree AND nodes.level = w.level AND nodes.i = w.i AND w.n > 1
        WHERE w.n > 1 OR w.tree > 0
    )
    SELECT walk.doc_id, leaf, subroot, high.digest AS root, sha256(proof) AS proof_sha256, walk.digest AS folded_root,
           walk.digest = high.digest AS verified
    FROM walk JOIN leaves USING (doc_id) JOIN roots ON roots.tree = leaves.tree, high
    WHERE walk.tree = 0 AND walk.n = 1 AND high.n = 1
"""
FRAMED = "coalesce(octet_length(encode({0}::VARCHAR))::VARCHAR || ':' || {0}::VARCHAR, '-')"
NOW = " || ".join(FRAMED.format(name) for name in ("doc_id", "source", "lang", "n_chars"))
TAMPERED = "(CASE WHEN odd = 1 THEN replace(text, chr(10), '') ELSE text END)"
MERKLE_SQL = MERKLE_SQL.replace("{now}", f"{NOW} || {FRAMED.format('text')}").replace("{found}", f"{NOW} || {FRAMED.format(TAMPERED)}")

ORACLES = {
    "op11_collocations": PHRASES_SQL,
    "op12_line_dedup": LINES_SQL,
    "op13_merkle_manifest": MERKLE_SQL,
    "op2_quality_rules": RULES_SQL,
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op8_chat_format": r"""
        WITH told AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations GROUP BY ALL
        ),
        whole AS (
            SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn, role, text) AS turns FROM told GROUP BY conv_id
        ),
        merged AS (SELECT turns, min(conv_id) AS conv_id, count(*) AS n_copies FROM whole GROUP BY turns),
        prefixes AS (
            SELECT DISTINCT list_slice(turns, 1, k) AS turns FROM (SELECT turns, unnest(range(1, len(turns))) AS k FROM merged)
        ),
        kept AS (SELECT * FROM merged ANTI JOIN prefixes USING (turns)),
        lines AS (
            SELECT *, list_aggregate(
                list_transform(turns, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), 'string_agg', '') AS text
            FROM kept
        )
        SELECT conv_id, len(turns) AS n_turns, n_copies, text, length(text) AS n_chars FROM lines
    """,
}
