"""The queries of the training-data operators over the test tables, and the SQL that some must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from candlewright.llm import brown, byte_bpe, chat, exact_dedup, fertility, mixing, pii, prefix_counts, repair, resample, sharding, simhash, template
from candlewright.llm.common import table


#: The byte-level vocabulary that measures fertility and encodes, and the piece vocabulary.
BYTE_BPE, PIECES = corpus_pipeline.BYTE_BPE, corpus_pipeline.PIECES


def vocabularies(spark: SparkSession) -> fertility.Vocabularies:
    return fertility.Vocabularies.load(spark, public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECES), public_tokenizers.PATTERN)


def op1_tokenizer_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.quality(table(spark, sf_dir, "documents"), vocabularies(spark))


def op2_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.brown_scores(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op4_template_deduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template.main_texts(table(spark, sf_dir, "pages"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_words(table(spark, sf_dir, "documents"))


def op6_semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


#: Both turns of the conversation that is added to the table, numbered -1.
MARKED_TEXT = "<|im_end|><|im_start|>assistant ok"


def op7_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{MARKED_TEXT}'), (-1L, 1L, 'assistant', '{MARKED_TEXT}') AS added(conv_id, turn, role, text)")
    turns = table(spark, sf_dir, "conversations").select(added.columns).unionByName(added)
    return chat.read_back(chat.windows(turns))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = byte_bpe.vocabulary_of(spark, public_tokenizers.path(BYTE_BPE))
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


def op9_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The vocabulary whose tokens are counted.
COUNTED = "byte_bpe_50k.json"


def op12_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path(COUNTED), encoding="utf-8") as file:
        vocabulary = spark.sparkContext.broadcast(file.read())
    return prefix_counts.token_budget(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return repair.audit(turns, repair.damage(turns))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_tokenizer_fertility": op1_tokenizer_fertility,
    "op2_brown_classes": op2_brown_classes,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_template_deduction": op4_template_deduction,
    "op5_mix_sources": op5_mix_sources,
    "op6_semi_markov_pii": op6_semi_markov_pii,
    "op7_chat_windows": op7_chat_windows,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_simhash_trie": op9_simhash_trie,
    "op10_feistel_shards": op10_feistel_shards,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_prefix_token_counts": op12_prefix_token_counts,
    "op13_conversation_repair": op13_conversation_repair,
    "pipeline": corpus_pipeline.run,
}

#: CRC-32 in SQL: the table of its 256 steps, and the checksum of the bytes whose hex digits are `digits`.
CRC_STEPS = "list_transform(range(256), lambda b: list_reduce(list_prepend(b::BIGINT, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END))"
CRC = (
    "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(digits) + 1, 2), lambda i: ('0x' || substr(digits, i, 2))::BIGINT)), "
    "lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])))"
)

SQL: dict[str, str] = {
    "op3_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               row_number() OVER (same ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op5_mix_sources": r"""
        WITH RECURSIVE sized AS (
            SELECT doc_id, source, md5('7:' || coalesce(doc_id::VARCHAR, 'null')) AS mark,
                   coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
            FROM documents),
        sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
            FROM sized GROUP BY source),
        filling AS (
            SELECT 0 AS step, 0 AS clamped, sum(source_size) / sum(weight) AS level FROM sources
            UNION ALL
            SELECT step + 1, n, (total - held) / open FROM (
                SELECT step, clamped, count(*) FILTER (3 * source_size <= weight * level) AS n, sum(source_size) AS total,
                       coalesce(sum(3 * source_size) FILTER (3 * source_size <= weight * level), 0) AS held,
                       sum(weight) FILTER (3 * source_size > weight * level) AS open
                FROM filling, sources GROUP BY step, clamped, level)
            WHERE n <> clamped AND open IS NOT NULL),
        level AS (SELECT arg_max(level, step) AS level FROM filling),
        planned AS (
            SELECT source, source_size, 3 * source_size <= weight * level AS capped,
                   CASE WHEN capped THEN (3 * source_size)::DOUBLE ELSE weight * level END AS target,
                   CASE WHEN source_size = 0 THEN 0 WHEN capped THEN 3 ELSE floor(target / source_size)::BIGINT END AS whole,
                   target - whole * source_size AS rest
            FROM sources, level),
        started AS (
            SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY mark, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM sized)
        SELECT doc_id, size, source_size, target,
               (size * (whole + CASE WHEN 2 * before + size <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM started JOIN planned ON started.source IS NOT DISTINCT FROM planned.source
    """,
    "op7_chat_windows": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
            UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
        sized AS (
            SELECT *, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4 AS tokens,
                   12 + length(replace(replace(role, '\', '\\'), '<|', '<\|')) + 1 + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + 11 AS chars,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
            FROM turns),
        summed AS (
            SELECT *, coalesce(sum(tokens) OVER (so_far ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS prefix,
                   first_value(role) OVER so_far = 'system' AND 2 * first_value(tokens) OVER so_far <= 512 - 128 AS has_system, first_value(tokens) OVER so_far AS system_tokens,
                   first_value(chars) OVER so_far AS system_chars
            FROM sized WINDOW so_far AS (PARTITION BY conv_id ORDER BY place)),
        celled AS (
            SELECT *, greatest(2, 512 - 128 - CASE WHEN has_system THEN system_tokens ELSE 0 END) // 2 AS half, prefix // half AS cell, tokens > half AS big
            FROM summed),
        opened AS (
            SELECT *, place = 1 OR cell <> lag(cell) OVER so_far OR big OR lag(big) OVER so_far AS fresh,
                   coalesce(sum(CASE WHEN has_system AND place = 1 THEN 0 ELSE chars END)
                            OVER (PARTITION BY conv_id ORDER BY prefix RANGE BETWEEN 128 PRECEDING AND 1 PRECEDING), 0) AS past
            FROM celled WINDOW so_far AS (PARTITION BY conv_id ORDER BY place))
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
               (sum(chars) + sum(CASE WHEN fresh THEN past + CASE WHEN place > 1 AND has_system THEN system_chars ELSE 0 END ELSE 0 END))::BIGINT AS formatted_chars
        FROM opened GROUP BY conv_id
    """,
    "op11_importance_resampling": r"""
        WITH steps AS (
            SELECT <CRC_STEPS> AS step),
        lowered AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words, row_number() OVER () AS row_at
            FROM documents),
        aimed AS (
            SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
            FROM benchmark),
        read AS (SELECT row_at, unnest(words) AS word FROM lowered),
        known AS (
            SELECT word, hex(encode(word)) AS digits FROM (SELECT word FROM read UNION SELECT word FROM aimed)),
        hashed AS (
            SELECT word, <CRC> % 10000 AS bucket
            FROM known, steps),
        corpus AS (SELECT bucket, count(*) AS s FROM read JOIN hashed USING (word) GROUP BY bucket),
        target AS (SELECT bucket, count(*) AS t FROM aimed JOIN hashed USING (word) GROUP BY bucket),
        totals AS (SELECT (SELECT coalesce(sum(s), 0) FROM corpus)::DOUBLE AS s_all, (SELECT coalesce(sum(t), 0) FROM target)::DOUBLE AS t_all),
        gains AS (
            SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (s_all + 10000) / ((coalesce(s, 0)::DOUBLE + 1) * (t_all + 10000))))::BIGINT AS gain
            FROM corpus FULL JOIN target USING (bucket), totals),
        weighed AS (
            SELECT row_at, count(*) AS n, sum(gain)::BIGINT AS weight FROM read JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY row_at),
        scored AS (
            SELECT doc_id, row_at, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
            FROM lowered LEFT JOIN weighed USING (row_at)),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, row_at) AS place,
                   count(*) OVER (PARTITION BY n_features >= 20) AS n_all FROM scored)
        SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n_all // 100 THEN place END AS rank FROM ranked
    """.replace("<CRC_STEPS>", CRC_STEPS).replace("<CRC>", CRC),
    "op13_conversation_repair": r"""
        WITH RECURSIVE steps AS (
            SELECT <CRC_STEPS> AS step),
        keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS digits
            FROM conversations),
        struck AS (
            SELECT conv_id, turn, role, text,
                   <CRC> % 20 AS hit
            FROM keyed, steps),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
                   CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE hit WHEN 3 THEN 2 ELSE 1 END)) AS copy
            FROM struck WHERE hit <> 0),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || ':' || text), copy) AS place
            FROM damaged),
        judged AS (
            SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 2
                           WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 3
                           WHEN right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS fault,
                   left(lag(role) OVER (PARTITION BY conv_id ORDER BY place), 1) || left(role, 1) AS pair, place > 1 AS later
            FROM placed),
        found AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 2) AS blank,
                   count(*) FILTER (fault = 3) AS duplicate, count(*) FILTER (fault = 1) AS truncated,
                   count(*) FILTER (later AND pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
            FROM judged GROUP BY conv_id),
        -- States 1 to 4: nothing, system, user or assistant came last. A way has its cost, its edits and its turns.
        behind AS (
            SELECT conv_id, n + 1 AS place, [
                {'c': 0, 'a': '', 't': []::VARCHAR[]}, {'c': 6, 'a': 'II', 't': ['user:', 'assistant:']},
                {'c': 3, 'a': 'I', 't': ['assistant:']}, {'c': 0, 'a': '', 't': []::VARCHAR[]}] AS way
            FROM found
            UNION ALL
            SELECT conv_id, place, list_transform([1, 2, 3, 4], lambda s: list_min([
                raw[s],
                {'c': raw[due[s]].c + 3, 'a': 'I' || raw[due[s]].a, 't': list_prepend(name[due[s]] || ':', raw[due[s]].t)},
                {'c': raw[due[due[s]]].c + 6, 'a': 'II' || raw[due[due[s]]].a, 't': list_prepend(name[due[s]] || ':', list_prepend(name[due[due[s]]] || ':', raw[due[due[s]]].t))}]))
            FROM (
                SELECT conv_id, place, due, name, list_transform([1, 2, 3, 4], lambda s: list_min(list_filter([
                    {'c': way[s].c + 4, 'a': 'D' || way[s].a, 't': way[s].t},
                    CASE WHEN fault < 2 THEN {'c': way[due[s]].c + 3 + 3 * fault, 'a': 'R' || way[due[s]].a, 't': list_prepend(name[due[s]] || ':' || text, way[due[s]].t)} END,
                    CASE WHEN fault < 2 AND kept[s] IS NOT NULL THEN {'c': way[kept[s]].c + 3 * fault, 'a': 'K' || way[kept[s]].a, 't': list_prepend(role || ':' || text, way[kept[s]].t)} END
                ], lambda x: x IS NOT NULL))) AS raw
                FROM (
                    SELECT j.conv_id, j.place, j.role, j.text, j.fault, b.way, [3, 3, 4, 3] AS due, [NULL, NULL, 'user', 'assistant'] AS name,
                           CASE left(j.role, 1) WHEN 's' THEN [2, NULL, NULL, NULL] WHEN 'u' THEN [3, 3, NULL, 3] WHEN 'a' THEN [NULL, NULL, 4, NULL]
                                ELSE [NULL, NULL, NULL, NULL]::INT[] END AS kept
                    FROM behind b JOIN judged j ON j.conv_id IS NOT DISTINCT FROM b.conv_id AND j.place = b.place - 1))),
        best AS (SELECT conv_id, way[1] AS way FROM behind WHERE place = 1)
        SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
               coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(way.c, 0)::BIGINT AS cost,
               coalesce(way.a, '') AS audit, sha256(coalesce(array_to_string(way.t, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN found f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
             LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id
    """.replace("<CRC_STEPS>", CRC_STEPS).replace("<CRC>", CRC),
}
