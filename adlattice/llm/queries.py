"""The operators' registered queries, each over its whole table, and their SQL where SQL can express the result."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlattice.llm import (block_names, chat, fingerprints, mixing, near_dedup, packing, quality, repeats, secrets, sharding,
                           strata_index, toxicity, whitening)
from adlattice.sources.tables import read_table

SHARDS = 40
CHECK_CONVERSATION = (-7, r"\### Assistant: </turn> ok")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents")


def text_or_empty() -> Column:
    return F.coalesce("text", F.lit(""))


def op1_feistel_shards(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents(spark, folder).select(
        "doc_id", (F.octet_length(text_or_empty()).cast("long") + 16).alias("size"),
        F.crc32(text_or_empty().cast("binary")).alias("text_crc32"))
    return sharding.assign_shards(rows, ["doc_id", "text_crc32", "size"], SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op2_secret_automaton(spark: SparkSession, folder: str) -> DataFrame:
    base = [r.kind for r in secrets.BASE_RULES]
    found = secrets.scan_secrets(documents(spark, folder))
    own = F.filter("spans", lambda s: s["kind"].isin(base))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, base), F.sha2(_joined(own), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"))


def op3_weighted_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_edits(documents(spark, folder))


def op4_minhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, folder))


def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    given = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    conv, text = CHECK_CONVERSATION
    extra = spark.range(2).select(
        F.lit(conv).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    return chat.read_back(chat.format_conversations(given.unionByName(extra)))


def op6_bin_slack_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(packing.token_pieces(documents(spark, folder), packing.byte_bpe()))


def op7_pfair_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(documents(spark, folder))


def op8_rule_ledger(spark: SparkSession, folder: str) -> DataFrame:
    book = quality.ledger(quality.measure(documents(spark, folder)))
    base = F.col("failed").bitwiseAND(F.lit(quality.policy_mask(1))) != 0
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       base.alias("base_failed"), quality.keeps().alias("kept"), "failed")


def rule_ablations(spark: SparkSession, folder: str) -> DataFrame:
    """What each rule of the current policy rejects, and what it alone rejects, from the ledger of ``op8_rule_ledger``."""
    return quality.ablations(quality.ledger(quality.measure(documents(spark, folder))))


def op9_gated_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents(spark, folder)
    network = toxicity.fit(rows, read_table(spark, folder, "labels"))
    return toxicity.score_toxicity(rows, network).select(
        "doc_id", (~toxicity.learnable("doc_id")).alias("held_out"), "score", "predicted")


def op10_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    cut = repeats.remove_repeats(documents(spark, folder))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op11_strata_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return strata_index.rank_documents(documents(spark, folder), read_table(spark, folder, "benchmark"))


def op12_spectrum_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(read_table(spark, folder, "embeddings"))


def op13_block_naming(spark: SparkSession, folder: str) -> DataFrame:
    return block_names.exact_duplicates(documents(spark, folder))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


QUERIES = {f.__name__: f for f in (
    op1_feistel_shards, op2_secret_automaton, op3_weighted_fingerprints, op4_minhash_groups, op5_chat_format,
    op6_bin_slack_packing, op7_pfair_mix, op8_rule_ledger, rule_ablations, op9_gated_toxicity, op10_suffix_repeats, op11_strata_ranking,
    op12_spectrum_whitening, op13_block_naming, pipeline,
)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = f"unnest(regexp_extract_all({_LOWER.format('text')}, '{strata_index.TERM}')) AS term"

_WORD = r"[^\x20\x09-\x0D]+"
_BITS = " + ".join(f"CASE WHEN {r.fails} THEN {1 << r.bit} ELSE 0 END" for r in quality.RULES)
_LEDGER = f"""WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
        split AS (SELECT row, regexp_extract_all(t, '{_WORD}') AS w FROM texts),
        words AS (SELECT row, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM split),
        windows AS (SELECT row, i, word = lag(word) OVER g AS again, CASE WHEN lead(word, 7) OVER g IS NOT NULL THEN
            concat_ws(' ', word, {", ".join(f"lead(word, {k}) OVER g" for k in range(1, 8))}) END AS win
          FROM words WINDOW g AS (PARTITION BY row ORDER BY i)),
        twice AS (SELECT row, i, again, win IS NOT NULL AND count(*) OVER (PARTITION BY row, win) > 1 AS rep FROM windows),
        covered AS (SELECT row, again, bool_or(rep) OVER (PARTITION BY row ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS hit FROM twice),
        repeats AS (SELECT row, count(*) FILTER (hit) AS n_repeat_words, count(*) FILTER (again) AS n_stutter FROM covered GROUP BY row),
        lines AS (SELECT row, unnest(string_split(t, chr(10))) AS line FROM texts),
        line_counts AS (SELECT row, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
          WHERE regexp_matches(line, '{_WORD}') GROUP BY row),
        measured AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
            CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
            CAST(length(regexp_replace(t, '[^A-Z]', '', 'g')) AS BIGINT) AS upper_chars, coalesce(n_dup_lines, 0) AS n_dup_lines,
            coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_stutter, 0) AS n_stutter
          FROM texts JOIN split USING (row) LEFT JOIN repeats USING (row) LEFT JOIN line_counts USING (row)),
        judged AS (SELECT *, CAST({_BITS} AS BIGINT) AS failed FROM measured)"""
_USED = ", ".join(f"('{r.name}', {1 << r.bit})" for r in quality.RULES if r.name in quality.POLICIES[quality.CURRENT])

ORACLE = {
    "op4_minhash_groups": f"""WITH RECURSIVE words AS (
          SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
        places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0),
        shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM places),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
          GROUP BY ALL),
        links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
        reached AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other),
        groups AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM documents JOIN groups USING (doc_id) LEFT JOIN sizes USING (doc_id)""",
    "op5_chat_format": f"""WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT {CHECK_CONVERSATION[0]}, i, ['user', 'assistant'][i + 1], '{CHECK_CONVERSATION[1]}' FROM range(2) r(i)),
        sized AS (SELECT *, length(concat('### ', replace(url_encode(role), '%20', ' '), ': ', text, chr(10), '</turn>', chr(10)))
          + len(regexp_extract_all(text, '### |</turn>')) AS chars FROM turns)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text)) AS turns_sha256,
          CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
          sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
          CAST(sum(chars) AS BIGINT) AS formatted_chars FROM sized GROUP BY conv_id""",
    "op7_pfair_mix": f"""WITH RECURSIVE rows AS (SELECT DISTINCT doc_id, source FROM documents),
        sources AS (SELECT source, sqrt(count(*)) AS w FROM rows GROUP BY source),
        shares AS (SELECT *, greatest({mixing.PERIOD}, 10 * count(*) OVER ()) AS period,
          round((greatest({mixing.PERIOD}, 10 * count(*) OVER ()) - count(*) OVER ()) * w / sum(w) OVER (), 9) AS share FROM sources),
        quotas AS (SELECT source, period, CAST(floor(share) AS BIGINT) + 1 + CASE WHEN row_number() OVER (
            ORDER BY share - floor(share) DESC, source NULLS FIRST) <= period - sum(floor(share) + 1) OVER () THEN 1 ELSE 0 END AS q FROM shares),
        lists AS (SELECT list(source ORDER BY source NULLS FIRST) AS sources, list(q ORDER BY source NULLS FIRST) AS q,
          max(period) AS period FROM quotas),
        -- One step per slot: of the released blocks the one with the earliest deadline, then of the first source.
        steps AS (
          SELECT CAST(-1 AS BIGINT) AS slot, list_transform(q, lambda x: CAST(0 AS BIGINT)) AS done, CAST(NULL AS BIGINT) AS pick FROM lists
          UNION ALL
          SELECT slot + 1, list_transform(done, lambda d, i: d + CASE WHEN i = due % 1000000 THEN 1 ELSE 0 END), due % 1000000
          FROM (SELECT slot, done, list_min(list_transform(q, lambda x, i: CASE WHEN done[i] < x AND done[i] * period // x <= slot + 1
              THEN ((done[i] + 1) * period + x - 1) // x * 1000000 + i END)) AS due
            FROM steps, lists WHERE slot + 1 < period)),
        planned AS (SELECT sources[pick] AS source, slot, row_number() OVER (PARTITION BY pick ORDER BY slot) - 1 AS turn
          FROM steps, lists WHERE pick IS NOT NULL),
        placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS r FROM rows),
        blocks AS (SELECT p.doc_id, p.source, r, r // {mixing.BLOCK_ROWS} AS block, q, period
          FROM placed p JOIN quotas z ON z.source IS NOT DISTINCT FROM p.source),
        slotted AS (SELECT b.doc_id, b.source, r, block, block // q * period + n.slot AS slot
          FROM blocks b JOIN planned n ON n.source IS NOT DISTINCT FROM b.source AND n.turn = b.block % b.q)
        SELECT doc_id, source, block, slot, row_number() OVER (ORDER BY slot, r) - 1 AS mix_position FROM slotted""",
    "op8_rule_ledger": f"""{_LEDGER}
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & {quality.policy_mask(1)}) <> 0 AS base_failed,
          (failed & {quality.policy_mask(quality.CURRENT)}) = 0 AS kept, failed FROM judged""",
    "rule_ablations": f"""{_LEDGER}, used(rule, bit) AS (VALUES {_USED})
        SELECT rule, count(*) FILTER (failed & bit <> 0) AS n_failed,
          count(*) FILTER (failed & {quality.policy_mask(quality.CURRENT)} = bit) AS n_alone FROM used, judged GROUP BY rule""",
    "op11_strata_ranking": f"""WITH numbered AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
        doc_terms AS (SELECT row, doc_id, {_TERMS} FROM numbered),
        item_terms AS (SELECT item_id, {_TERMS} FROM benchmark),
        asked AS (SELECT item_id, term, count(*) AS repeats FROM item_terms GROUP BY ALL),
        lengths AS (SELECT row, doc_id, count(*) AS n FROM doc_terms GROUP BY ALL),
        corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
        postings AS (SELECT row, term, count(*) AS tf FROM doc_terms SEMI JOIN asked USING (term) GROUP BY ALL),
        weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
          FROM postings, corpus GROUP BY term, docs),
        parts AS (SELECT item_id, row, repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))) AS part
          FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN lengths USING (row), corpus),
        scores AS (SELECT item_id, row, CAST(sum(part) AS BIGINT) AS score FROM parts GROUP BY ALL)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM scores JOIN lengths USING (row) WHERE score > 0 QUALIFY rank <= 20""",
    "op13_block_naming": f"""WITH texts AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS t FROM documents),
        groups AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM texts JOIN groups USING (t)""",
}
