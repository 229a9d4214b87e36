"""The queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import bpe, chat, exact_dedup, hardneg, html_text, langid, licenses, mixing, quality, repair, secrets, simhash, topk
from starmart.llm.common import keep, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def tokenizer_path() -> str:
    """The byte-level vocabulary of the contract."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op1_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query(
    """
    WITH d AS (
        SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                        'abcdefghijklmnopqrstuvwxyz')) AS h
        FROM documents
    )
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           row_number() OVER (PARTITION BY h ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
           h AS text_sha256
    FROM d WINDOW g AS (PARTITION BY h)
    """
)
def op2_exact_dedup(spark, sf_dir):
    rows = exact_dedup.digests(table(spark, sf_dir, "documents"))
    index = exact_dedup.DigestIndex.temporary(spark)
    found = keep(exact_dedup.deduplicate(rows, index))
    index.drop()
    return found


@query(
    r"""
    WITH src AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL
    ), last AS (
        SELECT conv_id, turn AS last_turn, text AS last_text FROM src WHERE role = 'assistant'
        QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, text DESC) = 1
    ), raw AS (
        SELECT conv_id AS pair_id, true AS chosen, turn, role, text FROM src
        UNION ALL
        SELECT s.conv_id, false, s.turn, s.role,
               CASE WHEN s.role = 'assistant' AND s.turn IS NOT DISTINCT FROM l.last_turn AND s.text = l.last_text
                    THEN coalesce(o.last_text, '') ELSE s.text END
        FROM src s LEFT JOIN last l ON l.conv_id = s.conv_id LEFT JOIN last o ON o.conv_id - 1 = s.conv_id
    ), t AS (
        SELECT pair_id, chosen, turn, regexp_replace(role, '[|\n]', '_', 'g') AS role,
               regexp_replace(text, '<([|\\])', '<\\\1', 'g') AS text
        FROM raw
    ), n AS (
        SELECT *, row_number() OVER (PARTITION BY pair_id, chosen ORDER BY turn NULLS FIRST, role, text) AS i
        FROM t
    ), both_sides AS (
        SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, coalesce(c.i, r.i) AS i,
               c.role IS NOT DISTINCT FROM r.role AND c.text IS NOT DISTINCT FROM r.text AS same
        FROM (SELECT * FROM n WHERE chosen) c
        FULL JOIN (SELECT * FROM n WHERE NOT chosen) r ON c.pair_id = r.pair_id AND c.i = r.i
    ), prefix AS (
        SELECT pair_id, coalesce(min(CASE WHEN NOT same THEN i END), max(i) + 1) - 1 AS prompt_turns
        FROM both_sides GROUP BY pair_id
    ), placed AS (
        SELECT n.*, prompt_turns, '<|' || role || '|>' || chr(10) AS head,
               n.i > prompt_turns AS rest, length(role) + 5 AS head_chars
        FROM n JOIN prefix USING (pair_id)
    ), ends AS (
        SELECT *, sum(CASE WHEN rest THEN head_chars + length(text) + 1 ELSE 0 END)
                  OVER (PARTITION BY pair_id, chosen ORDER BY i) - 1 AS stop
        FROM placed
    )
    SELECT pair_id, any_value(prompt_turns)::INTEGER AS prompt_turns,
           sha256(coalesce(string_agg(head || text || chr(10), '' ORDER BY i)
                  FILTER (chosen AND NOT rest), '')) AS prompt_sha256,
           sha256(coalesce(string_agg(head || text || chr(10), '' ORDER BY i)
                  FILTER (chosen AND rest), '')) AS chosen_sha256,
           sha256(coalesce(string_agg(head || text || chr(10), '' ORDER BY i)
                  FILTER (NOT chosen AND rest), '')) AS rejected_sha256,
           coalesce(string_agg((stop - length(text))::BIGINT::VARCHAR || '-' || stop::BIGINT::VARCHAR, ',' ORDER BY i)
                  FILTER (chosen AND rest AND role = 'assistant'), '') AS chosen_mask,
           coalesce(string_agg((stop - length(text))::BIGINT::VARCHAR || '-' || stop::BIGINT::VARCHAR, ',' ORDER BY i)
                  FILTER (NOT chosen AND rest AND role = 'assistant'), '') AS rejected_mask
    FROM ends GROUP BY pair_id
    """
)
def op3_preference_pairs(spark, sf_dir):
    """Each conversation (chosen) and its variant with the next one's last answer (rejected) are a pair."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    chosen, rejected = (side.withColumn("chosen", F.lit(i == 0)) for i, side in enumerate(chat.swapped_answers(turns)))
    pairs = chat.preference_pairs(chosen.union(rejected), F.col("conv_id"), F.col("chosen"))

    def spans(mask):
        return F.array_join(F.transform(mask, lambda s: F.concat_ws("-", s["begin"], s["end"])), ",")

    return pairs.select(
        "pair_id",
        "prompt_turns",
        *[F.sha2(c, 256).alias(f"{c}_sha256") for c in ("prompt", "chosen", "rejected")],
        *[spans(F.col(c)).alias(c) for c in ("chosen_mask", "rejected_mask")],
    )


@query(
    """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    ), s AS (
        SELECT a.vec_id AS query_id, b.vec_id,
               list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
        FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
        WHERE a.vec_id % 100 = 0
    ), r AS (
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
               vec_id, score
        FROM s
    )
    SELECT * FROM r WHERE rank <= 10
    """
)
def op4_top_k(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, F.pmod("vec_id", F.lit(100)) == 0, 10)


@query()
def op5_bpe(spark, sf_dir):
    return bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def _license_sql() -> str:
    sentences = ", ".join(f"('{s}', '{i}')" for i, s in licenses.SENTENCES.items())
    rules = []
    for name, rule in licenses.RULES:
        pattern = ".*".join(f" {i} " for i in rule)
        rules.append(f"CASE WHEN regexp_matches(s, '{pattern}') THEN '{name}' END")
    return f"""
    WITH known(sentence, id) AS (VALUES {sentences}),
    parts AS (
        SELECT doc_id, unnest(list_transform(
                   string_split_regex(regexp_replace(coalesce(text, ''), '([.!?])[ \\t\\r]+', '\\1' || chr(10), 'g'), chr(10)),
                   lambda p: lower(trim(regexp_replace(p, '[^A-Za-z0-9]+', ' ', 'g'))))) AS sentence,
               generate_subscripts(
                   string_split_regex(regexp_replace(coalesce(text, ''), '([.!?])[ \\t\\r]+', '\\1' || chr(10), 'g'), chr(10)), 1) AS i
        FROM documents
    ), found AS (
        SELECT doc_id, string_agg(id, ',' ORDER BY i) AS sentences,
               '  ' || string_agg(id, '  ' ORDER BY i) || '  ' AS s
        FROM parts JOIN known USING (sentence) GROUP BY doc_id
    )
    SELECT d.doc_id, coalesce(sentences, '') AS sentences,
           CASE WHEN s IS NULL THEN '' ELSE array_to_string(list_sort(list_distinct(list_filter(
               [{', '.join(rules)}], lambda x: x IS NOT NULL))), ',') END AS licenses
    FROM documents d LEFT JOIN found USING (doc_id)
    """


@query(_license_sql())
def op6_license_scan(spark, sf_dir):
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[F.array_join(c, ",").alias(c) for c in ("sentences", "licenses")])


@query()
def op8_quality(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op9_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@query()
def op10_language(spark, sf_dir):
    return langid.languages(table(spark, sf_dir, "documents"))


@query()
def op7_main_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    model = html_text.learn(pages.select(F.col("page_id").alias("id"), "html"))
    return html_text.main_text(pages.select("page_id", "url", "html"), model)


_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
               string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
               lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 1, 2, 3, 4, 5, 6, 7]),
                   lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))))"""
_SPACE = "[\\x20\\x09-\\x0D]"


@query(
    f"""
    WITH RECURSIVE source AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC32} % 20 AS way
        FROM conversations
    ), damaged AS (
        SELECT conv_id, turn, CASE way WHEN 4 THEN 'user' ELSE role END AS role,
               CASE way WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM source, (VALUES (1), (2)) times(n) WHERE way <> 0 AND (n = 1 OR way = 3)
    ), numbered AS (
        SELECT *, row_number() OVER c AS i, lag(role) OVER c AS before
        FROM damaged WINDOW c AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
    ), turns AS MATERIALIZED (
        SELECT *, CASE WHEN regexp_full_match(text, '{_SPACE}*') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                       WHEN right(regexp_replace(text, '{_SPACE}+$', ''), 1) NOT IN ('.', '!', '?') THEN 'truncated'
                  ELSE 'none' END AS fault
        FROM numbered
    ), inserts(p, q, added, lines) AS (
        VALUES (0, 0, '', []::VARCHAR[]), (0, 2, 'I', ['user:']), (0, 3, 'II', ['user:', 'assistant:']),
               (1, 1, '', []), (1, 2, 'I', ['user:']), (1, 3, 'II', ['user:', 'assistant:']),
               (2, 2, '', []), (2, 3, 'I', ['assistant:']), (3, 3, '', []), (3, 2, 'I', ['user:'])
    ), reads(q, initial, role, t) AS (
        VALUES (0, 's', NULL, 1), (0, 'u', 'user', 2), (1, 'u', 'user', 2), (2, 'a', 'assistant', 3), (3, 'u', 'user', 2)
    ), moves AS MATERIALIZED (
        SELECT p, q AS t, added || 'D' AS audit, 2 * length(added) + 3 AS cost, lines, 'D' AS edit, NULL::VARCHAR AS initial, NULL::VARCHAR AS role
        FROM inserts
        UNION ALL SELECT p, t, added || 'K', 2 * length(added), lines, 'K', initial, NULL FROM inserts JOIN reads USING (q)
        UNION ALL SELECT p, t, added || 'R', 2 * length(added) + 2, lines, 'R', NULL, role FROM inserts JOIN reads USING (q)
        WHERE role IS NOT NULL
    ), walk AS (
        SELECT conv_id, 0::BIGINT AS i, 0 AS state, {{'cost': 0::BIGINT, 'audit': '', 'body': []::VARCHAR[]}} AS best
        FROM (SELECT DISTINCT conv_id FROM conversations)
        UNION ALL
        SELECT w.conv_id, r.i, m.t, min({{
                   'cost': w.best.cost + m.cost + CASE WHEN r.fault = 'truncated' AND m.edit <> 'D' THEN 1 ELSE 0 END,
                   'audit': w.best.audit || m.audit,
                   'body': w.best.body || m.lines || CASE m.edit WHEN 'D' THEN [] ELSE [coalesce(m.role, r.role) || ':' || r.text] END}})
        FROM walk w JOIN turns r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
        JOIN moves m ON m.p = w.state AND (m.edit = 'D' OR (r.fault NOT IN ('blank', 'duplicate')
                        AND (m.edit = 'R' OR m.initial = left(r.role, 1))))
        GROUP BY w.conv_id, r.i, m.t
    ), facts AS (
        SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
               count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
               count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
        FROM turns GROUP BY conv_id
    ), ends(state, added, lines) AS (
        VALUES (0, '', []::VARCHAR[]), (3, '', []), (2, 'I', ['assistant:']), (1, 'II', ['user:', 'assistant:'])
    ), best AS (
        SELECT w.conv_id, min({{'cost': w.best.cost + 2 * length(e.added), 'audit': w.best.audit || e.added,
                               'body': w.best.body || e.lines}}) AS b
        FROM walk w JOIN ends e USING (state) LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM w.conv_id
        WHERE w.i = coalesce(f.n, 0) GROUP BY w.conv_id
    )
    SELECT b.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
           coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
           coalesce(illegal, 0)::BIGINT AS illegal, b.b.cost::BIGINT AS cost, b.b.audit AS audit,
           sha256(array_to_string(b.b.body, chr(10))) AS repaired_sha256
    FROM best b LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM b.conv_id
    """
)
def op11_repair(spark, sf_dir):
    """Conversations damaged by rule, then repaired."""
    turns = table(spark, sf_dir, "conversations")
    return repair.digests(repair.repair(repair.damaged(turns), turns))


def _secrets_sql() -> str:
    """Places of matches from the lengths of the texts between them."""
    patterns = {
        "assign": "".join(
            f"[{c.upper()}{c}]" if c.isalpha() else c for c in "(password|passwd|secret|token|api_?key)"
        )
        + """["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
        "access": "AKIA[A-Z0-9]+",
        "hex": "[0-9a-f]+",
    }
    parts = []
    for i, (kind, pattern) in enumerate(patterns.items()):
        counted = f"regexp_extract_all(t, '{pattern}', 2)[i]" if kind == "assign" else "m[i]"
        least = {"assign": 6, "access": 20, "hex": 24}[kind]
        parts.append(
            f"""SELECT doc_id, n, {i} AS rank, '{kind}' AS kind, start, start + length(m[i]) AS stop FROM (
                SELECT *, (list_sum(list_transform(gaps[:i], lambda x: length(x)))
                          + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0))::BIGINT AS start
                FROM (SELECT doc_id, n, t, regexp_extract_all(t, '{pattern}') AS m, regexp_split_to_array(t, '{pattern}') AS gaps
                      FROM d), unnest(range(1, len(m) + 1)) u(i)
                WHERE length({counted}) >= {least})"""
        )
    return f"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS n, coalesce(text, '') AS t FROM documents),
    found AS ({' UNION ALL '.join(parts)}),
    listed AS (
        SELECT n, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
               count(*) FILTER (kind = 'hex') AS n_hex,
               string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans
        FROM found GROUP BY n
    )
    SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
           coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN listed USING (n)
    """


@query(_secrets_sql())
def op13_secrets(spark, sf_dir):
    """All spans are those of the base rules: the ledger adds none of its own."""
    found = secrets.scan(table(spark, sf_dir, "documents"), secrets.BlobLedger.temporary(spark))
    listed = F.array_join(F.transform("findings", lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(r.kind) for r in secrets.RULES], F.sha2(listed, 256).alias("base_sha256"), listed.alias("spans")
    )


@query(
    """
    WITH v AS (
        SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    ), s AS (
        SELECT a.vec_id AS anchor_id, a.q AS anchor, b.vec_id, a.label = b.label AS same,
               list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
        FROM v a JOIN v b ON len(a.q) = len(b.q) AND (a.vec_id <> b.vec_id OR a.label <> b.label OR a.q <> b.q)
        WHERE a.vec_id % 100 = 0
    ), positives AS (
        SELECT *, row_number() OVER (PARTITION BY anchor_id, anchor ORDER BY score DESC, vec_id) AS n FROM s WHERE same
    ), ranked AS (
        SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score,
               n.score AS negative_score,
               row_number() OVER (PARTITION BY p.anchor_id, p.anchor, p.n ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
        FROM positives p JOIN s n ON n.anchor_id = p.anchor_id AND n.anchor = p.anchor AND NOT n.same
             AND 80 * p.score::HUGEINT <= 100 * n.score::HUGEINT AND n.score <= p.score
        WHERE p.n <= 5
    )
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
    """
)
def op12_hard_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(vectors, F.col("vec_id") % 100 == 0, label)
