"""Queries of the operators on the driver's tables: one for each, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer's vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op8_exact_dedup", """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""")
def _(spark, folder):
    from catalogflow.llm.exact_dedup import exact_groups

    return exact_groups(table(spark, folder, "documents"))


@query("op1_pii")
def _(spark, folder):
    from catalogflow.llm.pii import find_pii

    return find_pii(table(spark, folder, "documents"))


@query("op4_secret_scan")
def _(spark, folder):
    from catalogflow.llm.secret_scan import find_secrets

    return find_secrets(table(spark, folder, "documents"))


@query("op2_token_store")
def _(spark, folder):
    from catalogflow.llm.token_store import store_and_digest

    return store_and_digest(table(spark, folder, "documents"), tokenizer_path())


@query("op7_line_dedup", """
WITH lines AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
starts AS (
    SELECT doc_id, l, unnest(range(0, len(l) - 2)) AS pos FROM lines WHERE len(l) >= 3),
windows AS (
    SELECT doc_id, pos, l[pos + 1] || chr(10) || l[pos + 2] || chr(10) || l[pos + 3] AS w FROM starts
    WHERE trim(l[pos + 1], ' ') <> '' OR trim(l[pos + 2], ' ') <> '' OR trim(l[pos + 3], ' ') <> ''),
firsts AS (
    SELECT w, min((doc_id, pos)) AS f FROM windows GROUP BY w HAVING count(*) > 1),
gone AS (
    SELECT DISTINCT doc_id, pos + k AS line FROM windows JOIN firsts USING (w), (SELECT unnest([0, 1, 2]) AS k)
    WHERE doc_id <> f[1] OR pos >= f[2] + 3),
numbered AS (
    SELECT doc_id, unnest(l) AS line_text, unnest(range(0, len(l))) AS line FROM lines),
rest AS (
    SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id),
kept AS (
    SELECT doc_id, string_agg(line_text, chr(10) ORDER BY line) AS text FROM numbered ANTI JOIN gone USING (doc_id, line)
    GROUP BY doc_id)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(kept.text, '') AS text
FROM lines LEFT JOIN rest USING (doc_id) LEFT JOIN kept USING (doc_id)""")
def _(spark, folder):
    from catalogflow.llm.line_dedup import dedup_lines

    return dedup_lines(table(spark, folder, "documents"))


@query("op5_jaccard_join")
def _(spark, folder):
    from catalogflow.llm.jaccard_join import shingle_components

    return shingle_components(table(spark, folder, "documents"))


@query("op3_decontaminate", """
WITH words AS (
    SELECT doc_id AS id, 'd' AS side, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(?:[a-z0-9]|[^\\x00-\\x7F])+') AS w
    FROM documents UNION ALL
    SELECT item_id, 'i', regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(?:[a-z0-9]|[^\\x00-\\x7F])+')
    FROM benchmark),
starts AS (SELECT id, side, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5),
shingles AS (SELECT DISTINCT id, side, array_to_string(w[i:i + 4], ' ') AS s FROM starts),
items AS (SELECT id AS item_id, s, count(*) OVER (PARTITION BY id) AS n_item FROM shingles WHERE side = 'i')
SELECT d.id AS doc_id, item_id, n_item, count(*) AS n_common, count(*) / n_item AS containment
FROM items JOIN shingles d USING (s) WHERE d.side = 'd'
GROUP BY d.id, item_id, n_item HAVING count(*) * 5 >= n_item * 4""")
def _(spark, folder):
    from catalogflow.llm.decontaminate import find_leaks

    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op6_mixing")
def _(spark, folder):
    from catalogflow.llm.mixing import schedule

    return schedule(table(spark, folder, "documents"))


@query("op9_token_counts")
def _(spark, folder):
    """Counts before and after the personal data of every text is redacted."""
    import public_tokenizers
    from pyspark.sql import functions as F

    from catalogflow.llm import edit_counts as ec
    from catalogflow.llm.common import whole_text

    docs = table(spark, folder, "documents").select("doc_id", whole_text().alias("text"))
    docs = docs.withColumn("edits", ec.redactions(F.col("text")))
    path = tokenizer_path("byte_bpe_50k.json")
    trees = ec.build_trees(docs, path, public_tokenizers.PATTERN)
    return ec.apply_edits(trees, path, public_tokenizers.PATTERN, whole=False)


@query("op10_toxicity")
def _(spark, folder):
    from catalogflow.llm.toxicity import rate_toxicity

    return rate_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op13_divergence_audit", r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t
    FROM documents),
occ AS (SELECT rid, lang, source, unnest(t) AS term FROM d),
kept AS (SELECT lang, term FROM (SELECT DISTINCT rid, lang, term FROM occ) GROUP BY lang, term HAVING count(*) >= 3),
vs AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
gc AS (SELECT lang, source, term, count(*) AS c FROM occ SEMI JOIN kept USING (lang, term) GROUP BY ALL),
grid AS (
    SELECT g.lang, g.source, k.term, coalesce(gc.c, 0) AS c
    FROM groups g JOIN kept k USING (lang) LEFT JOIN gc USING (lang, source, term)),
gn AS (SELECT lang, source, sum(c) AS n FROM grid GROUP BY ALL),
gp AS (
    SELECT lang, source, term, c, 1 + ((c + 1)::HUGEINT * 1000000000) // (n + v) AS p
    FROM grid JOIN gn USING (lang, source) JOIN vs USING (lang)),
lc AS (SELECT lang, term, sum(c) AS c FROM grid GROUP BY ALL),
ln AS (SELECT lang, sum(c) AS n FROM lc GROUP BY ALL),
lp AS (SELECT lang, term, 1 + ((c + 1)::HUGEINT * 1000000000) // (n + v) AS p FROM lc JOIN ln USING (lang) JOIN vs USING (lang)),
pair AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
        coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // y.p) FROM gp x JOIN gp y USING (lang, term)
                  WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source),
term AS (
    SELECT gp.lang, gp.source, 'term' AS part, gp.term AS item, (gp.p - lp.p) * (gp.p - lp.p) // lp.p AS value
    FROM gp JOIN lp USING (lang, term) WHERE gp.c > 0 AND gp.p > lp.p),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r
    FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR r <= 200""")
def _(spark, folder):
    from catalogflow.llm.divergence import audit

    return audit(table(spark, folder, "documents"))


@query("op11_quality_rules", r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
    SELECT rid, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM d),
windows AS (
    SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
    FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
rep AS (SELECT rid, win FROM windows GROUP BY rid, win HAVING count(*) >= 2),
covered AS (
    SELECT rid, count(DISTINCT i + k) AS n FROM windows JOIN rep USING (rid, win), (SELECT unnest([0, 1, 2]) AS k)
    GROUP BY rid),
m AS (
    SELECT doc_id, words, lines, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_word_lines,
        CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
    FROM w LEFT JOIN covered USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT (
        word_chars < 3 * n_words OR word_chars > 10 * n_words
        OR 10 * n_symbols > n_words
        OR 10 * n_dup_lines > 3 * n_word_lines
        OR 10 * len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) < 8 * n_words
        OR 10 * len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…)[\x20\x09-\x0D]*\z'))) > 3 * n_word_lines
        OR 10 * len(list_filter(lines, lambda l: regexp_matches(l, '^[\x20\x09-\x0D]*[-*•‣◦]'))) > 9 * n_word_lines
    ) AS kept
FROM b""")
def _(spark, folder):
    from catalogflow.llm.quality_rules import quality_rules

    return quality_rules(table(spark, folder, "documents")).drop("rejected_by")


@query("op12_hard_negatives", r"""
WITH c AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
    SELECT a.vec_id AS aid, a.label AS alab, r.vec_id AS rid, r.label AS rlab,
        coalesce(list_sum(list_transform(range(1, greatest(len(a.v), len(r.v)) + 1),
            lambda i: coalesce(a.v[i], 0) * coalesce(r.v[i], 0))), 0)::BIGINT AS score
    FROM c a, c r WHERE a.vec_id % 100 = 0),
pos AS (
    SELECT aid, rid AS pid, score AS ps FROM (
        SELECT *, row_number() OVER (PARTITION BY aid ORDER BY score DESC, rid) AS k
        FROM s WHERE rlab = alab AND rid <> aid) WHERE k <= 5),
neg AS (
    SELECT pos.aid, pid, ps, s.rid, s.score,
        row_number() OVER (PARTITION BY pos.aid, pid ORDER BY s.score DESC, s.rid) AS k
    FROM pos JOIN s ON s.aid = pos.aid
    WHERE s.rlab <> s.alab AND 80 * ps <= 100 * s.score AND 100 * s.score <= 100 * ps)
SELECT aid AS anchor_id, pid AS positive_id, CAST(k AS INTEGER) AS rank, rid AS negative_id,
    ps AS positive_score, score AS negative_score
FROM neg WHERE k <= 5""")
def _(spark, folder):
    from catalogflow.llm.hard_negatives import mine_hard_negatives

    return mine_hard_negatives(table(spark, folder, "embeddings"))
