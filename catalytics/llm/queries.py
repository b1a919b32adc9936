"""The operators bound to the driver's tables: opN_<name> for operator N, and SQL for
those that SQL can answer.  Each reads its whole table with production parameters."""

from __future__ import annotations

import math
import os
import zlib
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import catalytics
from catalytics.llm import (
    chat_format,
    exact_dedup,
    jaccard_join,
    licence_scan,
    near_vectors,
    packing,
    periodic_runs,
    quality,
    secrets,
    sentence_pieces,
    suffix_tree,
    url_filter,
    vector_codes,
)
from catalytics.llm.common import read_table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def bound(query):
    """Python workers find this package where the driver has it, wherever they start."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        here = str(Path(catalytics.__file__).resolve().parents[1])
        known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(dict.fromkeys([here, *filter(None, known)]))
        return query(spark, sf_dir)

    return run


def op1_url_filter(spark, sf_dir):
    judged = url_filter.judge(read_table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _url_filter_sql() -> str:
    """Rules written out; rounds until what is left to bring is below the tolerance."""
    rules = ", ".join(f"('{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{v}')" for r, v in url_filter.RULES.items())
    d = url_filter.DAMPING
    rounds = math.ceil(math.log(url_filter.TOLERANCE) / math.log(d))
    return rf"""
        WITH RECURSIVE rule(rule, rule_host, rule_path, rule_verdict) AS (VALUES {rules}),
        page AS (
            SELECT page_id, coalesce(html, '') AS html,
                   translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages),
        fit AS (
            SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(rule_verdict, length(rule)) AS by_rule
            FROM page JOIN rule ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY 1),
        judged AS (SELECT p.*, rule, by_rule FROM page p LEFT JOIN fit USING (page_id)),
        href AS (
            SELECT host AS source, unnest(regexp_extract_all(html, '(?i)href\s*=\s*["'']?((?:[a-z][a-z0-9+.-]*:)?//[^"''\s>]+)', 1)) AS link FROM page),
        link AS (
            SELECT source, translate(regexp_extract(CASE WHEN link LIKE '//%' THEN 'http:' || link ELSE link END, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS target,
                   count(*) AS n FROM href GROUP BY 1, 2),
        arc0 AS (
            SELECT 'allow' AS kind, source AS node, target AS dest, n FROM link WHERE source <> target AND source <> '' AND target <> ''
            UNION ALL
            SELECT 'block', target, source, n FROM link WHERE source <> target AND source <> '' AND target <> ''),
        arc AS (SELECT kind, node, dest, n / sum(n) OVER (PARTITION BY kind, node) AS share FROM arc0),
        s0 AS (
            SELECT by_rule AS kind, host AS node, {1 - d} * count(*) / sum(count(*)) OVER (PARTITION BY by_rule) AS score
            FROM judged WHERE by_rule IS NOT NULL AND host <> '' GROUP BY 1, 2),
        walk(kind, node, score, k) AS (
            SELECT kind, node, score, 0 FROM s0
            UNION ALL
            SELECT a.kind, a.dest, sum({d} * w.score * a.share), w.k + 1
            FROM walk w JOIN arc a ON a.kind = w.kind AND a.node = w.node WHERE w.k < {rounds} GROUP BY a.kind, a.dest, w.k),
        host AS (
            SELECT node AS host, coalesce(sum(score) FILTER (kind = 'allow'), 0) AS trust,
                   coalesce(sum(score) FILTER (kind = 'block'), 0) AS distrust FROM walk GROUP BY 1)
        SELECT page_id, host, path, rule,
               coalesce(by_rule, CASE WHEN distrust > 0 AND distrust >= {url_filter.THRESHOLD} * trust THEN 'block' ELSE 'allow' END) AS verdict
        FROM judged LEFT JOIN host USING (host)"""


def op2_sentence_pieces(spark, sf_dir):
    vocabulary = sentence_pieces.load(tokenizer_file("piece_bpe_32k.model"))
    rows = sentence_pieces.encode(read_table(spark, sf_dir, "documents"), vocabulary)
    decoded = sentence_pieces.decode(F.col("ids"), vocabulary)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", (decoded == F.col("text")).alias("round_trip"))


def op3_packing(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket")
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"), with_ids=False).select(*columns)


def op4_suffix_tree(spark, sf_dir):
    return suffix_tree.score(read_table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark, sf_dir):
    return jaccard_join.link_components(read_table(spark, sf_dir, "documents"))


def op6_licence_scan(spark, sf_dir):
    return licence_scan.scan(read_table(spark, sf_dir, "documents"))


def op7_secret_scan(spark, sf_dir):
    return secrets.scan(read_table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark, sf_dir):
    rows, _, _ = exact_dedup.classes(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_quality_rules(spark, sf_dir):
    judged, name = quality.judge(read_table(spark, sf_dir, "documents"), columns=["doc_id"])
    return judged.select("doc_id", f"{name}.*")


def op10_chat_format(spark, sf_dir):
    return chat_format.format_chats(read_table(spark, sf_dir, "conversations"))


def op11_vector_codes(spark, sf_dir):
    coded, codebooks = vector_codes.compress(read_table(spark, sf_dir, "embeddings"))
    named = vector_codes.label_errors(coded).withColumn("codebooks_sha256", F.lit(vector_codes.digest(codebooks)))
    return named.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


def op12_near_vectors(spark, sf_dir):
    return near_vectors.link_vectors(read_table(spark, sf_dir, "embeddings"))


def made_periodic(doc_id, words: list) -> list:
    """The query's own input: for a tenth of the ids, words from a on repeat with period p."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op13_periodic_runs(spark, sf_dir):
    found = periodic_runs.scan(read_table(spark, sf_dir, "documents"), change=made_periodic)
    longest = periodic_runs.longest()
    length = -longest["less"]
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[k].cast("string") for k in ("start", "length", "period")]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        longest["start"].alias("start"),
        length.alias("length"),
        longest["period"].alias("period"),
        F.floor(1000 * length / longest["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    q.__name__: bound(q)
    for q in (
        op1_url_filter,
        op2_sentence_pieces,
        op3_packing,
        op4_suffix_tree,
        op5_jaccard_join,
        op6_licence_scan,
        op7_secret_scan,
        op8_exact_dedup,
        op9_quality_rules,
        op10_chat_format,
        op11_vector_codes,
        op12_near_vectors,
        op13_periodic_runs,
    )
}



def _vector_codes_sql() -> str:
    """The rounds written out: n<k> assigns by b<k>, b<k+1> holds the floors of the means."""
    per, last = vector_codes.PARTS, vector_codes.ROUNDS
    rounds = []
    for k in range(last + 1):
        rounds.append(f"""
        n{k} AS (SELECT id, p, any_value(w) AS w, min(struct_pack(d := list_sum(list_transform(list_zip(w, c), lambda z: (z[1] - z[2]) ** 2))::BIGINT, e := e)) AS best
               FROM part JOIN b{k} USING (p) GROUP BY id, p)""")
        if k < last:
            rounds.append(f"""
        m{k} AS (SELECT p, e, list(floor(s / n)::BIGINT ORDER BY i) AS c FROM (
                   SELECT p, best.e AS e, i, sum(w[i])::DOUBLE AS s, count(*) AS n
                   FROM n{k}, (SELECT unnest(range(1, (SELECT max(len(w)) FROM part) + 1)) AS i) GROUP BY ALL) GROUP BY p, e),
        b{k + 1} AS (SELECT p, e, coalesce(m{k}.c, b{k}.c) AS c FROM b{k} LEFT JOIN m{k} USING (p, e))""")
    return f"""
        WITH kept AS (
            SELECT vec_id AS id, label, list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::DOUBLE)::BIGINT) AS v
            FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        part AS (SELECT id, label, p, v[p * (len(v) // {per}) + 1 : (p + 1) * (len(v) // {per})] AS w FROM kept, range({per}) t(p)),
        b0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY id) - 1 AS e, w AS c FROM part
               WHERE id IN (SELECT id FROM kept ORDER BY id LIMIT {vector_codes.ENTRIES})),{",".join(rounds)},
        coded AS (SELECT id, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM n{last} GROUP BY id)
        SELECT id AS vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM b{last}) AS codebooks_sha256
        FROM coded JOIN kept USING (id)"""


ORACLE_SQL = {
    "op11_vector_codes": _vector_codes_sql(),
    "op12_near_vectors": f"""
        WITH RECURSIVE able AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
            WHERE label IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        link AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM able a JOIN able b
            ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= {near_vectors.THRESHOLD}),
        reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(least_id, vec_id)) AS component_id,
               vec_id <= coalesce(least_id, vec_id) AS kept
        FROM embeddings LEFT JOIN (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY 1) USING (vec_id)
             LEFT JOIN (SELECT a AS vec_id, min(b) AS least_id FROM reach GROUP BY 1) USING (vec_id)""",
    "op1_url_filter": _url_filter_sql(),
    "op10_chat_format": r"""
        WITH turns AS (
            SELECT DISTINCT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text
            FROM conversations WHERE conv_id IS NOT NULL),
        chat AS (
            SELECT conv_id, count(*) AS n_turns,
                   list(struct_pack(role, text) ORDER BY turn NULLS FIRST, role, text) AS said,
                   string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), ''
                              ORDER BY turn NULLS FIRST, role, text) AS chat
            FROM turns GROUP BY conv_id),
        single AS (
            SELECT min(conv_id) AS conv_id, any_value(n_turns) AS n_turns, count(*) AS n_equal, said, any_value(chat) AS chat
            FROM chat GROUP BY said)
        SELECT conv_id, n_turns, n_equal, chat FROM single s
        WHERE NOT EXISTS (SELECT 1 FROM chat l WHERE l.said[1] = s.said[1] AND l.n_turns > s.n_turns
                          AND l.said[1:s.n_turns] = s.said)""",
    "op5_jaccard_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        cut AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                   ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END AS s FROM words),
        shingle AS (SELECT DISTINCT doc_id, unnest(s) AS s FROM cut),
        size AS (SELECT c.doc_id, count(s.s) AS n FROM cut c LEFT JOIN shingle s USING (doc_id) GROUP BY 1),
        link AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id
            GROUP BY 1, 2
            HAVING 100 * count(*) >= 85 * ((SELECT n FROM size z WHERE z.doc_id = a.doc_id)
                                         + (SELECT n FROM size z WHERE z.doc_id = b.doc_id) - count(*))),
        reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
        SELECT z.doc_id, z.n AS n_shingles, least(z.doc_id, coalesce(min(r.b), z.doc_id)) AS component_id
        FROM size z LEFT JOIN reach r ON r.a = z.doc_id GROUP BY z.doc_id, z.n""",
    "op8_exact_dedup": r"""
        WITH form AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS normal FROM documents)
        SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY normal) AS group_size,
               doc_id = first_value(doc_id) OVER best AS kept, sha256(normal) AS text_sha256
        FROM form WINDOW best AS (PARTITION BY normal ORDER BY length(text) DESC, doc_id)""",
}
