"""The operators as named queries over the given tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.llm.common import table
from ledgerlift.llm.cotraining import with_quality
from ledgerlift.llm.filter_audit import audit
from ledgerlift.llm.line_dedup import remove_boilerplate
from ledgerlift.llm.mixing import Mix, mix_sources
from ledgerlift.llm.packing import pack
from ledgerlift.llm.parity_join import near_duplicates, with_components
from ledgerlift.llm.pieces import round_trip
from ledgerlift.llm.pii import pii_digest
from ledgerlift.llm.prefix_trie import prefix_trie
from ledgerlift.llm.simhash import edited_fingerprints, with_neighbours
from ledgerlift.llm.suffix_dedup import remove_repeats
from ledgerlift.llm.topk import top_k
from ledgerlift.llm.warc import warc_round_trip


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(table(spark, sf_dir, "pages")).drop("target_uri")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = remove_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return clean.select("row.doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), Mix(most_repeats=2.0))
    return mixed.select("row.doc_id", "source", "tokens", "epoch", "block", "place")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_neighbours(edited_fingerprints(table(spark, sf_dir, "documents")))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = with_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("row.doc_id", "p_text", "p_meta", "p", "keep")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack(docs, clusters=with_components(docs, words=5, percent=80))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=85)


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    return round_trip(table(spark, sf_dir, "documents"), model)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_line_dedup": op2_line_dedup,
    "op3_pii": op3_pii,
    "op4_mixing": op4_mixing,
    "op5_simhash": op5_simhash,
    "op6_quality": op6_quality,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_topk": op8_topk,
    "op9_packing": op9_packing,
    "op10_ngram_join": op10_ngram_join,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_filter_audit": op12_filter_audit,
    "op13_prefix_trie": op13_prefix_trie,
    "pipeline": pipeline,
}

SQL: dict[str, str] = {
    "op1_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
             g AS (SELECT html, min(page_id) AS first FROM p WHERE strlen(html) >= 100 GROUP BY html)
        SELECT page_id, strlen(p.html) AS payload_bytes, sha256(p.html) AS payload_digest,
               CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM p LEFT JOIN g ON p.html = g.html
    """,
    "op2_line_dedup": r"""
        WITH l AS (SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents),
             b AS (SELECT trim(line, ' ') AS bad FROM l WHERE trim(line, ' ') <> '' GROUP BY ALL
                   HAVING count(DISTINCT source) >= 10),
             m AS (SELECT * FROM l LEFT JOIN b ON trim(line, ' ') = bad)
        SELECT doc_id, count(*) AS n_lines, count(bad) AS n_removed,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (bad IS NULL), '')) AS kept_sha256
        FROM m GROUP BY doc_id
    """,
    "op4_mixing": r"""
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens
                   FROM documents),
             t AS (SELECT source, sum(tokens)::BIGINT AS total,
                          sum(tokens) / (SELECT sum(tokens)::DOUBLE FROM d) AS share FROM d GROUP BY source),
             a AS (SELECT min(p) / 1048576.0::DOUBLE AS a FROM range(0, 1048577) r(p)
                   WHERE pow((SELECT max(share) / min(share) FROM t), 1 - p / 1048576.0::DOUBLE) <= 2.0),
             w AS (SELECT source, total, pow(share, a) AS power FROM t, a),
             n AS (SELECT ceil(max(total / power) * sum(power) - 1e-6) AS tokens, sum(power) AS z FROM w),
             b AS (SELECT source, total, greatest(floor(power / z * tokens + 1e-6)::BIGINT, total) AS budget,
                          ceil(tokens / 1048576)::BIGINT AS blocks FROM w, n),
             e AS (SELECT d.*, total, budget, blocks, epoch,
                          ('0x' || md5('0:' || epoch || ':' || doc_id)[1:15])::BIGINT AS hash
                   FROM d JOIN b USING (source), range(0, 100) r(epoch)
                   WHERE epoch < greatest(1, ceil(budget / total::DOUBLE))),
             s AS (SELECT *, total * epoch + coalesce(sum(tokens) OVER (
                          PARTITION BY source, epoch ORDER BY hash, doc_id::VARCHAR
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM e),
             k AS (SELECT *, least(floor(start / budget::DOUBLE * blocks)::BIGINT, blocks - 1) AS block FROM s
                   WHERE start < budget OR epoch = 0)
        SELECT doc_id, source, tokens, epoch, block,
               row_number() OVER (PARTITION BY block ORDER BY hash, doc_id::VARCHAR, source) - 1 AS place
        FROM k
    """,
    "op8_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
                   WHERE embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
             s AS (SELECT q.vec_id AS query_id, c.vec_id,
                          list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
                   FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
             r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op12_filter_audit": r"""
        WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                          regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
             q AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS bad FROM labels GROUP BY doc_id),
             f AS (SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad,
                          [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
                           100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t), regexp_matches(t, '[#$%&*|]'),
                           coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)] AS fails
                   FROM d LEFT JOIN q ON d.doc_id = q.doc_id),
             g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad
                   FROM f GROUP BY ALL),
             l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
             o AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM l a, l b, l c, l d, l e
                   WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
             m AS (SELECT g.*, filter_order, list_min([CASE WHEN fails[i] THEN strpos(filter_order, chr(64 + i)) ELSE 9 END
                          FOR i IN [1, 2, 3, 4, 5]]) AS gone FROM g, o),
             s AS (SELECT part, filter_order, step, filter, coalesce(sum(n) FILTER (gone > step), 0) AS kept,
                          coalesce(sum(n) FILTER (gone = step), 0) AS removed,
                          coalesce(sum(n) FILTER (gone < step AND fails[k]), 0) AS redundant,
                          coalesce(sum(n) FILTER (fails[k] AND len(list_filter(fails, lambda x: x)) = 1), 0) AS unique_fails,
                          coalesce(sum(good) FILTER (gone = step), 0) AS good_lost,
                          coalesce(sum(bad) FILTER (gone = step), 0) AS toxic_lost
                   FROM (SELECT *, filter_order[step] AS filter, ascii(filter_order[step]) - 64 AS k
                         FROM m, range(1, 6) r(step)) GROUP BY ALL)
        SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
               redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
               toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley
        FROM s
    """,
    "op13_prefix_trie": r"""
        WITH t AS (SELECT conv_id, struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) AS turn,
                          row_number() OVER (PARTITION BY conv_id
                                             ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
                   FROM conversations WHERE conv_id IS NOT NULL),
             c AS (SELECT conv_id, list(turn ORDER BY place) AS turns FROM t GROUP BY conv_id),
             h AS (SELECT *, xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
                                 lambda s, b: list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1
                                     THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(s, b)), 4294967295),
                                 4294967295) % 6 AS h FROM c),
             r AS (SELECT a.conv_id, list_concat(coalesce(b.turns[1:h], []), a.turns[h + 1:]) AS turns
                   FROM h a LEFT JOIN c b ON b.conv_id = a.conv_id - a.conv_id % 100),
             p AS (SELECT conv_id, d AS depth, len(turns) AS l,
                          CASE WHEN d = 0 THEN 0 ELSE length(turns[d].text) END AS chars,
                          sha256(d || ':' || array_to_string(list_transform(turns[1:d], lambda x:
                              length(x.role) || ':' || length(x.text) || ':' || x.role || x.text), '')) AS node,
                          sha256((d - 1) || ':' || array_to_string(list_transform(turns[1:d - 1], lambda x:
                              length(x.role) || ':' || length(x.text) || ':' || x.role || x.text), '')) AS parent
                   FROM r, unnest(range(len(turns) + 1)) u(d)),
             n AS (SELECT node, min(conv_id) AS conv_id, depth, any_value(parent) AS parent, count(*) AS n_convs,
                          any_value(chars) AS chars,
                          sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (l = depth), '')) AS ends_sha256
                   FROM p GROUP BY node, depth),
             k AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY parent),
             s AS (SELECT p.node, count(*) FILTER (k.node IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved
                   FROM n LEFT JOIN k ON n.node = k.node JOIN p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.node)
        SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
               saved::BIGINT AS saved_tokens, n.ends_sha256
        FROM n LEFT JOIN k ON n.node = k.node JOIN s ON n.node = s.node
             LEFT JOIN n u ON n.depth > 0 AND u.node = n.parent
    """,
}
