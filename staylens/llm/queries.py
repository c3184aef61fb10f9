"""The operators as queries on the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import (
    align,
    decontaminate,
    html_text,
    language_model,
    manifest,
    packing,
    pieces,
    quality,
    secret_scan,
    simhash,
    spans,
    topk,
    wavelet,
)
from staylens.llm.common import on_workers, table
from staylens.session import work_path


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.dedup(table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_path(spark, "wavelet_shards")
    wavelet.write_shards(table(spark, sf_dir, "documents"), folder)
    found = wavelet.read_documents(wavelet.read_shards(spark, folder))
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scored(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, checked against texts of which half have lost their line breaks."""
    text = F.col("text")
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    claim = {"text": F.when(odd, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)}
    found = manifest.manifest(table(spark, sf_dir, "documents"), claim=claim)
    proof = F.sha2(F.array_join("proof", "").cast("binary"), 256).alias("proof_sha256")
    return found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    found = pieces.encoded(table(spark, sf_dir, "documents"))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups, links and link counts of the two tokenizers over all documents."""
    return align.statistics(table(spark, sf_dir, "documents"))


def _ready(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        on_workers(spark)
        return query(spark, sf_dir)

    run.__name__ = query.__name__
    return run


QUERIES = {
    f.__name__: _ready(f)
    for f in (
        op1_exact_topk,
        op2_quality_classifier,
        op3_simhash_near_dedup,
        op4_html_extraction,
        op5_secret_scan,
        op6_substring_dedup,
        op7_benchmark_decontamination,
        op8_wavelet_tokens,
        op9_language_model,
        op10_best_fit_packing,
        op11_merkle_manifest,
        op12_sentencepiece,
        op13_token_alignment,
    )
}

#: Where SQL can say the whole of an operator; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op1_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 20 = 0
        ), r AS (
            SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
    """,
    "op7_benchmark_decontamination": r"""
        WITH lower_case AS (
            SELECT 'd' AS side, doc_id::VARCHAR AS id, row_number() OVER () AS r,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
            UNION ALL
            SELECT 'b', item_id::VARCHAR, row_number() OVER (),
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
            FROM benchmark WHERE item_id IS NOT NULL
        ), w AS (
            SELECT side, id, r, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM lower_case
        ), g AS (
            SELECT DISTINCT id, n, array_to_string(words[i : i + n - 1], ' ') AS gram
            FROM (SELECT id, words, n, unnest(range(1, len(words) - n + 2)) AS i
                  FROM (SELECT id, words, least(10, len(words)) AS n FROM w WHERE side = 'b' AND len(words) > 0))
        ), p AS (
            SELECT r, i, n, array_to_string(words[i : i + n - 1], ' ') AS gram
            FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS i
                  FROM w, (SELECT DISTINCT n FROM g) WHERE side = 'd' AND len(words) >= n)
        ), h AS (
            SELECT p.r, p.i, p.n, g.id FROM p JOIN g USING (n, gram)
        ), n_hit AS (
            SELECT r, count(DISTINCT pos) AS n FROM (SELECT r, unnest(range(i, i + n)) AS pos FROM h) GROUP BY r
        ), items AS (
            SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, id FROM h) GROUP BY r
        )
        SELECT w.id::BIGINT AS doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit.n, 0)::BIGINT AS n_hit,
               coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               n_hit.n IS NOT NULL AS contaminated
        FROM w LEFT JOIN n_hit USING (r) LEFT JOIN items USING (r) WHERE side = 'd'
    """,
    # A tree is a source; tree 0 is the one over the sources.  crc32 is spelt out bit by bit.
    "op11_merkle_manifest": r"""
        WITH RECURSIVE said AS (
            SELECT row_number() OVER () AS r, doc_id, source, text,
                   concat(CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END,
                          CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END,
                          CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END,
                          CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END) AS head,
                   (list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::UBIGINT)),
                       lambda c, b: list_reduce([xor(c, b), 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT,
                                                 0::UBIGINT, 0::UBIGINT, 0::UBIGINT],
                           lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1::UBIGINT)) + y)) & 1) = 1 AS even
            FROM documents
        ), leaves AS (
            SELECT *, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
                   CASE WHEN even THEN replace(text, chr(10), '') ELSE text END AS shown
            FROM said
        ), placed AS (
            SELECT r, doc_id, leaf, sha256(head || CASE WHEN shown IS NULL THEN '-' ELSE strlen(shown) || ':' || shown END) AS claimed,
                   dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                   count(*) OVER (PARTITION BY source) AS n
            FROM leaves
        ), up AS (
            SELECT tree, 0 AS level, pos, n, leaf AS h FROM placed
            UNION ALL
            SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
            FROM up WHERE n > 1 GROUP BY tree, level, pos // 3, n
        ), subroots AS (
            SELECT tree, level AS height, h FROM up WHERE n = 1
        ), over AS (
            SELECT 0 AS tree, 0 AS level, tree - 1 AS pos, (SELECT count(*) FROM subroots) AS n, h FROM subroots
            UNION ALL
            SELECT 0, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
            FROM over WHERE n > 1 GROUP BY level, pos // 3, n
        ), nodes AS (
            SELECT * FROM up WHERE n > 1 UNION ALL SELECT * FROM over WHERE n > 1
        ), ways AS (
            SELECT r, p.tree, height, level, (pos // (3 ** level)::BIGINT)::BIGINT AS at, level AS step
            FROM placed p JOIN subroots s USING (tree), unnest(range(height)) t(level)
            UNION ALL
            SELECT r, 0, height, level, ((tree - 1) // (3 ** level)::BIGINT)::BIGINT, height + level
            FROM placed p JOIN subroots s USING (tree), (SELECT DISTINCT level FROM over WHERE n > 1)
        ), steps AS (
            SELECT w.r, w.step, coalesce(string_agg(x.h, '' ORDER BY x.pos) FILTER (x.pos < w.at), '') AS before,
                   coalesce(string_agg(x.h, '' ORDER BY x.pos) FILTER (x.pos > w.at), '') AS after
            FROM ways w JOIN nodes x ON x.tree = w.tree AND x.level = w.level AND x.pos // 3 = w.at // 3
            GROUP BY w.r, w.step
        ), folded AS (
            SELECT r, 0 AS step, claimed AS h FROM placed
            UNION ALL
            SELECT f.r, f.step + 1, sha256(s.before || f.h || s.after) FROM folded f JOIN steps s ON s.r = f.r AND s.step = f.step
        ), ends AS (
            SELECT r, arg_max(h, step) AS folded_root FROM folded GROUP BY r
        ), proofs AS (
            SELECT r, sha256(string_agg(before || after, '' ORDER BY step)) AS proof_sha256 FROM steps GROUP BY r
        ), top AS (
            SELECT h AS root FROM over WHERE n = 1
        )
        SELECT p.doc_id, p.leaf, s.h AS subroot, top.root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
               e.folded_root, e.folded_root = top.root AS verified
        FROM placed p JOIN subroots s USING (tree) JOIN ends e USING (r) LEFT JOIN proofs USING (r), top
    """,
}
