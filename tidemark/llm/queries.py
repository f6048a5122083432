"""Queries of the corpus operators and, where SQL can say the same, the SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import url_filter
from .align import align
from .bpe import round_trip
from .common import table
from .decontaminate import contaminated
from .exact_dedup import exact_dedup
from .langid import languages
from .lm import score_texts
from .minhash import near_dedup
from .quality import classified
from .repeats import remove_repeats
from .runs import periodic_runs, planted, run_digests
from .token_files import token_files
from .vectors import near_vectors


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bpe_round_trip": lambda spark, sf_dir: round_trip(table(spark, sf_dir, "documents"), digest=True),
        "op2_quality_classifier": lambda spark, sf_dir: classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
        "op3_repeat_removal": lambda spark, sf_dir: remove_repeats(table(spark, sf_dir, "documents"), digest=True),
        "op4_token_files": lambda spark, sf_dir: token_files(table(spark, sf_dir, "documents")),
        "op5_url_filter": lambda spark, sf_dir: url_filter.filtered(table(spark, sf_dir, "pages")),
        "op6_decontamination": lambda spark, sf_dir: contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
        "op7_lm_scoring": lambda spark, sf_dir: score_texts(table(spark, sf_dir, "documents")),
        "op8_exact_dedup": lambda spark, sf_dir: exact_dedup(table(spark, sf_dir, "documents")),
        "op9_language_id": lambda spark, sf_dir: languages(table(spark, sf_dir, "documents")),
        "op10_minhash": lambda spark, sf_dir: near_dedup(table(spark, sf_dir, "documents"), shingle_words=2),
        "op11_token_alignment": lambda spark, sf_dir: align(table(spark, sf_dir, "documents"), digest=True),
        "op12_periodic_runs": lambda spark, sf_dir: run_digests(periodic_runs(planted(table(spark, sf_dir, "documents")))),
        "op13_embedding_dedup": lambda spark, sf_dir: near_vectors(table(spark, sf_dir, "embeddings")),
    }


#: From links (a, b): reached (a, low), the smallest id that links lead to.
_REACHED = """sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
            walk AS (SELECT a, b FROM sides UNION SELECT walk.a, sides.b FROM walk JOIN sides ON walk.b = sides.a),
            reached AS (SELECT a, min(b) AS low FROM walk GROUP BY a)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op10_minhash": f"""
            WITH RECURSIVE d AS (
                SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
            s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS x FROM d),
            n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
            p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
            links AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
            {_REACHED}
            SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id, d.doc_id <= coalesce(low, d.doc_id) AS kept
            FROM d LEFT JOIN n USING (doc_id) LEFT JOIN reached ON a = d.doc_id
        """,
        "op13_embedding_dedup": f"""
            WITH RECURSIVE v AS (
                SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
                WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding) AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
            links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
            {_REACHED},
            n AS (SELECT a, count(*) AS n FROM sides GROUP BY a)
            SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, vec_id <= coalesce(low, vec_id) AS kept
            FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN reached ON reached.a = vec_id
        """,
        "op5_url_filter": url_filter.ORACLE_SQL,
        "op8_exact_dedup": """
            WITH d AS (
                SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
            SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
                   doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
            FROM d WINDOW w AS (PARTITION BY t)
        """,
    }
