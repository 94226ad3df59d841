"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    bpe_codec,
    concurrency,
    exact_dedup,
    ngram_join,
    packing,
    pii,
    quality_rules,
    resampling,
    token_counts,
    toxicity,
    training_order,
    warc,
)
from .common import cut, new_path, table


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip_digests(table(spark, sf_dir, "documents"))


def op2_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.materialise(table(spark, sf_dir, "documents"))


def op3_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    verdicts = quality_rules.quality_verdicts(docs, table(spark, sf_dir, "labels"))
    return verdicts.select("doc_id", "_quality.*")


def _multi_counts(texts: list[str]) -> list[int]:
    encode = training_order.encoder(bpe_codec.rank_file()).encode_ordinary
    return [len(encode(text)) for text in texts]


def _word_counts(texts: list[str]) -> list[int]:
    return [len(text.split()) for text in texts]


def _plain_counts(texts: list[str]) -> list[int]:
    encode = training_order.encoder().encode_ordinary
    return [len(encode(text)) for text in texts]


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after loads, a revision of every count, a deletion and a new load of every row.

    Both tokenizer versions come in as a provisional count (words) that a second batch
    revises to the library's count; one version is then deleted and loaded again, and each
    batch is sent twice, of which one counts.
    """
    docs = table(spark, sf_dir, "documents")
    rollup = token_counts.Rollup(spark, new_path(spark, "token-counts"))

    def send(name: str, changes: DataFrame) -> None:
        rollup.commit(name, changes)
        rollup.commit(name, changes)

    for version, count in (("byte_bpe_50k", _plain_counts), ("byte_bpe_multi_50k", _multi_counts)):
        exact = cut(token_counts.count_tokens(docs, version, count, _word_counts), f"counts-{version}")
        words = exact.withColumn("n_tokens", F.col("n_provisional"))
        send(f"load/{version}", token_counts.inserts(words))
        send(f"revise/{version}", token_counts.revisions(words, exact))
        if version == "byte_bpe_50k":
            send(f"drop/{version}", token_counts.deletes(exact))
            send(f"reload/{version}", token_counts.inserts(exact))
        rollup.compact()
    return rollup.totals()


def op7_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.page_responses(table(spark, sf_dir, "pages")))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find_personal_data(table(spark, sf_dir, "documents")))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op11_concurrency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concurrency.peak_concurrency(*(table(spark, sf_dir, name) for name in ("sales", "sale_lines", "clients")))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.linked_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_training_order": op2_training_order,
    "op3_importance_resampling": op3_importance_resampling,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_quality_rules": op6_quality_rules,
    "op7_warc_derivatives": op7_warc_derivatives,
    "op8_pii": op8_pii,
    "op9_ngram_join": op9_ngram_join,
    "op10_packing": op10_packing,
    "op11_concurrency": op11_concurrency,
    "op12_toxicity": op12_toxicity,
    "op13_alignment": op13_alignment,
}

ORACLES: dict[str, str] = {
    "op4_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
            FROM documents),
        r AS (
            SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
                   first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id
            FROM n)
        SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size,
               doc_id = keep_id AS kept, sha256(norm) AS text_sha256
        FROM r""",
    "op11_concurrency": r"""
        WITH shipped AS (
            SELECT sale_id, min(shipped_at) AS first FROM sale_lines WHERE shipped_at IS NOT NULL GROUP BY sale_id),
        nations AS (SELECT client_id, min(nation_id) AS nation_id FROM clients GROUP BY client_id),
        spans AS (
            SELECT coalesce(n.nation_id, -1) AS nation_id,
                   CAST(floor(epoch(s.sold_at) / 60) * 60 AS BIGINT) AS a,
                   CAST(floor(epoch(h.first) / 60) * 60 AS BIGINT) + 604800 AS z,
                   CAST(floor(100 * coalesce(s.total, 0) + 0.5) AS BIGINT) AS cents
            FROM sales s LEFT JOIN shipped h ON h.sale_id = s.sale_id LEFT JOIN nations n ON n.client_id = s.client_id
            WHERE s.sold_at IS NOT NULL),
        taking AS (SELECT * FROM spans WHERE z IS NULL OR z > a),
        both_ends AS (
            SELECT nation_id, a AS moment, 1 AS n, cents FROM taking
            UNION ALL SELECT nation_id, z, -1, -cents FROM taking WHERE z IS NOT NULL
            UNION ALL SELECT -2, a, 1, cents FROM taking
            UNION ALL SELECT -2, z, -1, -cents FROM taking WHERE z IS NOT NULL),
        moves AS (
            SELECT nation_id, moment, sum(n) AS n, sum(cents) AS cents FROM both_ends GROUP BY nation_id, moment
            HAVING sum(n) <> 0 OR sum(cents) <> 0),
        scan AS (
            SELECT nation_id, moment, lead(moment) OVER w AS next_at, sum(n) OVER w AS n_open, sum(cents) OVER w AS open_cents
            FROM moves WINDOW w AS (PARTITION BY nation_id ORDER BY moment))
        SELECT CAST(nation_id AS INTEGER) AS nation_id, moment AS from_s, next_at AS to_s,
               CAST(n_open AS BIGINT) AS n_open, CAST(open_cents AS BIGINT) AS open_cents,
               CAST(max(n_open) OVER (PARTITION BY nation_id ORDER BY moment) AS BIGINT) AS high_open,
               open_cents = max(open_cents) OVER (PARTITION BY nation_id) AS is_peak
        FROM scan""",
}
