"""Registered queries of the training-data operators, and the SQL twins of those SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpilens.llm import chat, conversation_repair, exact_dedup, hard_negatives, html_tree, language, line_dedup, minmax, mixing, packing, quality, warc, winnowing
from kpilens.llm.common import table, word_count


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture reads it (small sources up to twice), with its place in the order."""
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), max_repeat=2.0)
    return mixed.select("doc_id", "source", "mix.n_tokens", "mix.weight", "mix.epoch", "mix.block_rank", "mix.order_key")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives in the shared folder and read back through the index."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 2,048 words; copies of a text and texts of a source never share one."""
    return packing.pack(table(spark, sf_dir, "documents"), word_count(F.col("text")), F.xxhash64("text"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, the base rule and the verdict of the learned decision list per document."""
    out, _ = quality.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies over all documents: half of them (by hash) are the snapshot, the others the incoming batch."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    return exact_dedup.exact_dedup(docs.where(half), docs.where(~half))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_tree.extract_text(table(spark, sf_dir, "pages"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines an earlier line resembles."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents whose crc32(doc_id) mod 4 is not 2."""
    return language.predict_language(table(spark, sf_dir, "documents"))


def op9_minmax_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components over all documents."""
    return minmax.near_duplicates(table(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation shown as a raw transcript, its turns and roles recovered and rendered.

    The model learns from the conversations whose crc32(conv_id) mod 8 is below 4 (half of each
    transcript style, which is that number mod 4) and decodes all of them."""
    lines = chat.transcript_lines(table(spark, sf_dir, "conversations"))
    model = chat.train(lines.where(F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(8)) < 4))
    return chat.parse_transcripts(lines, model)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten hardest negatives for each anchor (vec_id divisible by 100) and each of its five best positives."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label)
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


def op12_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they and the next document's are."""
    return winnowing.edited_likeness(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults after damage, its cheapest repair and the digest of the repaired turns."""
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.repair_summary(conversations, conversation_repair.damaged(conversations))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline: quality rules, line dedup, near-dedup, mixing, packing."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_mixing, op2_warc, op3_packing, op4_quality_rules, op5_exact_dedup, op6_html_text, op7_line_dedup, op8_language_id,
    op9_minmax_hashing, op10_chat_format, op11_hard_negatives, op12_winnowing, op13_conversation_repair, pipeline)}

ORACLE = {
    "op5_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                   list_inner_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        pos AS (
            SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT p.anchor_id, p.positive_id,
               row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank,
               s.other_id AS negative_id, p.positive_score, s.score AS negative_score
        FROM pos p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
             AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
        QUALIFY rank <= 10""",
}
