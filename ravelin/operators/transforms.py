"""Document transforms: chunking, windows, summaries, batches, normalization, row mapping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ravelin.functions import text as tx
from ravelin.functions import vectors
from ravelin.operators.membership import sifted
from ravelin.operators.ordering import numbered
from ravelin.session import broadcast_if_small

FILTER_KEYS = 500


def _exploded(docs: DataFrame, pieces: Column) -> DataFrame:
    keep = [c for c in docs.columns if c != "text"]
    rows = docs.select(*keep, F.posexplode(pieces).alias("seq", "text"))
    return rows.withColumn("chunk_id", F.concat_ws("#", F.col("doc_id").cast("string"), F.col("seq").cast("string")))


def sentence_chunks(docs: DataFrame, size: int = 512, overlap: int = 50) -> DataFrame:
    """Chunks of whole sentences, at most `size` words each, sharing up to `overlap` words."""
    return _exploded(docs, tx.packed_chunks(F.col("text"), size, overlap))


def word_windows(docs: DataFrame, size: int = 512, overlap: int = 50) -> DataFrame:
    """Chunks of exactly `size` words (the last may be shorter), sharing `overlap` words."""
    prepared = docs.withColumn("_words", tx.words(F.col("text")))
    return _exploded(prepared, tx.word_window_spans(F.col("_words"), size, overlap)).drop("_words")


def sentence_windows(docs: DataFrame, window: int = 3) -> DataFrame:
    """One row per sentence with the text of its neighbours, `window` on each side."""
    keep = [c for c in docs.columns if c != "text"]
    split = docs.select(*keep, tx.sentences(F.col("text")).alias("_sentences"))
    around = F.transform(
        F.col("_sentences"),
        lambda s, i: F.struct(
            s.alias("original_text"),
            F.array_join(
                F.slice(
                    F.col("_sentences"),
                    F.greatest(F.lit(1), i + 1 - window),
                    i + 1 + window - F.greatest(F.lit(1), i + 1 - window) + 1,
                ),
                " ",
            ).alias("window"),
        ),
    )
    rows = split.select(*keep, F.posexplode(around).alias("seq", "_s"))
    return rows.select(
        *keep,
        "seq",
        F.concat_ws("#", F.col("doc_id").cast("string"), F.col("seq").cast("string")).alias("chunk_id"),
        F.col("_s.original_text").alias("original_text"),
        F.col("_s.window").alias("window"),
    )


def doc_summary(docs: DataFrame, chars: int = 300) -> DataFrame:
    return docs.withColumn("text", tx.summary(F.col("text"), chars))


def batch_rows(df: DataFrame, size: int, order: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Number consecutive batches of `size` rows from 0, within `keys` where given; the last may be short."""
    return numbered(df, order, keys, "_pos").withColumn("batch", F.floor((F.col("_pos") - 1) / size)).drop("_pos")


def l2_normalize(df: DataFrame, vec: str = "embedding") -> DataFrame:
    return df.withColumn(vec, vectors.normalized(F.col(vec)))


def norm_report(df: DataFrame, vec: str = "embedding") -> DataFrame:
    """Smallest and largest vector length before and after normalization."""
    lengths = df.select(vectors.norm(F.col(vec)).alias("raw"), vectors.norm(vectors.normalized(F.col(vec))).alias("l2_normalized"))
    ranges = lengths.agg(
        F.array(
            *[
                F.struct(F.lit(c).alias("label"), F.min(c).alias("norm_min"), F.max(c).alias("norm_max"))
                for c in ("raw", "l2_normalized")
            ]
        ).alias("r")
    )
    return ranges.select(F.inline("r"))


def row_to_document(rows: DataFrame, *carry: str | Column) -> DataFrame:
    """Source-table rows as documents; an absent title or body leaves no text out."""
    return rows.select(
        *carry,
        F.concat(F.lit("pg-"), F.col("id").cast("string")).alias("doc_id"),
        F.concat_ws("\n\n", F.coalesce("title", F.lit("")), F.coalesce("body", F.lit(""))).alias("text"),
        "tenant_id",
        "title",
        F.lit("postgres").alias("source"),
    )


def assemble_context(hits: DataFrame, order: str = "rank", separator: str = " ") -> DataFrame:
    """Texts of each question's final hits joined in order."""
    placed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col("text").alias("text"))))
    return hits.groupBy("query_id").agg(F.array_join(F.transform(placed, lambda h: h["text"]), separator).alias("context"))


def with_text(hits: DataFrame, texts: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Attach texts to the survivors of a search; the search itself never carries them.

    A bounded number of hits is sent to the texts, so the texts are scanned and not shuffled; of more hits, the texts are
    sifted where they lie, and little beyond those that were hit is shuffled.
    """
    hits = broadcast_if_small(hits)
    return hits.join(sifted(texts.select(key, "text"), hits, key), key)


def keyed_items(items: DataFrame, probes: DataFrame, key: str) -> DataFrame:
    """The items under any of the probes' keys.

    A handful of keys becomes an IN filter, which prunes partitions and reaches the scan; more keys
    become a semi join.
    """
    wanted = probes.select(key).where(F.col(key).isNotNull()).distinct()
    few = [row[0] for row in wanted.limit(FILTER_KEYS + 1).collect()]
    if len(few) <= FILTER_KEYS:
        return items.where(F.col(key).isin(few)) if few else items.limit(0)
    return items.join(broadcast_if_small(wanted), key, "left_semi")


def replicate(docs: DataFrame, times: int) -> DataFrame:
    """Every document `times` times under ids `<id>#<i>`."""
    if times < 1:
        return docs.withColumn("doc_id", F.col("doc_id").cast("string")).limit(0)
    copies = docs.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    return copies.withColumn("doc_id", F.concat_ws("#", F.col("doc_id").cast("string"), F.col("_copy").cast("string"))).drop(
        "_copy"
    )


def count_by_modality(docs: DataFrame) -> DataFrame:
    return docs.groupBy(F.coalesce("modality", F.lit("unknown")).alias("modality")).agg(F.count("*").alias("n")).orderBy("modality")


def reconcile(produced: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """One row: rows produced, rows stored, ids on one side only."""
    a = produced.groupBy(key).agg(F.count("*").alias("p"))
    b = stored.groupBy(key).agg(F.count("*").alias("s"))
    both = a.join(b, key, "full_outer")
    return both.agg(
        F.coalesce(F.sum("p"), F.lit(0)).alias("produced"),
        F.coalesce(F.sum("s"), F.lit(0)).alias("stored"),
        F.count_if(F.col("s").isNull()).alias("missing"),
        F.count_if(F.col("p").isNull()).alias("unexpected"),
    )


def require_reconciled(produced: DataFrame, stored: DataFrame, key: str) -> None:
    row = reconcile(produced, stored, key).first()
    if row["produced"] != row["stored"] or row["missing"] or row["unexpected"]:
        raise RuntimeError(f"{row['produced']} rows produced but {row['stored']} stored")


def best_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, name: str = "rank") -> DataFrame:
    """First `n` rows per key; Spark cuts each task to `n` per key before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(name, place).where(F.col(name) <= n)
