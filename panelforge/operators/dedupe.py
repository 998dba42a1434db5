"""Duplicate removal: exact rows and content-identical records.

Content duplicates are found by SHA-256 of the whole content.  The kept id of a
hash is a partial aggregation (min id), so a hash shared by a third of all rows
never lands in one task; attaching it back joins two frozen tables, whose plain
shuffles AQE's skew handling splits when one hash is hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_exact_duplicates(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Exact duplicate rows removed (null equals null)."""
    return df.dropDuplicates(list(cols)) if cols else df.dropDuplicates()


def _hashed(df: DataFrame, id_col: str, content: str | Sequence[str]) -> DataFrame:
    cols = [content] if isinstance(content, str) else list(content)
    body = F.col(cols[0]) if len(cols) == 1 else F.to_json(F.struct(*cols))
    return df.withColumn("content_hash", F.sha2(body.cast("string"), 256))


def hash_table(df: DataFrame, id_col: str, content: str | Sequence[str]) -> DataFrame:
    """Narrow (content_hash, id) table, computed once: the content is read and
    hashed in one pass and the result frozen in the shared checkpoint folder,
    so the later aggregation and join do not read the content again."""
    from panelforge.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return _hashed(df, id_col, content).select("content_hash", id_col).checkpoint(eager=True)


def content_duplicates(df: DataFrame, id_col: str, content: str | Sequence[str]) -> DataFrame:
    """(content_hash, kept, removed): for every group of identical content the
    smallest id is kept, every other id is reported (nothing is deleted)."""
    h = hash_table(df, id_col, content)
    kept = (h.groupBy("content_hash").agg(F.min(id_col).alias("kept"), F.count(F.lit(1)).alias("_n"))
            .where("_n > 1").select("content_hash", "kept").checkpoint(eager=True))
    return (h.join(kept, on="content_hash").where(F.col(id_col) != F.col("kept"))
            .select("content_hash", "kept", F.col(id_col).alias("removed")))


def dedupe_by_content(df: DataFrame, id_col: str, content: str | Sequence[str]) -> DataFrame:
    """Rows whose id is the smallest among rows with identical content.  The
    kept ids come from the hash table; the final semi join is on the id (a
    unique key, so no hot key) and reads the full rows once."""
    h = hash_table(df, id_col, content)
    kept = h.groupBy("content_hash").agg(F.min(id_col).alias(id_col)).select(id_col)
    return df.join(kept, on=id_col, how="left_semi")
