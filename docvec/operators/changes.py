"""What is new or changed, found by (id, hash).

Anti and semi joins carry only keys on the existing side. Several rows per key do
no harm there, so no ``distinct`` is needed before them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Keys = Sequence[str] | Mapping[str, str]


def _renamed(existing: DataFrame, keys: Keys) -> tuple[DataFrame, list[str]]:
    pairs = keys if isinstance(keys, Mapping) else {k: k for k in keys}
    return existing.select([F.col(theirs).alias(ours) for ours, theirs in pairs.items()]), list(pairs)


def not_in(source: DataFrame, existing: DataFrame, keys: Keys) -> DataFrame:
    """Source rows whose key is absent; ``keys`` may map source to existing names."""
    right, names = _renamed(existing, keys)
    return source.join(right, names, "left_anti")


def already_in(source: DataFrame, existing: DataFrame, keys: Keys) -> DataFrame:
    """Source rows whose key is present."""
    right, names = _renamed(existing, keys)
    return source.join(right, names, "left_semi")


def existing_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    return table.select(*keys).distinct()


def classify(
    source: DataFrame, existing: DataFrame, id_col: str, hash_col: str
) -> DataFrame:
    """New and changed rows, told apart by ``is_update``.

    Changed rows (id known, hash not) come with ``is_update`` true, new ones with
    false; unchanged rows are left out.
    """
    fresh = not_in(source, existing, [id_col, hash_col])
    # Grouped, not a bare join: many rows per id shrink before the shuffle.
    known = existing.groupBy(id_col).agg(F.lit(True).alias("is_update"))
    return fresh.join(known, id_col, "left").withColumn(
        "is_update", F.coalesce("is_update", F.lit(False))
    )


def updates_then_inserts(
    source: DataFrame, existing: DataFrame, id_col: str, hash_col: str
) -> DataFrame:
    """The same rows as :func:`classify`, written as the union of the two parts."""
    fresh = not_in(source, existing, [id_col, hash_col])
    updates = already_in(fresh, existing, [id_col]).withColumn("is_update", F.lit(True))
    inserts = not_in(fresh, existing, [id_col]).withColumn("is_update", F.lit(False))
    return updates.unionByName(inserts)


def updates_first(found: DataFrame) -> DataFrame:
    """Classified rows as the union of updates and inserts. The parts share the shuffles."""
    return found.filter("is_update").unionByName(found.filter(~F.col("is_update")))


def settled_documents(chunks: DataFrame) -> DataFrame:
    """(docId, docHash) of documents whose chunks all carry one hash.

    A document with chunks of two versions is not settled: it is chunked again
    even when one of the hashes is the current one (text changed and changed back).
    """
    return (
        chunks.groupBy("docId")
        .agg(F.min("docHash").alias("docHash"), F.max("docHash").alias("_last"))
        .filter(F.col("docHash") == F.col("_last"))
        .drop("_last")
    )


def documents_to_chunk(docs: DataFrame, chunks: DataFrame) -> DataFrame:
    return not_in(
        docs, settled_documents(chunks), {"docId": "docId", "contentHash": "docHash"}
    )


def chunks_to_embed(
    chunks: DataFrame, embeddings: DataFrame, model: str, version: str
) -> DataFrame:
    have = embeddings.filter(
        (F.col("embedder") == model) & (F.col("embedder_ver") == version)
    )
    return not_in(chunks, have, ["chunkId", "chunkHash"])


def upserted(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after replacing rows that match on ``keys`` and adding the others.

    Source and target have the same columns; keys are unique in the source.
    """
    return target.join(source.select(*keys), list(keys), "left_anti").unionByName(source)


def one_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the one with the greatest ``order``.

    ``max_by`` is combined map-side, so a key with a third of all rows sends one
    row per task.
    """
    rest = [c for c in df.columns if c != key]
    picked = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_row"))
    return picked.select(*[F.col(key) if c == key else F.col(f"_row.{c}") for c in df.columns])


def compare(
    want: DataFrame, have: DataFrame, id_col: str, hash_col: str, carry: Sequence[str] = ()
) -> DataFrame:
    """What to do per id: ``new``, ``changed`` or ``gone``; the others are left out.

    One full outer join over keys in place of an anti join for each question. ``have``
    may hold several hashes per id, which counts as changed; a null hash in ``want``
    is a row that is not ready, and neither new nor gone. ``carry`` names columns to
    take along from either side.
    """
    held = have.groupBy(id_col).agg(
        F.min(hash_col).alias("_low"),
        F.max(hash_col).alias("_high"),
        F.lit(True).alias("_held"),
        *[F.max(c).alias(f"_{c}") for c in carry if c in have.columns],
    )
    wanted = want.select(id_col, F.col(hash_col).alias("_want"), F.lit(True).alias("_wanted"), *carry)
    same = (F.col("_low") == F.col("_want")) & (F.col("_high") == F.col("_want"))
    action = (
        F.when(F.col("_wanted").isNull(), "gone")
        .when(F.col("_want").isNull(), F.lit(None))
        .when(F.col("_held").isNull(), "new")
        .when(~F.coalesce(same, F.lit(False)), "changed")
    )
    both = wanted.join(held, id_col, "full_outer").withColumn("action", action)
    carried = [
        F.coalesce(c, f"_{c}").alias(c) if c in have.columns else F.col(c) for c in carry
    ]
    return both.filter(F.col("action").isNotNull()).select(
        id_col, F.col("_want").alias(hash_col), "action", *carried
    )
