"""Raw text to the rows of ``doc_normalized`` (without the timestamp)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docvec.functions.text import (
    doc_id,
    has_visible,
    normalize_whitespace,
    sha256_hex,
    title_of,
)


def normalize_documents(raw: DataFrame, language: Column | str = "en") -> DataFrame:
    """Rows with ``uri`` and ``text``; empty texts, the failed ones, are dropped.

    ``language`` is a constant, or a column to pass through.
    """
    lang = F.lit(language) if isinstance(language, str) else language
    # Tested on the raw text, which stops at the first visible character; a test on
    # the clean text would be pushed down and clean every text twice.
    some = raw.filter(has_visible("text"))
    clean = some.select("uri", lang.alias("language"), normalize_whitespace("text").alias("text"))
    return clean.select(
        "uri",
        "text",
        "language",
        title_of("text").alias("title"),
        doc_id("uri").alias("docId"),
        sha256_hex("text").alias("contentHash"),
    )
