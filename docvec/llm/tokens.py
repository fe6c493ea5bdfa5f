"""Token counts by a tokenizer compiled to a finite-state transducer (``transducer``).

The transducer is compiled lazily in each Python worker and kept there from task to task.
Texts are counted as a whole, a bounded number of characters at a time; nothing is
shuffled. Null and empty texts have no tokens and no bytes. Repeated rows are counted
each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docvec.llm.common import table
from docvec.llm.transducer import Transducer, compiled

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
BLOCK_CHARS = 2_000_000


@lru_cache(maxsize=2)
def _transducer(path: str) -> Transducer:
    return compiled(path)


def _blocks(texts: list[str]) -> Iterator[list[str]]:
    block, chars = [], 0
    for text in texts:
        block.append(text)
        chars += len(text)
        if chars >= BLOCK_CHARS:
            yield block
            block, chars = [], 0
    if block:
        yield block


def token_count(text: Column, model_path: str) -> Column:
    """Tokens of the text as the model's library gives them."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = _transducer(model_path)
        for texts in batches:
            found = [machine.count(block) for block in _blocks(texts.tolist())]
            yield pd.Series(np.concatenate(found) if found else np.empty(0, np.int64))

    return count(F.coalesce(text, F.lit("")))


def with_token_counts(
    docs: DataFrame, model_path: str, text_col: str = "text", name: str = "n_tokens"
) -> DataFrame:
    """``docs`` with the number of tokens of each text."""
    return docs.withColumn(name, token_count(F.col(text_col), model_path))


def op10_tokens(spark, sf):
    import public_tokenizers

    docs = table(spark, sf, "documents").select("doc_id", "text")
    counted = with_token_counts(docs, public_tokenizers.path(MODEL))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > LIMIT).alias("over_limit"),
    )
