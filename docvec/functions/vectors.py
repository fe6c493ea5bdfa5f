"""Vector columns, and the JSON bodies exchanged with a model service."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docvec.functions.text import _col

SIMILARITIES = ("COSINE", "DOT_PRODUCT", "EUCLIDEAN")


def similarity_name(name: str | None) -> str:
    """The similarity to use; an unknown name means cosine."""
    return name if name in SIMILARITIES else "COSINE"


def _squares(vector: Column, finish=None) -> Column:
    def add(total: Column, x: Column) -> Column:
        return total + x.cast("double") * x.cast("double")

    return F.aggregate(vector, F.lit(0.0), add, finish)


def norm(vector: Column | str) -> Column:
    return _squares(_col(vector), F.sqrt)


def l2_normalize(vector: Column | str) -> Column:
    """Unit vector of the same direction; a zero vector stays as it is.

    For stored columns. The embedding job normalizes inside its Arrow batches.
    """
    v, n = _col(vector), norm(vector)
    unit = F.transform(v, lambda x: (x.cast("double") / n).cast("float"))
    return F.when(n == 0, v.cast("array<float>")).otherwise(unit)


def is_valid(vector: Column | str) -> Column:
    """Non-empty, finite and not all zero."""
    # One pass over the vector; NaN compares greater than infinity.
    ok = _squares(_col(vector), lambda s: (s > 0) & (s < float("inf")))
    return F.coalesce(ok, F.lit(False))


def embed_request(text: Column | str, model: str) -> Column:
    """JSON body asking for the vector of one text."""
    return F.to_json(F.struct(F.lit(model).alias("model"), _col(text).alias("prompt")))


def chat_request(messages: Column | str, model: str) -> Column:
    """JSON body asking for one answer to a list of role/content messages."""
    return F.to_json(
        F.struct(
            F.lit(model).alias("model"),
            _col(messages).alias("messages"),
            F.lit(False).alias("stream"),
        )
    )


def parse_embedding(body: Column | str) -> Column:
    """Vector of a response body; missing or malformed gives an empty array."""
    parsed = F.from_json(_col(body), "embedding array<float>")["embedding"]
    empty = F.array().cast("array<float>")
    broken = parsed.isNull() | F.exists(parsed, lambda x: x.isNull())
    return F.when(broken, empty).otherwise(parsed)


def parse_chat(body: Column | str) -> Column:
    """Answer text of a response body; null marks an error."""
    return F.get_json_object(_col(body), "$.message.content")
