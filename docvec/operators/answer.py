"""Hits to prompts and answers, over tables of queries.

Lists are grouped per query only after the search cut them to k rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docvec.operators.embed import EmbedFn, hashed_embed
from docvec.operators.search import embed_queries, search_vectors, stored, with_defaults
from docvec.options import TOP_K, Options
from docvec.sources.tables import ManagedTable

Generate = Callable[[list[dict[str, str]]], str]

# The layout of a packed context and of the source line.
PASSAGE_FORMAT = "[Document %d: %s - chunk %s]:\n%s"
PASSAGE_BREAK = "\n\n---\n\n"
SOURCES_FORMAT = "\n\n[Sources: %s]"

SYSTEM_TEXT = (
    "Use the passages below and nothing else. Say so when they do not hold the "
    "answer. Be brief and name the passage numbers you used."
)
NO_VECTOR = "The question could not be turned into a vector."
NO_HITS = "No matching passage was found."
FAILED = "The answer could not be produced: "


def _in_rank_order(item) -> F.Column:
    """List of one string per hit, by rank."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col("rank"), item.alias("item"))))
    return F.transform(pairs, lambda p: p["item"])


def _context() -> F.Column:
    passage = F.format_string(PASSAGE_FORMAT, "rank", "docId", "chunkId", "text")
    return F.array_join(_in_rank_order(passage), PASSAGE_BREAK)


def _sources() -> F.Column:
    label = F.concat("docId", F.lit(" (chunk "), "chunkId", F.lit(")"))
    listed = F.array_join(F.array_distinct(_in_rank_order(label)), ", ")
    return F.format_string(SOURCES_FORMAT, listed)


def pack_context(hits: DataFrame) -> DataFrame:
    """``query_id`` and ``context``: the passages of a query in rank order."""
    return hits.groupBy("query_id").agg(_context().alias("context"))


def answer_sources(hits: DataFrame) -> DataFrame:
    """``query_id`` and ``sources``: the distinct labels in rank order."""
    return hits.groupBy("query_id").agg(_sources().alias("sources"))


def _messages() -> F.Column:
    user = F.concat(
        F.lit("Passages:\n\n"), F.col("context"), F.lit("\n\nQuestion: "), F.col("text")
    )

    def message(role: str, content) -> F.Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(message("system", F.lit(SYSTEM_TEXT)), message("user", user))


def build_prompt(queries: DataFrame, contexts: DataFrame) -> DataFrame:
    """``query_id`` and ``messages``: system and user text per query."""
    joined = queries.join(contexts, "query_id")
    return joined.select("query_id", _messages().alias("messages"))


def first_sentence(messages: list[dict[str, str]]) -> str:
    """Built-in generator: the first sentence of the best passage."""
    passages = messages[-1]["content"].split("\n\nQuestion: ")[0]
    best = passages.split("]:\n", 1)[-1].split(PASSAGE_BREAK)[0]
    return best.split(".", 1)[0].strip() + "."


Index = DataFrame | ManagedTable


def route_answers(
    queries: DataFrame,
    indexes: Mapping[str, Index],
    embedders: Mapping[str, EmbedFn],
    generators: Mapping[str, Generate],
    options: Options = Options(),
) -> DataFrame:
    """``query_id``, ``status`` and ``answer`` of requests that name their models.

    ``queries`` holds ``query_id`` and ``text``, and may hold ``top_k``, ``embed_model`` and
    ``chat_model``; what is absent or null comes from the options. A request is embedded by
    its model and searched in that model's index, so vectors of two models never meet. The
    registries bound the number of passes. A model that is not registered fails the request
    with a message and no other.
    """
    asked = stored(with_defaults(queries, options.embed_model, options.chat_model, options.top_k), "requests")
    known = F.col("embed_model").isin(list(embedders)) & F.col("chat_model").isin(list(generators))
    wrong = F.when(
        ~F.col("embed_model").isin(list(embedders)), F.concat(F.lit("unknown model "), "embed_model")
    ).otherwise(F.concat(F.lit("unknown model "), "chat_model"))
    result = asked.filter(~known).select(
        "query_id", F.lit("failed").alias("status"), F.concat(F.lit(FAILED), wrong).alias("answer")
    )
    for model, embed in embedders.items():
        own = asked.filter(known & (F.col("embed_model") == model))
        found = _answers(own, indexes[model], generators, options.top_k, embed, options.similarity)
        result = result.unionByName(found)
    return result


def batch_answer(
    queries: DataFrame,
    index: Index,
    generate: Generate = first_sentence,
    k: int = TOP_K,
    embed: EmbedFn = hashed_embed,
    similarity: str | None = "COSINE",
) -> DataFrame:
    """``query_id``, ``status`` and ``answer`` for every query, all by one model.

    ``status`` is ``ok``, ``no_vector``, ``no_hits`` or ``failed``; the last three come
    with a message, so a bad query never stops the others.
    """
    named = queries.withColumn("chat_model", F.lit(""))
    return _answers(named, index, {"": generate}, k, embed, similarity)


def _answers(
    queries: DataFrame, index: Index, generators: Mapping[str, Generate], k: int, embed: EmbedFn, similarity: str | None
) -> DataFrame:
    """Answers of queries with one embedder; each is generated by its ``chat_model``."""
    vectors = stored(embed_queries(queries, embed), "vectors")
    hits = search_vectors(vectors, index, k, similarity)
    packed = hits.groupBy("query_id").agg(_context().alias("context"), _sources().alias("sources"))
    id_field = queries.schema["query_id"]
    schema = T.StructType(
        [
            T.StructField("query_id", id_field.dataType),
            T.StructField("sources", T.StringType()),
            T.StructField("reply", T.StringType()),
            T.StructField("error", T.StringType()),
        ]
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            replies, errors = [], []
            for model, messages in zip(frame["chat_model"], frame["messages"]):
                try:
                    replies.append(generators[model]([dict(m) for m in messages]))
                    errors.append(None)
                except Exception as exc:
                    replies.append(None)
                    errors.append(str(exc))
            yield pd.DataFrame(
                {
                    "query_id": frame["query_id"], "sources": frame["sources"],
                    "reply": replies, "error": errors,
                }
            )

    prompts = queries.join(packed, "query_id").select(
        "query_id", "chat_model", "sources", _messages().alias("messages")
    )
    replies = prompts.mapInPandas(run, schema)
    ready = vectors.select(
        "query_id", (F.size("vector") > 0).alias("_ready")
    )
    joined = ready.join(replies, "query_id", "left")
    status = (
        F.when(~F.col("_ready"), "no_vector")
        .when(F.col("sources").isNull(), "no_hits")
        .when(F.col("reply").isNull(), "failed")
        .otherwise("ok")
    )
    text = (
        F.when(F.col("status") == "no_vector", NO_VECTOR)
        .when(F.col("status") == "no_hits", NO_HITS)
        .when(F.col("status") == "failed", F.concat(F.lit(FAILED), F.coalesce("error", F.lit("no reply"))))
        .otherwise(F.concat("reply", "sources"))
    )
    return joined.withColumn("status", status).select("query_id", "status", text.alias("answer"))
