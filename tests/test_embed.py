import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from docvec.functions.vectors import (
    chat_request,
    embed_request,
    is_valid,
    l2_normalize,
    parse_chat,
    parse_embedding,
    similarity_name,
)
from docvec.operators.embed import embed_texts, embedding_rows, hashed_embed


def chunk_rows(spark, texts):
    rows = [(str(i), hashlib.sha256(t.encode()).hexdigest(), t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "chunkId string, chunkHash string, chunk string")


def test_hashed_embed_by_hand():
    def code(w):
        h = hashlib.sha256(w.encode()).hexdigest()
        return int(h[:8], 16) % 64, 1 if int(h[8], 16) % 2 == 0 else -1

    got = hashed_embed(["Ab ab, é!", "...", ""])
    want = np.zeros((3, 64))
    for row, words in enumerate([["ab", "ab", "é"], ["..."], []]):
        for w in words:
            want[row, code(w)[0]] += code(w)[1]
    assert (got == want).all()


def test_batches_and_unit_vectors(spark):
    sizes = spark.sparkContext.accumulator(0)

    def embed(texts):
        assert len(texts) <= 3
        sizes.add(1)
        return [[3.0, 4.0] for _ in texts]

    df = chunk_rows(spark, [f"t{i}" for i in range(7)]).coalesce(1)
    rows = embed_texts(df, embed, batch_size=3).collect()
    assert sizes.value == 3 and len(rows) == 7
    assert all(np.allclose(r.vector, [0.6, 0.8]) for r in rows)
    with pytest.raises(ValueError):
        embed_texts(df, embed, batch_size=0)


def test_failures_give_empty_vectors_and_the_job_goes_on(spark):
    def embed(texts):
        if "boom" in texts:
            raise RuntimeError("model is down")
        if "short" in texts:
            return []
        odd = {"zero": [0.0, 0.0], "nan": [math.nan, 1.0], "none": []}
        return [odd.get(t, [1.0, 0.0]) for t in texts]

    df = chunk_rows(spark, ["ok", "boom", "short", "zero", "nan", "none", "fine"])
    made = embed_texts(df, embed, batch_size=1)
    got = {r.chunkId: list(r.vector) for r in made.collect()}
    assert got == {"0": [1, 0], "1": [], "2": [], "3": [], "4": [], "5": [], "6": [1, 0]}
    assert embedding_rows(made, "m", "1").count() == 2
    assert embedding_rows(made, "m", "1", failures=True).count() == 7
    mixed = embed_texts(df.limit(0), embed)
    assert mixed.count() == 0


def test_ragged_batch(spark):
    made = embed_texts(chunk_rows(spark, ["a", "bb"]).coalesce(1), lambda ts: [[2.0] * len(t) for t in ts])
    assert sorted(len(r.vector) for r in made.collect()) == [1, 2]


def test_vector_columns(spark):
    data = [([3.0, 4.0],), ([0.0, 0.0],), ([],), (None,), ([math.nan],), ([math.inf],)]
    df = spark.createDataFrame(data, "v array<float>")
    got = df.select(is_valid("v").alias("ok"), l2_normalize("v").alias("u")).collect()
    assert [r.ok for r in got] == [True, False, False, False, False, False]
    assert np.allclose(got[0].u, [0.6, 0.8]) and list(got[1].u) == [0, 0] and list(got[2].u) == []
    assert similarity_name("EUCLIDEAN") == "EUCLIDEAN"
    assert similarity_name("other") == similarity_name(None) == "COSINE"


@pytest.mark.parametrize(
    "body, vector",
    [
        ('{"embedding": [0.1, 0.2, 0.3]}', [0.1, 0.2, 0.3]),
        ('{"error": "x"}', []),
        ('{"embedding": ["a"]}', []),
        ("not json", []),
        (None, []),
    ],
)
def test_embedding_responses(spark, body, vector):
    got = spark.createDataFrame([(body,)], "b string").select(parse_embedding("b")).first()[0]
    assert np.allclose(got, vector) and len(got) == len(vector)


def test_chat_responses(spark):
    bodies = [('{"message": {"role": "assistant", "content": "a\\n\\"b\\" \\\\"}}',), ("{}",)]
    got = spark.createDataFrame(bodies, "b string").select(parse_chat("b")).collect()
    assert [r[0] for r in got] == ['a\n"b" \\', None]


def test_requests_are_escaped(spark):
    import json

    text = 'quote " newline \n back \\ tab \t'
    df = spark.createDataFrame([(text,)], "t string")
    assert json.loads(df.select(embed_request("t", "m")).first()[0]) == {"model": "m", "prompt": text}
    messages = F.array(F.struct(F.lit("user").alias("role"), F.col("t").alias("content")))
    body = json.loads(df.select(chat_request(messages, "m")).first()[0])
    assert body == {"model": "m", "messages": [{"role": "user", "content": text}], "stream": False}


def test_model_is_called_once_per_text(spark):
    made = embedding_rows(embed_texts(chunk_rows(spark, ["a", "b"])), "m", "1")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_workers_embed_by_slices_of_whole_calls(spark):
    """A worker holds the vectors of some texts, not of a whole Arrow batch; the calls of the
    function stay as they were."""
    import pyarrow as pa

    from docvec.functions.chunking import SLICE_BYTES
    from docvec.operators import embed as E

    def measured(texts):
        return [[float(len(texts)), 1.0] for _ in texts]

    df = spark.range(0, 2500, 1, 1).selectExpr("id", "repeat('ab ', 400) AS chunk")
    found = E.embed_texts(df, measured, keep=["id"], batch_size=32).orderBy("id").collect()
    called = [round(r.vector[0] / r.vector[1]) for r in found]
    assert called == [32] * 2496 + [4] * 4
    sizes = [sum(map(len, p)) for p in E.slices(pa.array(["ab " * 400] * 2500), step=32)]
    assert len(sizes) > 1 and max(sizes) <= SLICE_BYTES
    assert E.MAX_CACHED_WORDS <= 50_000
