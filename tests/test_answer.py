from docvec.operators import answer
from tests.test_search import index_of


def ask(spark, rows):
    return spark.createDataFrame(rows, "query_id int, text string")


def hits(spark):
    rows = [(1, 2, "d2", "c2", "two"), (1, 1, "d1", "c1", "one"), (1, 3, "d1", "c1", "one"), (2, 1, "d9", "c9", "x")]
    return spark.createDataFrame(rows, "query_id int, rank int, docId string, chunkId string, text string")


def test_context_and_sources(spark):
    packed = {r.query_id: r.context for r in answer.pack_context(hits(spark)).collect()}
    assert packed[1] == (
        "[Document 1: d1 - chunk c1]:\none\n\n---\n\n[Document 2: d2 - chunk c2]:\ntwo"
        "\n\n---\n\n[Document 3: d1 - chunk c1]:\none"
    )
    listed = {r.query_id: r.sources for r in answer.answer_sources(hits(spark)).collect()}
    assert listed[1] == "\n\n[Sources: d1 (chunk c1), d2 (chunk c2)]"


def test_prompt(spark):
    prompts = answer.build_prompt(ask(spark, [(1, "why?")]), answer.pack_context(hits(spark)))
    messages = prompts.first().messages
    assert [m.role for m in messages] == ["system", "user"]
    assert messages[1].content.endswith("\n\nQuestion: why?") and "two" in messages[1].content


def test_every_query_gets_an_outcome(spark):
    index = index_of(spark, ["Red apple. More.", "blue sky"])

    def generate(messages):
        if "Question: fail" in messages[-1]["content"]:
            raise RuntimeError("busy")
        return answer.first_sentence(messages)

    asked = ask(spark, [(1, "red apple"), (2, ""), (3, "fail sky")])
    got = {r.query_id: r for r in answer.batch_answer(asked, index, generate, 1).collect()}
    assert {q: r.status for q, r in got.items()} == {1: "ok", 2: "no_vector", 3: "failed"}
    assert got[1].answer == "Red apple.\n\n[Sources: d0 (chunk c0)]"
    assert got[2].answer == answer.NO_VECTOR
    assert got[3].answer == answer.FAILED + "busy"


def test_empty_index_gives_a_message(spark):
    index = index_of(spark, ["x"]).limit(0)
    row = answer.batch_answer(ask(spark, [(1, "red apple")]), index).first()
    assert (row.status, row.answer) == ("no_hits", answer.NO_HITS)


def test_requests_go_to_their_models(spark):
    from docvec.operators.embed import hashed_embed
    from docvec.options import Options

    one = index_of(spark, ["Red apple. More.", "blue sky"])
    other = one.selectExpr("concat('o', doc_id) AS doc_id", "concat('o', chunk_id) AS chunk_id", "chunk_hash", "offset",
                           "text", "array(float(0.0), float(1.0)) AS vector")
    none = one.limit(0)

    def busy(messages):
        raise RuntimeError("busy")

    rows = [
        (1, "red apple", None, None, None), (2, "", "plain", None, 1), (3, "red apple", "flat", "first", 1),
        (4, "red apple", "bare", None, None), (5, "red apple", "plain", "busy", None), (6, "x", "what", None, None),
        (7, "x", "plain", "who", None),
    ]
    asked = spark.createDataFrame(rows, "query_id int, text string, embed_model string, chat_model string, top_k int")
    got = answer.route_answers(
        asked,
        {"plain": one, "flat": other, "bare": none},
        {"plain": hashed_embed, "flat": lambda texts: [[0.0, 2.0]] * len(texts), "bare": hashed_embed},
        {"first": answer.first_sentence, "busy": busy},
        Options(embed_model="plain", chat_model="first", top_k=1),
    )
    found = {r.query_id: (r.status, r.answer) for r in got.collect()}
    assert found == {
        1: ("ok", "Red apple.\n\n[Sources: d0 (chunk c0)]"),
        2: ("no_vector", answer.NO_VECTOR),
        3: ("ok", "Red apple.\n\n[Sources: od0 (chunk oc0)]"),
        4: ("no_hits", answer.NO_HITS),
        5: ("failed", answer.FAILED + "busy"),
        6: ("failed", answer.FAILED + "unknown model what"),
        7: ("failed", answer.FAILED + "unknown model who"),
    }
