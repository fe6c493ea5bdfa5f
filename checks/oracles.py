"""SQL for DuckDB that says the same as the registered queries.

Written from the rules of the operators, sharing no code with them.
"""

from __future__ import annotations

NO_VECTOR = "The question could not be turned into a vector."
NO_HITS = "No matching passage was found."
FAILED = "The answer could not be produced: "
SYSTEM_TEXT = (
    "Use the passages below and nothing else. Say so when they do not hold the "
    "answer. Be brief and name the passage numbers you used."
)

# -- shared table expressions, in the order in which they build on each other ----

_RAW = """raw AS (
  SELECT 'doc://' || source || '/' || doc_id AS uri, text, lang AS language FROM documents
)"""

_EARLIER_RAW = """earlier_raw AS (
  SELECT uri, CASE WHEN language = 'de' THEN text || ' Earlier ending.' ELSE text END AS text, language
  FROM raw WHERE language <> 'fr'
)"""


def _clean(text: str) -> str:
    return (
        "regexp_replace(regexp_replace(" + text + r", '[\s\x0B]+', ' ', 'g'), "
        r"'^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"
    )


def _normalized(name: str, source: str) -> str:
    return f"""{name} AS (
  SELECT uri, text, language, regexp_extract(text, '^(.{{1,80}})', 1) AS title,
         sha256(uri) AS "docId", sha256(text) AS "contentHash"
  FROM (SELECT uri, language, {_clean('text')} AS text FROM {source}) WHERE length(text) > 0
)"""


def _piece(text: str, pos: str) -> str:
    part = f"substr({text}, {pos} + 1, 1200)"
    back = f"strpos(reverse({part}), '.')"
    return (
        f"CASE WHEN {back} > 0 AND length({part}) - {back} >= 720 "
        f"THEN substr({part}, 1, length({part}) - {back} + 1) ELSE {part} END"
    )


def _walk(name: str, source: str, key: str, compact: bool) -> str:
    """Pieces of ``source`` (key, text) by a recursive walk."""
    stop = "AND w.pos + length(w.piece) < length(w.text)" if compact else ""
    return f"""{name} AS (
  SELECT {key}, text, 0 AS pos, 0::BIGINT AS "offset", {_piece('text', '0')} AS piece
  FROM {source} WHERE length(text) > 0
  UNION ALL
  SELECT {key}, text, next AS pos, "offset" + 1 AS "offset", {_piece('text', 'next')} AS piece
  FROM (SELECT *, w.pos + greatest(length(w.piece) - 200, 1) AS next FROM {name} w WHERE true {stop})
  WHERE next < length(text)
)"""


def _chunks(name: str, docs: str, walked: str) -> str:
    return f"""{name} AS (
  SELECT sha256(w."docId" || ':' || w."offset") AS "chunkId", w."docId", d."contentHash" AS "docHash",
         w."offset", w.piece AS chunk, sha256(w.piece) AS "chunkHash", d.language, d.title
  FROM {walked} w JOIN {docs} d ON w."docId" = d."docId"
)"""


_CELL = "('0x' || substr({h}, 1, 8))::BIGINT % 64"
_SIGN = "CASE WHEN ('0x' || substr({h}, 9, 1))::BIGINT % 2 = 0 THEN 1 ELSE -1 END"


def _vectors(name: str, source: str, key: str, text: str) -> str:
    """Unit vectors of hashed words in long form: key, pos, x; zeros left out."""
    cell, sign = _CELL.format(h="sha256(word)"), _SIGN.format(h="sha256(word)")
    return f"""{name}_texts AS (SELECT {key} AS k, lower({text}) AS t FROM {source}),
{name}_words AS (
  SELECT k, unnest(regexp_extract_all(t, '[\\p{{L}}\\p{{N}}]+')) AS word FROM {name}_texts
),
{name}_cells AS (
  SELECT word, {cell} AS pos, {sign} AS sign FROM (SELECT DISTINCT word FROM {name}_words)
),
{name}_sums AS (
  SELECT k, pos, sum(sign) AS w FROM {name}_words JOIN {name}_cells USING (word)
  GROUP BY ALL HAVING sum(sign) <> 0
),
{name}_all AS (
  SELECT k, pos, w FROM {name}_sums
  UNION ALL
  SELECT k, {_CELL.format(h='sha256(t)')} AS pos, {_SIGN.format(h='sha256(t)')} AS w
  FROM {name}_texts WHERE length(t) > 0 AND k NOT IN (SELECT k FROM {name}_sums)
),
{name} AS (
  SELECT k, pos, CAST(w / sqrt(sum(w * w) OVER (PARTITION BY k)) AS FLOAT)::DOUBLE AS x FROM {name}_all
)"""


_LABEL_VALUES = """vals AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings
)"""
_LABEL_MEANS = "means AS (SELECT label::BIGINT AS query_id, pos, avg(x) AS x FROM vals GROUP BY ALL)"
_PRODUCTS = """products AS (
  SELECT query_id, vec_id, sum(m.x * v.x) AS dot, sum(m.x * m.x) AS qq, sum(v.x * v.x) AS vv
  FROM means m JOIN vals v ON m.pos = v.pos GROUP BY ALL
)"""

_HITS = """questions AS (SELECT item_id AS query_id, text FROM benchmark),
""" + _vectors("qv", "questions", "query_id", "text") + """,
""" + _vectors("cv", "chunks_compact", '"chunkId"', "chunk") + """,
norms_q AS (SELECT k, sqrt(sum(x * x)) AS n FROM qv GROUP BY k),
norms_c AS (SELECT k, sqrt(sum(x * x)) AS n FROM cv GROUP BY k),
pairs AS (
  SELECT a.k AS query_id, b.k AS "chunkId", sum(a.x * b.x) AS dot
  FROM qv a JOIN cv b ON a.pos = b.pos GROUP BY ALL
),
scored AS (
  SELECT q.k AS query_id, c.k AS "chunkId",
         round((1 + coalesce(p.dot, 0) / (q.n * c.n)) / 2, 9) AS score
  FROM norms_q q CROSS JOIN norms_c c LEFT JOIN pairs p ON p.query_id = q.k AND p."chunkId" = c.k
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, "chunkId") AS rank FROM scored
),
hits AS (
  SELECT p.query_id, p.rank, c."docId", c."chunkId", c.chunk AS text, p.score, c."offset"
  FROM placed p JOIN chunks_compact c USING ("chunkId") WHERE p.rank <= 5
)"""

# CRC-32 of a hex text, four bits at a time.
_NIBBLES = (
    "[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, "
    "3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]"
)
_SHARD = f"""shards AS (
  SELECT "docId", xor(list_reduce(
      list_transform(string_split("docId", ''), lambda ch: ord(ch)::BIGINT),
      lambda crc, byte: xor(
        xor(xor(crc, byte) >> 4, {_NIBBLES}[(xor(crc, byte) & 15) + 1]) >> 4,
        {_NIBBLES}[(xor(xor(crc, byte) >> 4, {_NIBBLES}[(xor(crc, byte) & 15) + 1]) & 15) + 1]),
      4294967295::BIGINT), 4294967295) % 4 AS shard
  FROM docs
)"""

_EMBEDDINGS_BEFORE = """had AS (
  SELECT "chunkId", "chunkHash", CASE WHEN language = 'es' THEN '0' ELSE '1' END AS embedder_ver FROM {chunks}
)"""

_CHANGED_DOCS = """doc_changes AS (
  SELECT d.uri, d."docId", d."contentHash", e."docId" IS NOT NULL AS is_update
  FROM docs d LEFT JOIN before e ON d."docId" = e."docId"
  WHERE e."docId" IS NULL OR e."contentHash" <> d."contentHash"
)"""
_CHANGED_CHUNKS = """chunk_changes AS (
  SELECT c.*, e."chunkId" IS NOT NULL AS is_update
  FROM chunks c LEFT JOIN chunks_before e ON c."chunkId" = e."chunkId"
  WHERE e."chunkId" IS NULL OR e."chunkHash" <> c."chunkHash"
)"""

_EVENT_LINES = """lines AS (
  SELECT user_id::VARCHAR AS log, event_type AS channel, date_trunc('second', ts) AS ts,
         CASE event_type WHEN 'signup' THEN '' WHEN 'view' THEN '1' WHEN 'click' THEN '2'
                         WHEN 'purchase' THEN '3' WHEN 'error' THEN '4' END AS stage
  FROM events
)"""


def _with(*parts: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"


_DOCS = [_RAW, _normalized("docs", "raw")]
_BEFORE = [*_DOCS, _EARLIER_RAW, _normalized("before", "earlier_raw")]


def _chunk_parts(compact: bool, before: bool) -> list[str]:
    name = "chunks_compact" if compact else "chunks"
    key = '"docId"'
    parts = list(_BEFORE if before else _DOCS)
    parts += [_walk("walked", "docs", key, compact), _chunks(name, "docs", "walked")]
    if before:
        parts += [
            _walk("walked_before", "before", key, compact),
            _chunks(name + "_before", "before", "walked_before"),
        ]
    return parts


def oracles() -> dict[str, str]:
    docs, before = _with(*_DOCS), _with(*_BEFORE)
    compat, compact = _with(*_chunk_parts(False, False)), _with(*_chunk_parts(True, False))
    compat2 = _with(*_chunk_parts(False, True))
    page_docs = _normalized(
        "page_docs",
        "(SELECT url AS uri, 'en' AS language, " + _page_text() + " AS text FROM pages)",
    )
    changed_docs = _with(*_BEFORE, _CHANGED_DOCS)
    changed_chunks = _with(*_chunk_parts(False, True), _CHANGED_CHUNKS)
    hits = _with(*_chunk_parts(True, False), _HITS)
    labels = _with(_LABEL_VALUES, _LABEL_MEANS, _PRODUCTS)
    out = {
        "normalize_docs": docs + "SELECT * FROM docs",
        "ingest_pages": _with(page_docs)
        + """SELECT uri, text, title, "docId", "contentHash" FROM page_docs
             QUALIFY row_number() OVER (PARTITION BY "docId" ORDER BY "contentHash" DESC) = 1""",
        "extraction_stats": f"""WITH t AS (SELECT {_clean(_page_text())} AS text FROM pages)
            SELECT count(*) AS total, count(*) FILTER (length(text) > 0) AS successful,
                   count(*) FILTER (length(text) = 0) AS failed FROM t""",
        "chunk_split": _with(_walk_documents(False))
        + 'SELECT doc_id, "offset", piece AS chunk FROM walked',
        "chunk_split_compact": _with(_walk_documents(True))
        + 'SELECT doc_id, "offset", piece AS chunk FROM walked',
        "chunk_ids": compat + 'SELECT "docId", "offset", "chunkId", "chunkHash" FROM chunks',
        "chunk_docs": compat + "SELECT * FROM chunks",
        "chunk_statistics": compat
        + """SELECT c."docId", length(d.text) AS chars, c.pieces, length(d.text) // c.pieces AS avg_chars
             FROM (SELECT "docId", count(*) AS pieces FROM chunks GROUP BY 1) c JOIN docs d USING ("docId")""",
        "new_or_changed_docs": before
        + """SELECT "docId", "contentHash", uri FROM docs d WHERE NOT EXISTS (
               SELECT 1 FROM before b WHERE b."docId" = d."docId" AND b."contentHash" = d."contentHash")""",
        "classify_doc_changes": changed_docs + 'SELECT "docId", uri, is_update FROM doc_changes',
        "change_counts": changed_docs
        + """SELECT CASE WHEN is_update THEN 'changed' ELSE 'new' END AS change_type, count(*) AS n
             FROM doc_changes GROUP BY 1""",
        "changed_sample": changed_docs
        + "SELECT uri FROM doc_changes WHERE is_update ORDER BY uri LIMIT 10",
        "docs_needing_chunks": compat2
        + """SELECT "docId", "contentHash" FROM docs d WHERE NOT EXISTS (
               SELECT 1 FROM chunks_before b WHERE b."docId" = d."docId" AND b."docHash" = d."contentHash")""",
        "changed_chunks": changed_chunks
        + 'SELECT "chunkId", "chunkHash", "docId", "offset" FROM chunk_changes',
        "existing_keys": compat2 + 'SELECT DISTINCT "docId", "docHash" FROM chunks_before',
        "needs_embedding": _with(
            *_chunk_parts(False, True), _EMBEDDINGS_BEFORE.format(chunks="chunks_before")
        )
        + """SELECT "chunkId", "chunkHash" FROM chunks c WHERE NOT EXISTS (
               SELECT 1 FROM had h WHERE h."chunkId" = c."chunkId" AND h."chunkHash" = c."chunkHash"
                 AND h.embedder_ver = '1')""",
        "needs_indexing": changed_chunks + 'SELECT "chunkId", "chunkHash" FROM chunk_changes',
        "classify_index_changes": changed_chunks
        + 'SELECT "chunkId", "docId", is_update FROM chunk_changes',
        "index_candidates": _with(
            *_chunk_parts(True, True), _EMBEDDINGS_BEFORE.format(chunks="chunks_compact_before")
        )
        + """SELECT c."chunkId", c."chunkHash", c."docId", c."offset", c.chunk
             FROM chunks_compact c JOIN had h ON c."chunkId" = h."chunkId" AND c."chunkHash" = h."chunkHash"
             WHERE h.embedder_ver = '1'""",
        "upsert_docs": before
        + """SELECT "docId", "contentHash", uri, title, language FROM docs
             UNION ALL
             SELECT "docId", "contentHash", uri, title, language FROM before
             WHERE "docId" NOT IN (SELECT "docId" FROM docs)""",
        "upsert_embeddings": """
            SELECT sha256(vec_id::VARCHAR) AS "chunkId", 'hashed-tokens-64' AS embedder, '1' AS embedder_ver,
                   sha256(CASE WHEN label < 5 THEN 'b' ELSE 'a' END || vec_id) AS "chunkHash" FROM embeddings
            UNION ALL
            SELECT sha256(vec_id::VARCHAR), 'hashed-tokens-64', '2', sha256('b' || vec_id)
            FROM embeddings WHERE label >= 5""",
        "net_change": before
        + """, u AS (SELECT "docId" FROM docs UNION SELECT "docId" FROM before)
             SELECT (SELECT count(*) FROM before) AS rows_before, (SELECT count(*) FROM u) AS rows_after,
                    (SELECT count(*) FROM u) - (SELECT count(*) FROM before) AS net_change""",
        "stage_counts": compat
        + """SELECT 'documents_in' AS metric, count(*) AS value FROM raw
             UNION ALL SELECT 'documents_normalized', count(*) FROM docs
             UNION ALL SELECT 'chunks', count(*) FROM chunks""",
        "l2_normalized": """
            WITH s AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos,
                              (unnest(embedding) * (label + 1))::FLOAT::DOUBLE AS x FROM embeddings)
            SELECT vec_id, pos::BIGINT AS pos,
                   round((x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)))::FLOAT::DOUBLE, 4) + 0.0 AS x FROM s""",
        "embed_chunks": _with(
            *_chunk_parts(True, False), _vectors("cv", "chunks_compact", '"chunkId"', "chunk")
        )
        + """SELECT c."chunkId", c."chunkHash", 'hashed-tokens-64' AS embedder, '1' AS embedder_ver,
                    p.pos, round(coalesce(v.x, 0), 5) + 0.0 AS x
             FROM chunks_compact c CROSS JOIN (SELECT unnest(range(64)) AS pos) p
             LEFT JOIN cv v ON v.k = c."chunkId" AND v.pos = p.pos""",
        "embedding_stats": compact
        + """SELECT count(*) AS total, count(*) FILTER (NOT contains(chunk, 'ü')) AS successful,
                    count(*) FILTER (contains(chunk, 'ü')) AS failed,
                    ceil(count(*) / 32)::BIGINT AS batches FROM chunks_compact""",
        "embed_requests": docs
        + """SELECT "docId" AS request_id,
                    to_json(struct_pack(model := 'hashed-tokens-64', prompt := text))::VARCHAR AS body FROM docs
             UNION ALL
             SELECT conv_id || ':' || turn, to_json(struct_pack(model := 'chat',
                 messages := [struct_pack(role := role, content := text)], stream := false))::VARCHAR
             FROM conversations""",
        "parse_responses": """
            SELECT 'embedding' AS kind, vec_id::VARCHAR AS id,
                   CASE WHEN label < 2 THEN 0 ELSE len(embedding) END AS n_values,
                   CASE WHEN label < 2 THEN 0 ELSE
                     round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 4) + 0.0 END AS total,
                   NULL::VARCHAR AS content FROM embeddings
            UNION ALL
            SELECT 'chat', conv_id || ':' || turn, NULL, NULL,
                   CASE WHEN role = 'assistant' THEN text END FROM conversations""",
        "shard_assign": _with(*_DOCS, _SHARD) + 'SELECT "docId", shard FROM shards',
        "index_build": _with(*_chunk_parts(True, False), _SHARD)
        + """SELECT "docId" AS doc_id, "chunkId" AS chunk_id, "chunkHash" AS chunk_hash, "offset",
                    chunk AS text, shard FROM chunks_compact JOIN shards USING ("docId")""",
        "shard_distribution": _with(*_chunk_parts(False, False), _SHARD)
        + """SELECT shard, count(*) AS chunks, count(DISTINCT "docId") AS documents
             FROM chunks JOIN shards USING ("docId") GROUP BY shard""",
        "shard_ops": _with(*_chunk_parts(False, True), _CHANGED_CHUNKS, _SHARD)
        + """SELECT shard, count(*) AS added, count(*) FILTER (is_update) AS updated
             FROM chunk_changes JOIN shards USING ("docId") GROUP BY ROLLUP (shard)""",
        "index_health": _with(*_chunk_parts(False, False), _SHARD)
        + """SELECT CASE WHEN count(*) > 0 THEN 'healthy' ELSE 'no_index' END AS status,
                    'index' AS index_path, count(DISTINCT shard) AS shards, count(*) AS total_documents
             FROM chunks JOIN shards USING ("docId")""",
        "lookup_chunk": _with(*_chunk_parts(False, False), _SHARD)
        + """SELECT "chunkId" AS chunk_id, "docId" AS doc_id, "offset", chunk AS text, shard
             FROM chunks JOIN shards USING ("docId") WHERE "chunkHash" = sha256('.')""",
        "lookup_stored": _with(*_chunk_parts(True, False), _SHARD)
        + """SELECT "chunkId" AS chunk_id, "docId" AS doc_id, "offset", chunk AS text, shard
             FROM chunks_compact JOIN shards USING ("docId") WHERE "docId" = sha256('doc://src1/1')""",
        "extraction_failures": f"""WITH t AS (SELECT url AS uri, {_page_text()} AS text FROM pages)
            SELECT uri, CASE WHEN length(uri) % 7 = 0 THEN 'ValueError: broken page' ELSE 'no visible text' END AS reason
            FROM t WHERE length(uri) % 7 = 0 OR NOT regexp_matches(text, '[^\\x00-\\x20]')""",
        "offset_range": compat
        + """SELECT "chunkId" AS chunk_id, "docId" AS doc_id, "offset", chunk AS text
             FROM chunks WHERE "offset" BETWEEN 2 AND 4""",
        "request_defaults": """
            SELECT conv_id || ':' || turn AS query_id, CASE WHEN turn > 0 THEN turn ELSE 5 END AS top_k,
                   'hashed-tokens-64' AS embed_model,
                   CASE WHEN turn > 2 THEN 'other' ELSE 'extractive' END AS chat_model
            FROM conversations""",
        "batch_search": hits
        + 'SELECT query_id, rank, "docId", "chunkId", text, round(score, 5) AS score, "offset" FROM hits',
        "term_index": _with(*_chunk_parts(True, False), _TERMS)
        + "SELECT term, chunk_id, tf, length FROM terms",
        "bm25_search": _with(*_chunk_parts(True, False), _TERMS, _BM25)
        + "SELECT query_id, chunk_id, round(score, 5) AS score, rank FROM placed WHERE rank <= 5",
        "pack_context": hits + _CONTEXT + "SELECT query_id, context FROM contexts",
        "answer_sources": hits + _SOURCES + "SELECT query_id, sources FROM sources",
        "build_prompt": hits
        + _CONTEXT
        + f"""SELECT query_id, 'system' AS first_role, '{SYSTEM_TEXT}' AS system_text, 'user' AS second_role,
                     'Passages:' || chr(10) || chr(10) || context || chr(10) || chr(10) || 'Question: ' || text
                       AS user_text
              FROM contexts JOIN questions USING (query_id)""",
        "batch_answer": hits
        + _SOURCES
        + """SELECT query_id, 'ok' AS status, trim(split_part(h.text, '.', 1)) || '.' || sources AS answer
             FROM hits h JOIN sources USING (query_id) WHERE h.rank = 1""",
        "batch_answer_outcomes": hits
        + _SOURCES
        + f"""
             , own AS (SELECT h.query_id, trim(split_part(h.text, '.', 1)) || '.' || s.sources AS answer
                       FROM hits h JOIN sources s USING (query_id) WHERE h.rank = 1),
             least_ids AS (SELECT row_number() OVER (ORDER BY "chunkId") AS rank, * FROM chunks_compact),
             flat AS (SELECT max(CASE WHEN rank = 1 THEN trim(split_part(chunk, '.', 1)) || '.' END)
                        || chr(10) || chr(10) || '[Sources: '
                        || string_agg("docId" || ' (chunk ' || "chunkId" || ')', ', ' ORDER BY rank) || ']' AS answer
                      FROM least_ids WHERE rank <= 5)
             SELECT item_id AS query_id,
               CASE item_id % 6 WHEN 1 THEN 'no_vector' WHEN 3 THEN 'no_hits' WHEN 4 THEN 'failed' WHEN 5 THEN 'failed'
                 ELSE 'ok' END AS status,
               CASE item_id % 6 WHEN 0 THEN own.answer WHEN 1 THEN '{NO_VECTOR}' WHEN 2 THEN flat.answer
                 WHEN 3 THEN '{NO_HITS}' WHEN 4 THEN '{FAILED}unknown model other' ELSE '{FAILED}busy' END AS answer
             FROM benchmark LEFT JOIN own ON own.query_id = item_id CROSS JOIN flat""",
        "stage_normalize": docs
        + 'SELECT "docId", "contentHash", uri, title, language, text FROM docs',
        "stage_chunk": compat
        + 'SELECT "chunkId", "docId", "docHash", "offset", "chunkHash" FROM chunks',
        "stage_embed": compact
        + """SELECT "chunkId", "chunkHash", 'hashed-tokens-64' AS embedder, '1' AS embedder_ver
             FROM chunks_compact""",
        "stage_index": _with(*_chunk_parts(True, False), _SHARD)
        + """SELECT "docId" AS doc_id, "chunkId" AS chunk_id, "chunkHash" AS chunk_hash, "offset", shard
             FROM chunks_compact JOIN shards USING ("docId")""",
        "stages_chained": _with(
            *_chunk_parts(True, True),
            _CHANGED_DOCS,
            _CHANGED_CHUNKS.replace("FROM chunks c", "FROM chunks_compact c").replace(
                "JOIN chunks_before", "JOIN chunks_compact_before"
            ),
        )
        + _CHAINED,
        "audit_summary": _with(_EVENT_LINES)
        + "SELECT channel, count(*) AS entries FROM lines GROUP BY channel",
        "runs_reported": "SELECT * FROM (VALUES (1::BIGINT, 'normalize', 2::BIGINT), (1, 'chunk', 2), (2, 'normalize', 2), "
        "(2, 'chunk', 2)) t(run, stage, n_lines) WHERE (SELECT count(*) FROM documents) > 0",
        "run_report": _with(_EVENT_LINES)
        + """, numbered AS (
              SELECT *, sum((channel = 'signup')::INT) OVER (PARTITION BY log ORDER BY ts
                          RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS run FROM lines)
             SELECT log, run, stage, count(*) AS n_lines, min(ts) AS started, max(ts) AS ended,
                    date_diff('second', min(ts), max(ts)) AS seconds
             FROM numbered WHERE stage <> '' AND run > 0 GROUP BY log, run, stage""",
    }
    scores = {
        "knn_cosine": "(1 + dot / sqrt(qq * vv)) / 2",
        "knn_euclidean": "1 / (1 + greatest(qq + vv - 2 * dot, 0))",
        "knn_dot": "(1 + dot) / 2",
    }
    for name, score in scores.items():
        out[name] = labels + _ranked(f"SELECT query_id, vec_id, round({score}, 9) AS score FROM products")
    out["knn_cells"] = (
        labels
        + """, away AS (
          SELECT m.query_id AS cell, v.vec_id, round(sum((m.x - v.x) * (m.x - v.x)), 9) AS d
          FROM means m JOIN vals v ON m.pos = v.pos GROUP BY ALL),
        cells AS (SELECT vec_id, cell FROM away
                  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cell) = 1),
        probed AS (
          SELECT query_id, cell FROM (
            SELECT a.query_id, b.query_id AS cell, round(sum((a.x - b.x) * (a.x - b.x)), 9) AS d
            FROM means a JOIN means b ON a.pos = b.pos GROUP BY ALL)
          QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY d, cell) <= 3)
        """
        + _ranked(
            f"""SELECT p.query_id, p.vec_id, round({scores['knn_cosine']}, 9) AS score
                FROM products p JOIN cells c USING (vec_id)
                JOIN probed b ON b.query_id = p.query_id AND b.cell = c.cell"""
        )
    )
    out["knn_ivf"] = out["knn_store"] = out["knn_cosine"]
    out["knn_store_recall"] = "SELECT true AS reached"
    out["bm25_stored"] = out["bm25_search"]
    out["knn_ivf_recall"] = "SELECT DISTINCT label AS query_id, true AS reached FROM embeddings"
    return out


def _ranked(scored: str) -> str:
    return f"""SELECT query_id, vec_id, round(score, 5) AS score, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
      FROM ({scored})) WHERE rank <= 10"""


def _page_text() -> str:
    text = r"regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', ' ', 'g')"
    text = f"regexp_replace({text}, '<[^>]*>', ' ', 'g')"
    for entity, char in [
        ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"),
        ("&apos;", "''"), ("&amp;", "&"),
    ]:
        text = f"replace({text}, '{entity}', '{char}')"
    return text


def _walk_documents(compact: bool) -> str:
    source = f"(SELECT doc_id, {_clean('text')} AS text FROM documents)"
    return _walk("walked", source, "doc_id", compact)


_TERMS = """words AS (
  SELECT "chunkId" AS chunk_id, unnest(regexp_extract_all(lower(chunk), '[\\p{L}\\p{N}]+')) AS term
  FROM chunks_compact
),
terms AS (
  SELECT term, chunk_id, tf, sum(tf) OVER (PARTITION BY chunk_id)::BIGINT AS length
  FROM (SELECT term, chunk_id, count(*) AS tf FROM words GROUP BY ALL)
)"""

_BM25 = """asked AS (
  SELECT DISTINCT query_id, term FROM (
    SELECT item_id AS query_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS term FROM benchmark)
),
sizes AS (SELECT count(DISTINCT chunk_id) AS n, sum(tf) / count(DISTINCT chunk_id) AS mean FROM terms),
df AS (SELECT term, count(*) AS df FROM terms GROUP BY term),
scored AS (
  SELECT a.query_id, t.chunk_id,
         round(sum(ln(1 + (s.n - d.df + 0.5) / (d.df + 0.5)) * t.tf
               / (t.tf + 1.2 * (1 - 0.75 + 0.75 * t.length / s.mean))), 9) AS score
  FROM asked a JOIN terms t USING (term) JOIN df d USING (term) CROSS JOIN sizes s GROUP BY ALL
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM scored
)"""

_CONTEXT = """, contexts AS (
  SELECT query_id, string_agg('[Document ' || rank || ': ' || "docId" || ' - chunk ' || "chunkId" || ']:'
           || chr(10) || text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS context
  FROM hits GROUP BY query_id
) """

_SOURCES = """, sources AS (
  SELECT query_id, chr(10) || chr(10) || '[Sources: '
         || string_agg("docId" || ' (chunk ' || "chunkId" || ')', ', ' ORDER BY rank) || ']' AS sources
  FROM hits GROUP BY query_id
) """

_CHAINED = """, again AS (
  SELECT count(*) AS n FROM chunks_compact WHERE "docId" IN (SELECT "docId" FROM doc_changes)
),
gone AS (
  SELECT count(*) AS n FROM chunks_compact_before WHERE "chunkId" NOT IN (SELECT "chunkId" FROM chunks_compact)
),
fresh AS (SELECT count(*) AS n FROM chunk_changes),
net AS (
  SELECT (SELECT count(*) FROM chunks_compact) - (SELECT count(*) FROM chunks_compact_before) AS n
)
SELECT 'normalize' AS stage, 'new' AS metric, count(*) FILTER (NOT is_update) AS value FROM doc_changes
UNION ALL SELECT 'normalize', 'changed', count(*) FILTER (is_update) FROM doc_changes
UNION ALL SELECT 'normalize', 'failed', 0
UNION ALL SELECT 'chunk', 'documents', count(*) FROM doc_changes
UNION ALL SELECT 'chunk', 'chunks', n FROM again
UNION ALL SELECT 'chunk', 'chunks_changed', n FROM fresh
UNION ALL SELECT 'embed', 'removed', n FROM gone
UNION ALL SELECT 'embed', 'embedded', n FROM fresh
UNION ALL SELECT 'embed', 'failed', 0
UNION ALL SELECT 'embed', 'batches', ceil(n / 32)::BIGINT FROM fresh
UNION ALL SELECT 'index', 'removed', n FROM gone
UNION ALL SELECT 'index', 'indexed', n FROM fresh
UNION ALL SELECT 'normalize', 'net_change', count(*) FILTER (NOT is_update) FROM doc_changes
UNION ALL SELECT 'chunk', 'net_change', n FROM net
UNION ALL SELECT 'embed', 'net_change', n FROM net
UNION ALL SELECT 'index', 'net_change', n FROM net"""
