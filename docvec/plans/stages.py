"""The four incremental stages: normalize, chunk, embed, index.

Each stage compares keys and hashes with what is stored, works on the difference,
and upserts. A stage that finds no difference writes no table. Comparisons carry
keys alone; texts and vectors are read only for the rows that go on. Computed rows
are written once, where they stay, and counted from what was written.

A stage notes with its own table which version of the tables it reads it has worked
off. The next run asks those tables for what was written and deleted since, and compares
the ids concerned alone, in the buckets that hold them; with nothing since it reads
nothing. Where the versions do not tell, or more than ``NARROW`` of a table was written,
all ids are compared.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docvec.functions.text import doc_id, has_visible, normalize_whitespace, sha256_hex, shard_of
from docvec.operators.changes import compare, not_in, one_per_key
from docvec.operators.chunks import changed_in, chunk_documents
from docvec.operators.embed import EmbedFn, embed_texts, embedding_rows, hashed_embed
from docvec.operators.index import index_candidates, index_rows
from docvec.operators.normalize import normalize_documents
from docvec.operators.stats import changed_sample, shard_distribution, shard_operations
from docvec.options import Options
from docvec.plans.audit import Audit
from docvec.sources.documents import Files
from docvec.sources.storage import work_folder
from docvec.sources.store import Store
from docvec.sources.tables import BROADCAST_BYTES, Changes, ManagedTable, Write, key_bytes

# A source gives ``uri`` and ``text`` (and ``language``) rows, each URI once; called
# with a table of URIs it gives those alone, so that an expensive extraction is not
# repeated for documents that did not change.
Source = Callable[[DataFrame | None], DataFrame]

STAGES = ("normalize", "chunk", "embed", "index")
# The line that opens a run, and the lines that open and close a stage.
RUN_START = "RUN START"
STAGE_LINE = f"^({'|'.join(STAGES)}): (?:start|end)$"


# Share of a table up to which what changed is looked up on its own. Above it, one
# comparison of all keys costs less than finding the few.
NARROW = 0.1
_PENDING = "chunkId string, docId string"


class NoTexts(RuntimeError):
    """Every document of a run failed to be extracted."""


class NoEmbeddings(RuntimeError):
    """Every text of a run failed to embed."""


def open_store(spark: SparkSession, path: str, options: Options) -> Store:
    return Store(spark, path, options.num_shards, options.table_buckets)


def from_table(docs: DataFrame, unique: bool = False) -> Source:
    """Source over rows that already hold ``uri`` and ``text``.

    A URI listed twice is one document, with the greater text. ``unique=True`` says
    that none is, and saves shuffling the texts to find out.
    """

    def source(uris: DataFrame | None) -> DataFrame:
        some = docs if uris is None else docs.join(uris, "uri", "left_semi")
        return some if unique else one_per_key(some, "uri", "text")

    return source


def from_uris(uris: DataFrame, extract: Callable[[DataFrame], DataFrame]) -> Source:
    """Source that extracts ``uri`` and ``text`` from a list of URIs, each once."""
    listed = uris.select("uri").dropDuplicates()

    def source(wanted: DataFrame | None) -> DataFrame:
        return extract(listed if wanted is None else listed.join(wanted, "uri", "left_semi"))

    return source


def _scratch(store: Store, df: DataFrame, name: str) -> DataFrame:
    """Rows stored in the shared folder until the end of the run."""
    path = work_folder(store.spark, name)
    store.scratch.append(path)
    df.write.parquet(path)
    return store.spark.read.schema(df.schema).parquet(path)


def _extracted_keys(raw: DataFrame) -> DataFrame:
    """(docId, contentHash, uri) of all documents, with a null hash for failed ones."""
    text = F.when(has_visible("text"), normalize_whitespace("text"))
    return raw.select(doc_id("uri").alias("docId"), sha256_hex(text).alias("contentHash"), "uri")


def _plan(store: Store, found: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """Keys to work on, stored once in the shared folder, with a count per action."""
    keys = _scratch(store, found, "keys")
    counts = {r.action: r["count"] for r in keys.groupBy("action").count().collect()}
    return keys, {a: counts.get(a, 0) for a in ("new", "changed", "gone")}


def _todo(keys: DataFrame, *columns: str) -> DataFrame:
    return keys.filter(F.col("action") != "gone").select(*columns)


def _sent(keys: DataFrame) -> tuple[DataFrame, bool]:
    """Keys of one column, sent to the rows they are looked up in where they are few, so
    that the rows stay in place; and whether they are."""
    few = key_bytes(keys, *keys.columns) <= BROADCAST_BYTES
    return (F.broadcast(keys) if few else keys), few


def _gone(keys: DataFrame, counts: dict[str, int], *columns) -> DataFrame | None:
    if not counts["gone"]:
        return None
    return keys.filter(F.col("action") == "gone").select(*columns)


def _notes(table: ManagedTable) -> dict:
    """What earlier runs noted with a table."""
    try:
        found = json.loads(table.note() or "{}")
    except ValueError:  # a note of another kind
        return {}
    return found if isinstance(found, dict) else {}


def _changes(table: ManagedTable, since: int, until: int) -> Changes | None:
    """What was written and deleted between two versions, if that is known and little."""
    feed = table.changes(since, until)
    return None if feed is not None and feed.share > NARROW else feed


def _touched_chunks(store: Store, feed: Changes, pending: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents whose chunks were written or deleted, and the ids of all chunks that
    they had or have. ``pending`` (chunkId, docId) names more."""
    docs = feed.touched("docId")
    if pending is not None:
        docs = docs.unionByName(pending.select("docId")).distinct()
    docs = _scratch(store, docs, "touched_docs")
    ids = None
    for version in (feed.since, feed.until):
        had = store.chunks.read("chunkId", "docId", version=version, within=docs)
        had = had.join(docs, "docId", "left_semi").select("chunkId")
        ids = had if ids is None else ids.unionByName(had)
    if pending is not None:
        ids = ids.unionByName(pending.select("chunkId"))
    return docs, _scratch(store, ids.distinct(), "touched_chunks")


def _sample_changed(audit: Audit, stage: str, keys: DataFrame) -> None:
    """Note the first changed documents in order."""
    changed = keys.withColumn("is_update", F.col("action") == "changed")
    for r in changed_sample(changed).collect():
        audit.note(stage, f"{stage}: changed {r.uri}")


def _nothing(audit: Audit, stage: str) -> int:
    audit.note(stage, f"{stage}: nothing to do")
    return 0


def _settle(store: Store, seen: DataFrame, gone: DataFrame | None) -> None:
    """Keep the listing of files that were extracted; failed ones are tried again."""
    table = store.sources
    kept = seen.select("uri", "size", "modified")
    write = table.put(kept)
    table.show(write, ["uri"], gone)


def _normalize_listed(store: Store, source: Files, options: Options, audit: Audit) -> int:
    """Stage 1 over files: those whose size and time are as they were are not read.

    Extraction runs once for each file that is; what it gives is stored, compared by hash
    and normalized from there.
    """
    stage, table = "normalize", store.documents
    listed = source.listing()
    known = store.sources.read()
    same = ["uri", "size", "modified"]
    fresh = _scratch(store, not_in(listed, known, same), "listed")
    lost = None
    if options.prune and store.sources.exists():
        lost = _scratch(store, not_in(known.select("uri"), listed, ["uri"]), "unlisted")
        lost = lost if lost.limit(1).count() else None
    if not fresh.limit(1).count() and lost is None:
        for metric in ("failed", "new", "changed"):
            audit.count(stage, metric, 0)
        return _nothing(audit, stage)
    raw = _scratch(store, source(fresh.select("uri")), "extracted")
    lang = F.col("language") if "language" in raw.columns else options.language
    good = raw.filter(F.coalesce(has_visible("text"), F.lit(False)))
    facts = raw.agg(F.count("*").alias("n"), F.count_if(has_visible("text")).alias("good")).first()
    audit.count(stage, "failed", facts.n - facts.good)
    if facts.n and not facts.good and options.stop_when_all_fail and not table.exists():
        raise NoTexts(f"none of {facts.n} documents could be extracted")
    if not facts.good and lost is None:
        audit.count(stage, "new", 0)
        audit.count(stage, "changed", 0)
        return _nothing(audit, stage)
    keys = _extracted_keys(good)
    have = table.read("docId", "contentHash", within=keys.select("docId"))
    have = have.join(keys, "docId", "left_semi")
    found, counts = _plan(store, compare(keys, have, "docId", "contentHash", ["uri"]))
    audit.count(stage, "new", counts["new"])
    audit.count(stage, "changed", counts["changed"])
    if counts["changed"]:
        _sample_changed(audit, stage, found)
    gone = None if lost is None else lost.select(doc_id("uri").alias("docId"))
    pruned = 0 if gone is None else gone.count()
    if gone is not None:
        audit.count(stage, "pruned", pruned)
    audit.count(stage, "net_change", counts["new"] - pruned)
    write = None
    if counts["new"] or counts["changed"]:
        todo = good.join(_sent(_todo(found, "uri"))[0], "uri", "left_semi")
        rows = normalize_documents(todo, lang).withColumn("version_ts", F.current_timestamp())
        write = table.put(rows)
    if write is not None or gone is not None:
        table.show(write, ["docId"] if counts["changed"] else None, gone)
    # Only now, so that a run that is lost before reads the files again.
    _settle(store, fresh.join(good.select("uri"), "uri", "left_semi"), lost)
    return counts["new"] + counts["changed"]


def run_normalize(store: Store, source: Source, options: Options, audit: Audit) -> int:
    """Stage 1; the number of new and changed documents.

    Texts are extracted to compare their hashes, and once more for the documents that
    go on; on a first run once only. ``Files`` are extracted once, and only those that
    are new or have changed.
    """
    if isinstance(source, Files):
        return _normalize_listed(store, source, options, audit)
    stage, table = "normalize", store.documents

    def normalized(uris: DataFrame | None) -> DataFrame:
        raw = source(uris)
        lang = F.col("language") if "language" in raw.columns else options.language
        return normalize_documents(raw, lang).withColumn("version_ts", F.current_timestamp())

    if not table.exists():
        write = table.put(normalized(None))
        rows = table.written(write).count()
        if not rows and options.stop_when_all_fail and source(None).limit(1).count():
            table.discard(write)
            raise NoTexts("no document could be extracted")
        table.show(write)
        audit.count(stage, "new", rows)
        audit.count(stage, "changed", 0)
        audit.count(stage, "net_change", rows)
        return rows
    # A document that could not be extracted comes with a null hash: it is neither new nor
    # gone, so a failed fetch never removes what is stored. Only URIs that the source no
    # longer lists are pruned.
    seen = _scratch(store, _extracted_keys(source(None)), "extracted")
    facts = seen.agg(F.count("*").alias("n"), F.count("contentHash").alias("good")).first()
    audit.count(stage, "failed", facts.n - facts.good)
    if facts.n and not facts.good and options.stop_when_all_fail:
        raise NoTexts(f"none of {facts.n} documents could be extracted")
    found = compare(
        seen,
        table.read("docId", "contentHash", "uri"),
        "docId",
        "contentHash",
        ["uri"],
    )
    if not options.prune:
        found = found.filter(F.col("action") != "gone")
    keys, counts = _plan(store, found)
    audit.count(stage, "new", counts["new"])
    audit.count(stage, "changed", counts["changed"])
    if options.prune:
        audit.count(stage, "pruned", counts["gone"])
    if counts["changed"]:
        _sample_changed(audit, stage, keys)
    write = None
    if counts["new"] or counts["changed"]:
        write = table.put(normalized(_sent(_todo(keys, "uri"))[0]))
    gone = _gone(keys, counts, "docId")
    if write is None and gone is None:
        return _nothing(audit, stage)
    table.show(write, ["docId"] if counts["changed"] else None, gone)
    audit.count(stage, "net_change", counts["new"] - counts["gone"])
    return counts["new"] + counts["changed"]


def run_chunk(store: Store, options: Options, audit: Audit) -> int:
    """Stage 2; the number of chunks written.

    The chunks of a changed document replace all it had, so a shortened document
    keeps no trailing ones, and every chunk carries the current document hash.
    """
    stage, table = "chunk", store.chunks
    seen, first = store.documents.version(), not table.exists()
    docs = store.documents.read(version=seen)
    old, placed = None, first
    # Chunks of another split rule count as changed, so one rule holds for the table.
    rule = f"max_chars={options.max_chars} overlap={options.overlap} tail={options.tail}"
    note = json.dumps({"rule": rule, "documents": seen})
    if not first:
        noted = _notes(table)
        ruled = noted.get("rule") == rule
        feed = _changes(store.documents, noted["documents"], seen) if ruled else None
        if feed is not None and feed.empty:
            audit.count(stage, "chunks", 0)
            return _nothing(audit, stage)
        if feed is None:
            have = table.folded("docId", "docHash")
            if not ruled:
                have = have.withColumn("docHash", F.lit("split by another rule"))
        else:
            touched = _scratch(store, feed.touched("docId"), "touched_docs")
            docs = feed.written(*docs.columns)
            have = table.folded("docId", "docHash", within=touched).join(touched, "docId", "left_semi")
        found = compare(
            docs.select("docId", F.col("contentHash").alias("docHash")),
            have,
            "docId",
            "docHash",
        )
        keys, counts = _plan(store, found)
        if not any(counts.values()):
            table.remember(note)
            audit.count(stage, "chunks", 0)
            return _nothing(audit, stage)
        todo, few = _sent(_todo(keys, "docId"))
        docs = docs.join(todo, "docId", "left_semi")
        placed = few and feed is None
        if counts["changed"] or counts["gone"]:
            old = keys.filter(F.col("action") != "new").select("docId")
    chunked = chunk_documents(docs, options.max_chars, options.overlap, options.tail, folded=True)
    # Documents are kept in the buckets of their chunks. Where few have changed, the rows
    # of all tasks are gathered instead.
    stamped = chunked.withColumn("version_ts", F.current_timestamp())
    write = table.put(stamped, placed=placed)
    firsts = F.count_if(F.col("offset") == 0).alias("documents")
    every = F.coalesce(F.sum(F.col("tails") + 1), F.lit(0)).alias("chunks")
    counted = table.folded_written(write, "offset", "tails").agg(every, firsts).first()
    audit.count(stage, "documents", counted.documents)
    audit.count(stage, "chunks", counted.chunks)
    changed, before_rows = counted.chunks, 0
    if old is not None:
        # Chunks of a changed document that read as before are written, for their
        # document hash, but do not count as changed.
        if ruled:
            columns = ["docId", "chunkId", "chunkHash", "offset", "chunk", "tails"]
            before = table.folded(*columns, within=old).join(old, "docId", "left_semi")
            numbers = changed_in(table.folded_written(write, *columns), before, options.overlap)
            changed = numbers.agg(F.coalesce(F.sum("changed"), F.lit(0))).first()[0]
            before_rows = before.agg(every).first().chunks
        else:
            pair = ["chunkId", "chunkHash"]
            before = table.read("docId", *pair, within=old).join(old, "docId", "left_semi")
            changed = not_in(table.written(write, *pair), before, pair).count()
            before_rows = before.count()
    audit.count(stage, "chunks_changed", changed)
    audit.count(stage, "net_change", counted.chunks - before_rows)
    table.show(write, delete=old, note=note)
    return counted.chunks


def run_embed(
    store: Store, options: Options, audit: Audit, embed: EmbedFn = hashed_embed
) -> int:
    """Stage 3; the number of vectors written.

    Failed texts are counted and left out, so the next run tries them again.
    """
    stage, table = "embed", store.embeddings
    if options.skip_embedding:
        audit.note(stage, "embed: skipped")
        return 0
    columns = ["chunkId", "docId", "chunkHash", "chunk"]
    seen = store.chunks.version()
    chunks = store.chunks.read(*columns, version=seen)
    model, version = options.embed_model, options.embed_ver
    noted, mine = _notes(table), f"{model}/{version}"
    gone, replaces, replaced, counts = None, False, 0, {"changed": 0, "gone": 0}
    if table.exists():
        last = noted.get(mine, {})
        feed = _changes(store.chunks, last.get("chunks", 0), seen)
        pending = None
        if last.get("pending") is not None:
            pending = store.spark.read.schema(_PENDING).parquet(table.side("pending", last["pending"]))
        if feed is not None and feed.empty and pending is None:
            audit.count(stage, "removed", 0)
            audit.count(stage, "embedded", 0)
            return _nothing(audit, stage)
        have = ["chunkId", "chunkHash", "embedder", "embedder_ver"]
        if feed is None:
            held = table.read(*have)
        else:
            docs, ids = _touched_chunks(store, feed, pending)
            chunks = store.chunks.read(*columns, version=seen, within=docs).join(ids, "chunkId", "left_semi")
            held = table.read(*have, within=ids).join(ids, "chunkId", "left_semi")
        # Rows of other models keep their id, so that chunks gone from the text are
        # found whatever model they were embedded with.
        own = (F.col("embedder") == model) & (F.col("embedder_ver") == version)
        held = held.select("chunkId", F.when(own, F.col("chunkHash")).alias("chunkHash"))
        found = compare(chunks.select("chunkId", "chunkHash"), held, "chunkId", "chunkHash")
        keys, counts = _plan(store, found)
        audit.count(stage, "removed", counts["gone"])
        gone, replaces = _gone(keys, counts, "chunkId"), counts["changed"] > 0
        if not counts["new"] and not counts["changed"]:
            audit.count(stage, "embedded", 0)
            note = json.dumps({**noted, mine: {"chunks": seen, "pending": None}})
            if gone is None:
                table.remember(note)
                return _nothing(audit, stage)
            table.show(None, delete=gone, note=note)
            audit.count(stage, "net_change", -counts["gone"])
            return 0
        chunks = chunks.join(_todo(keys, "chunkId"), "chunkId", "left_semi")
        texts = counts["new"] + counts["changed"]
    else:
        texts = chunks.count()
    made = embedding_rows(embed_texts(chunks, embed, batch_size=options.batch_size), model, version)
    write = table.put(made.withColumn("version_ts", F.current_timestamp()))
    good = table.written(write).count()
    audit.count(stage, "embedded", good)
    audit.count(stage, "failed", texts - good)
    audit.count(stage, "batches", -(-texts // options.batch_size))
    if texts and not good and options.stop_when_all_fail:
        table.discard(write)
        raise NoEmbeddings(f"none of {texts} texts could be embedded")
    left, replaced = None, counts["changed"]
    if texts > good:
        if replaced:
            again = keys.filter(F.col("action") == "changed").select("chunkId")
            replaced = table.written(write, "chunkId").join(again, "chunkId", "left_semi").count()
        # Failed texts are listed beside the table, for the next run.
        failed = not_in(chunks.select("chunkId", "docId"), table.written(write, "chunkId"), ["chunkId"])
        failed.write.mode("overwrite").parquet(table.side("pending", write.number))
        left = write.number
    note = json.dumps({**noted, mine: {"chunks": seen, "pending": left}})
    table.show(write, ["chunkId", "embedder", "embedder_ver"] if replaces else None, gone, note)
    audit.count(stage, "net_change", good - replaced - counts["gone"])
    return good


def run_index(store: Store, options: Options, audit: Audit) -> int:
    """Stage 4; the number of chunks added to the index, updates included."""
    stage, meta, index = "index", store.indexed, store.index
    model, version = options.embed_model, options.embed_ver
    columns = ["chunkId", "chunkHash", "docId", "offset", "chunk"]
    made = ["chunkId", "chunkHash", "embedder", "embedder_ver", "vector"]
    seen = {"chunks": store.chunks.version(), "embeddings": store.embeddings.version()}
    chunks = store.chunks.read(*columns, version=seen["chunks"])
    vectors = store.embeddings.read(*made, version=seen["embeddings"])
    noted, mine = _notes(meta), f"{model}/{version}"
    last = noted.get(mine, {})
    gone, replaces, updates, counts = None, False, None, {"changed": 0, "gone": 0}
    # An index that was written to without its entries, by a run that was lost, may
    # already hold rows that come again.
    lost = index.version() not in (0, last.get("index"))

    def publish(write: Write | None, gone: DataFrame | None) -> None:
        _show_index(store, write, replaces, replaces or lost, gone, lambda: json.dumps(
            {**noted, mine: {**seen, "index": index.version()}}
        ))

    if meta.exists():
        have = meta.read("chunkId", "chunkHash", "docId")
        pieces = _changes(store.chunks, last.get("chunks", 0), seen["chunks"])
        fresh = _changes(store.embeddings, last.get("embeddings", 0), seen["embeddings"])
        if pieces is not None and fresh is not None and not lost:
            if pieces.empty and fresh.empty:
                audit.count(stage, "removed", 0)
                audit.count(stage, "indexed", 0)
                return _nothing(audit, stage)
            docs, ids = _touched_chunks(store, pieces)
            embedded = fresh.touched("chunkId")
            if not_in(embedded, ids, ["chunkId"]).limit(1).count():
                # Vectors of chunks that did not change, say of texts that had failed.
                ids = _scratch(store, ids.unionByName(embedded).distinct(), "touched_chunks")
            else:
                chunks = store.chunks.read(*columns, version=seen["chunks"], within=docs)
            chunks = chunks.join(ids, "chunkId", "left_semi")
            vectors = store.embeddings.read(*made, version=seen["embeddings"], within=ids)
            vectors = vectors.join(ids, "chunkId", "left_semi")
            have = meta.read("chunkId", "chunkHash", "docId", within=ids).join(ids, "chunkId", "left_semi")
        own = (F.col("embedder") == model) & (F.col("embedder_ver") == version)
        ready = vectors.filter(own).select("chunkId", F.col("chunkHash").alias("_ready"))
        # A chunk without a vector for its current text is not ready; joined on the
        # id alone, so that the next join on it needs no other shuffle.
        want = chunks.select("chunkId", "chunkHash", "docId").join(ready, "chunkId", "left")
        want = want.withColumn(
            "chunkHash", F.when(F.col("chunkHash") == F.col("_ready"), F.col("chunkHash"))
        )
        found = compare(want, have, "chunkId", "chunkHash", ["docId"])
        keys, counts = _plan(store, found)
        audit.count(stage, "removed", counts["gone"])
        gone, replaces = _gone(keys, counts, "chunkId", "docId"), counts["changed"] > 0
        if not counts["new"] and not counts["changed"]:
            audit.count(stage, "indexed", 0)
            if gone is None:
                meta.remember(json.dumps({**noted, mine: {**seen, "index": index.version()}}))
                return _nothing(audit, stage)
            publish(None, gone)
            audit.count(stage, "net_change", -counts["gone"])
            return 0
        pair = ["chunkId", "chunkHash"]
        todo = _todo(keys, *pair)
        chunks = chunks.join(todo, pair, "left_semi")
        vectors = vectors.join(todo, pair, "left_semi")
        updates = keys.filter(F.col("action") == "changed").select(
            shard_of("docId", options.num_shards).alias("shard")
        )
    candidates = index_candidates(chunks, vectors, model, version)
    write = index.put(index_rows(candidates, options.num_shards))
    indexed = index.written(write).count()
    if not indexed and gone is None:
        index.discard(write)
        audit.note(stage, "index: no chunk has a vector")
        return 0
    rows = index.written(write, "doc_id", "shard")
    # The reports come back as one row per shard.
    for r in shard_distribution(rows).collect():
        audit.note(stage, f"shard {r.shard}: {r.chunks} chunks from {r.documents} documents")
    flagged = rows.select("shard", F.lit(False).alias("is_update"))
    for r in shard_operations(flagged, updates).collect():
        name = "total" if r.shard is None else f"shard {r.shard}"
        audit.note(stage, f"{name}: added = {r.added}, updated = {r.updated}")
    audit.count(stage, "indexed", indexed)
    publish(write, gone)
    audit.count(stage, "net_change", indexed - counts["changed"] - counts["gone"])
    return indexed


def _show_index(
    store: Store, write: Write | None, replaces: bool, replaces_rows: bool,
    gone: DataFrame | None, note: Callable[[], str],
) -> None:
    """Publish index rows and then their entries in ``indexed_chunks``.

    In this order a run that stops in between finds the rows as not yet indexed and
    adds them again, replacing the first.
    """
    meta, index = store.indexed, store.index
    entries = None
    if write is not None:
        rows = index.written(write, "chunk_id", "chunk_hash", "doc_id")
        entries = meta.put(
            rows.select(
                F.col("chunk_id").alias("chunkId"),
                F.col("chunk_hash").alias("chunkHash"),
                F.col("doc_id").alias("docId"),
                F.current_timestamp().alias("indexed_ts"),
            )
        )
    drop = drop_entries = None
    if gone is not None:
        drop = gone.select(F.col("docId").alias("doc_id"), F.col("chunkId").alias("chunk_id"))
        drop_entries = gone.select("chunkId")
    index.show(write, ["chunk_id"] if replaces_rows else None, drop)
    meta.show(entries, ["chunkId"] if replaces else None, drop_entries, note())


def run_terms(store: Store, options: Options, audit: Audit) -> bool:
    """Second part of stage 4: bring the term table up to the index; whether it was written."""
    terms, index = store.terms, store.index
    if not options.term_index or not index.exists():
        return False
    seen, last = index.version(), terms.note().get("index")
    if seen == last:
        return False
    feed = index.changes(last, seen) if last else None
    if feed is None:
        terms.build(index.read("chunk_id", "text", version=seen), index=seen)
    else:
        terms.update(feed.written("chunk_id", "text"), feed.touched("chunk_id"), index=seen)
    audit.note("index", f"index: terms kept up to version {seen}")
    return True


def run_stages(
    spark: SparkSession,
    path: str,
    source: Source | None,
    options: Options = Options(),
    embed: EmbedFn = hashed_embed,
    stages: Sequence[str] = STAGES,
    run_id: str | None = None,
    echo: bool = False,
) -> tuple[Store, Audit]:
    """Run stages in order over one store, and append the run's audit events."""
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    store = open_store(spark, path, options)
    audit = Audit(run_id or uuid.uuid4().hex, echo=echo)
    steps = {
        "normalize": lambda: run_normalize(store, source, options, audit),
        "chunk": lambda: run_chunk(store, options, audit),
        "embed": lambda: run_embed(store, options, audit, embed),
        "index": lambda: (run_index(store, options, audit), run_terms(store, options, audit)),
    }
    audit.note("run", RUN_START)
    try:
        if "normalize" in stages and source is None:
            raise ValueError("the normalize stage needs a source")
        for stage in STAGES:
            if stage in stages:
                audit.note(stage, f"{stage}: start")
                steps[stage]()
                audit.note(stage, f"{stage}: end")
    except Exception as exc:
        audit.note("run", f"run failed: {exc}", channel="error")
        raise
    finally:
        audit.store(spark, store.folder("audit_events"))
        audit.publish_log(spark, store.folder("logs"), "run")
        store.drop_scratch()
    return store, audit
