"""Managed tables: Parquet with upsert, where readers always see one version.

Layout of a table folder::

    data/ver=3/bucket=7/part-....parquet
    deletes/ver=4/part-....parquet
    versions/00000002.json     {"next": 5, "buckets": 8, "bucket": {"7": [1, 3]},
                                "note": null,
                                "deletes": [{"ver": 4, "columns": ["k"], "own": false, "bytes": null}],
                                "did": {"write": 3, "deletes": [...], "whole": false}}

A version lists, for each bucket, the writes that hold its rows; nothing that is
being read is overwritten. New rows are written once, to the place where they stay.
Rows that they replace, or that are deleted, stay where they are: the version names
the keys, and reading leaves out rows of earlier writes that have them. So an update
writes what changed and no more. Once ``FOLD_AFTER`` sets of keys have gathered, the
buckets that hold such rows are rewritten without them. One writer at a time.

Writes have a size tier, each ``FAN`` times the one below. When a bucket holds ``FAN`` writes
of one tier, their rows in it are merged into one write. So a bucket holds a number of
writes that grows with the logarithm of its size, and a row is rewritten as often.

A version also says what it did to the one before (``did``), so a reader that
remembers the last version it saw gets the rows written and the keys gone since, and
reads nothing else (:meth:`ManagedTable.changes`).

The bucket is a hash of the key, so its size follows the number of keys; writes
are rebalanced, which lets adaptive execution split a large bucket over several
tasks and files. The number of buckets is kept in the version: a table is not written
with another one until :meth:`ManagedTable.compact` has placed its rows anew.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docvec.functions.text import shard_of
from docvec.sources.storage import Storage

_STR, _TS = T.StringType(), T.TimestampType()
_VECTOR = T.ArrayType(T.FloatType(), True)

# Sets of deleted keys that a version may name before they are folded in.
FOLD_AFTER = 8
# Writes of one size tier that a bucket may hold before they are merged, and the bytes of
# the lowest tier.
FAN = 4
TIER_BYTES = 1 << 16
# Ids and hashes are hex digits, which entropy coding halves and Spark's default codec does not.
CODEC = "zstd"
# Bytes of keys up to which they are sent to the rows that have or lack them.
BROADCAST_BYTES = 64 << 20


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


# The columns of the stored tables.
SCHEMAS = {
    "doc_normalized": _schema(
        uri=_STR, text=_STR, language=_STR, title=_STR, docId=_STR,
        contentHash=_STR, version_ts=_TS,
    ),
    "chunks": _schema(
        chunkId=_STR, docId=_STR, docHash=_STR, offset=T.IntegerType(), chunk=_STR,
        chunkHash=_STR, language=_STR, title=_STR, version_ts=_TS,
    ),
    "embeddings": _schema(
        chunkId=_STR, chunkHash=_STR, embedder=_STR, vector=_VECTOR,
        embedder_ver=_STR, version_ts=_TS,
    ),
    "sources": _schema(uri=_STR, size=T.LongType(), modified=_TS),
    "indexed_chunks": _schema(
        chunkId=_STR, chunkHash=_STR, docId=_STR, indexed_ts=_TS,
    ),
    "index": _schema(
        doc_id=_STR, chunk_id=_STR, chunk_hash=_STR, offset=T.LongType(), text=_STR,
        vector=_VECTOR,
    ),
}


@dataclass(frozen=True)
class Write:
    """A numbered write and the buckets it filled."""

    number: int
    buckets: list[int]


@dataclass(frozen=True)
class Deletes:
    """Keys that rows of writes before ``ver`` must not have: those of write ``ver``
    itself (``own``), or of a list written for the purpose."""

    ver: int
    columns: tuple[str, ...]
    own: bool
    bytes: int | None = None  # of the keys of a write itself, where known


@dataclass(frozen=True)
class Step:
    """What a version did to the one before: the write and the sets of keys that it
    added. ``whole`` says that the table was written anew, so nothing can be told."""

    write: int | None = None
    deletes: tuple[Deletes, ...] = ()
    whole: bool = False


@dataclass(frozen=True)
class State:
    """What a version file says."""

    free: int
    held: dict[int, list[int]]
    deletes: tuple[Deletes, ...] = ()
    buckets: int | None = None
    note: str | None = None
    did: Step = Step()
    sizes: dict[int, int] = field(default_factory=dict)  # bytes of each write held


def key_bytes(keys: DataFrame, *columns: str) -> int:
    """Bytes of all keys, as text."""
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in columns), F.lit(0))
    return keys.agg(F.coalesce(F.sum(size.cast("bigint")), F.lit(0))).first()[0]


def _tier(size: int) -> int:
    tier = 0
    while size > TIER_BYTES * FAN**tier:
        tier += 1
    return tier


def _as_json(sets: Sequence[Deletes]) -> list[dict]:
    return [{"ver": d.ver, "columns": list(d.columns), "own": d.own, "bytes": d.bytes} for d in sets]


def _from_json(sets: list[dict]) -> tuple[Deletes, ...]:
    return tuple(Deletes(d["ver"], tuple(d["columns"]), d["own"], d.get("bytes")) for d in sets)


@dataclass(frozen=True)
class Changes:
    """What happened to a table between two of its versions."""

    table: ManagedTable
    since: int
    until: int
    steps: tuple[Step, ...]
    share: float = 0.0  # of the table's bytes that were written since

    @property
    def empty(self) -> bool:
        return not any(s.write or s.deletes for s in self.steps)

    def written(self, *columns: str) -> DataFrame:
        """Rows written since that were neither replaced nor deleted since."""
        deletes = [d for s in self.steps for d in s.deletes]
        return self.table._shown(self._held(), columns, deletes)

    def touched(self, column: str) -> DataFrame:
        """The distinct values of a column in all that was written or deleted since.
        Deletes are by this column or by keys of the writes themselves."""
        found = self.table._shown(self._held(), (column,))
        for step in self.steps:
            for d in step.deletes:
                if not d.own:
                    found = found.unionByName(self.table._deleted(d).select(F.col(f"_gone_{column}").alias(column)))
        return found.distinct()

    def _held(self) -> dict[int, list[int]]:
        held: dict[int, list[int]] = {}
        for step in self.steps:
            for bucket in self.table._filled(step.write) if step.write else ():
                held.setdefault(bucket, []).append(step.write)
        return held


class ManagedTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        bucket_key: str,
        buckets: int,
        bucket_name: str = "bucket",
        sort_by: Sequence[str] = (),
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.bucket_key, self.buckets, self.bucket_name = bucket_key, buckets, bucket_name
        self.sort_by = list(sort_by) or [bucket_key]
        self._files = Storage(spark)

    # -- versions ----------------------------------------------------------

    def version(self) -> int:
        """Number of the current version, 0 before the first write."""
        names = self._files.names(f"{self.path}/versions")
        numbers = [int(n.split(".")[0]) for n in names if n.endswith(".json")]
        return max(numbers, default=0)

    def exists(self) -> bool:
        return self.version() > 0

    def _state(self, version: int) -> State:
        if version == 0:
            return State(1, {})
        text = json.loads(self._files.read(f"{self.path}/versions/{version:08d}.json"))
        held = {int(b): w for b, w in text["bucket"].items()}
        did = text.get("did")
        step = Step(did["write"], _from_json(did["deletes"]), did["whole"]) if did else Step(whole=True)
        sizes = {int(w): n for w, n in text.get("sizes", {}).items()}
        return State(text["next"], held, _from_json(text["deletes"]), text["buckets"], text["note"], step, sizes)

    def _publish(self, state: State) -> int:
        version = self.version() + 1
        text = json.dumps(
            {
                "next": state.free,
                "buckets": self.buckets,
                "note": state.note,
                "bucket": {str(b): w for b, w in sorted(state.held.items()) if w},
                "sizes": {str(w): n for w, n in sorted(self._sizes(state).items())},
                "deletes": _as_json(state.deletes),
                "did": {
                    "write": state.did.write,
                    "deletes": _as_json(state.did.deletes),
                    "whole": state.did.whole,
                },
            }
        )
        self._files.publish(f"{self.path}/versions/{version:08d}.json", text)
        return version

    def _sizes(self, state: State) -> dict[int, int]:
        """Bytes of the writes held; those of new ones are looked up."""
        writes = {w for ws in state.held.values() for w in ws}
        return {w: state.sizes.get(w) or self._files.size(f"{self.path}/data/ver={w}") for w in writes}

    def stored_buckets(self) -> int | None:
        """The number of buckets (or shards) that the rows are placed by."""
        return self._state(self.version()).buckets

    def note(self) -> str | None:
        return self._state(self.version()).note

    def _writable(self) -> State:
        state = self._state(self.version())
        if state.buckets not in (None, self.buckets):
            raise ValueError(
                f"{self.path} has {state.buckets} {self.bucket_name}s, not {self.buckets}: "
                "compact it with the new number first"
            )
        return state

    # -- reading -----------------------------------------------------------

    def read(
        self, *columns: str, version: int | None = None, within: DataFrame | None = None
    ) -> DataFrame:
        """Rows of a version, the current one by default; empty before any write.

        ``within`` has values of the bucket key: only the buckets that these fall in are
        read. The rows may have other keys still.
        """
        state = self._chosen(version, within)
        return self._shown(state.held, columns or self._visible(), state.deletes)

    def _chosen(self, version: int | None, within: DataFrame | None) -> State:
        """A version, with the buckets alone that values of the bucket key fall in."""
        state = self._state(self.version() if version is None else version)
        if within is None or not state.held:
            return state
        # At most one number per bucket comes back.
        place = self._bucket(state.buckets).alias("b")
        some = {r[0] for r in within.select(self.bucket_key).select(place).distinct().collect()}
        return replace(state, held={b: w for b, w in state.held.items() if b in some})

    def read_buckets(self, numbers: Sequence[int], *columns: str) -> DataFrame:
        """Rows of some buckets of the current version; the folders of others are not listed."""
        state, wanted = self._state(self.version()), set(numbers)
        held = {b: w for b, w in state.held.items() if b in wanted}
        return self._shown(held, columns or self._visible(), state.deletes)

    def changes(self, since: int, until: int | None = None) -> Changes | None:
        """What happened after version ``since``; None when the versions do not tell,
        because the table was written anew or old versions have expired."""
        last = self.version() if until is None else until
        if not 0 < since <= last:
            return None
        kept = {n for n in self._files.names(f"{self.path}/versions") if n.endswith(".json")}
        numbers = range(since + 1, last + 1)
        if any(f"{n:08d}.json" not in kept for n in (since, *numbers)):
            return None
        states = [self._state(n) for n in numbers]
        steps = tuple(s.did for s in states)
        if any(s.whole for s in steps):
            return None
        sizes = {w: n for s in states for w, n in s.sizes.items()}
        total = sum(states[-1].sizes.values()) if states else 0
        share = sum(sizes.get(s.write, 0) for s in steps) / total if total else 0.0
        return Changes(self, since, last, steps, share)

    def _visible(self) -> list[str]:
        shown = [self.bucket_name] if self.bucket_name != "bucket" else []
        return [*self.schema.names, *shown]

    def _shown(
        self, held: dict[int, list[int]], columns: Sequence[str], deletes: Sequence[Deletes] = ()
    ) -> DataFrame:
        """Rows as readers get them; a table may store them in another form."""
        return self._rows(held, columns, deletes)

    def _rows(
        self, held: dict[int, list[int]], columns: Sequence[str], deletes: Sequence[Deletes] = ()
    ) -> DataFrame:
        found = self._files_of(held)
        by_columns: dict[tuple[str, ...], list[Deletes]] = {}
        for d in deletes:
            by_columns.setdefault(d.columns, []).append(d)
        for keys, sets in by_columns.items():
            gone = self._deleted(sets[0])
            for d in sets[1:]:
                gone = gone.unionByName(self._deleted(d))
            if self._small(sets):
                gone = F.broadcast(gone)
            same = [F.col(k) == F.col(f"_gone_{k}") for k in keys]
            found = found.join(gone, [*same, F.col("ver") < F.col("_at")], "left_anti")
        return found.select(*columns)

    def _small(self, sets: Sequence[Deletes]) -> bool:
        """Whether the keys are few enough to go to every task, so that the rows stay where
        they are."""
        if any(d.own and d.bytes is None for d in sets):
            return False
        sizes = (d.bytes if d.own else self._files.size(f"{self.path}/deletes/ver={d.ver}") for d in sets)
        return sum(sizes) <= BROADCAST_BYTES

    def _deleted(self, d: Deletes) -> DataFrame:
        """The keys of a set, with the write before which they hold."""
        if d.own:
            folder = f"{self.path}/data/ver={d.ver}"
        else:
            folder = f"{self.path}/deletes/ver={d.ver}"
        kept = T.StructType([f for f in self._full().fields if f.name in d.columns])
        keys = self.spark.read.schema(kept).option("basePath", folder).parquet(folder)
        return keys.select(
            *[F.col(c).alias(f"_gone_{c}") for c in d.columns], F.lit(d.ver).alias("_at")
        )

    def _full(self) -> T.StructType:
        return T.StructType(
            self.schema.fields
            + [T.StructField(self.bucket_name, T.LongType()), T.StructField("ver", T.LongType())]
        )

    def _files_of(self, held: dict[int, list[int]]) -> DataFrame:
        folders = [
            f"{self.path}/data/ver={w}/{self.bucket_name}={b}" for b, ws in held.items() for w in ws
        ]
        if not folders:
            return self.spark.createDataFrame([], self._full())
        reader = self.spark.read.schema(self._full()).option("basePath", f"{self.path}/data")
        return reader.parquet(*folders)

    def _bucket(self, buckets: int | None = None) -> Column:
        if self.bucket_name == "shard":
            return shard_of(self.bucket_key, buckets or self.buckets)
        return F.pmod(F.xxhash64(self.bucket_key), F.lit(buckets or self.buckets))

    # -- writing -----------------------------------------------------------

    def _write(
        self, rows: DataFrame, write: int, files: int | None = None, placed: bool = False
    ) -> list[int]:
        """Write rows as one numbered write; the buckets that got any.

        ``placed`` says that the rows of a task already fall in few buckets.
        """
        typed = rows.select(
            *[F.col(f.name).cast(f.dataType) for f in self.schema.fields],
            self._bucket().alias(self.bucket_name),
        )
        if files is not None:
            typed = typed.repartition(files, self.bucket_name, *self.sort_by)
        elif not placed:
            typed = typed.hint("rebalance", self.bucket_name)
        target = f"{self.path}/data/ver={write}"
        (
            typed.sortWithinPartitions(self.bucket_name, *self.sort_by)
            .write.mode("overwrite")
            .option("compression", CODEC)
            .partitionBy(self.bucket_name)
            .parquet(target)
        )
        return self._filled(write)

    def _filled(self, write: int) -> list[int]:
        """The buckets that a write has rows of."""
        prefix = f"{self.bucket_name}="
        names = self._files.names(f"{self.path}/data/ver={write}")
        return [int(n[len(prefix):]) for n in names if n.startswith(prefix)]

    def put(self, rows: DataFrame, placed: bool = False) -> Write:
        """Write rows, once and where they stay, without showing them yet.

        Their counts are best taken from :meth:`written`, which reads single columns.
        ``placed`` skips the shuffle to the buckets, for rows computed in place from a
        whole table with the same buckets.
        """
        # Writes that were put and not shown, by a run that was lost say, keep their number.
        taken = self._files.names(f"{self.path}/data")
        numbers = [int(n.split("=")[1]) + 1 for n in taken if n.startswith("ver=")]
        number = max([self._writable().free, *numbers])
        return Write(number, self._write(rows, number, placed=placed))

    def written(self, write: Write, *columns: str) -> DataFrame:
        """Rows of a write that is not shown yet."""
        return self._shown({b: [write.number] for b in write.buckets}, columns or self._visible())

    def discard(self, write: Write) -> None:
        self._files.delete(f"{self.path}/data/ver={write.number}")

    def show(
        self,
        write: Write | None,
        keys: Sequence[str] | None = None,
        delete: DataFrame | None = None,
        note: str | None = None,
    ) -> int:
        """Publish a write as an upsert on ``keys``; the version number.

        Without ``keys`` the rows are known to be new. Rows of earlier writes matching
        ``delete``, on the columns it has, go as well. ``note`` is kept with the version,
        and with later ones until there is another.
        """
        state = self._writable()
        number = write.number if write is not None else state.free
        if number < state.free:
            raise ValueError(f"write {number} of {self.path} came before what is shown already")
        new: list[Deletes] = []
        if state.held and write is not None and keys is not None:
            own = Deletes(number, tuple(keys), True)
            new.append(replace(own, bytes=key_bytes(self._deleted(own), *[f"_gone_{k}" for k in keys])))
        if state.held and delete is not None:
            delete.distinct().write.mode("overwrite").parquet(f"{self.path}/deletes/ver={number}")
            new.append(Deletes(number, tuple(delete.columns), False))
        held = {b: list(w) for b, w in state.held.items()}
        for bucket in write.buckets if write is not None else []:
            held.setdefault(bucket, []).append(number)
        after = State(
            number + 1, held, (*state.deletes, *new), note=state.note if note is None else note,
            did=Step(None if write is None else number, tuple(new)),
        )
        return self._publish(self._folded(after) if len(after.deletes) > FOLD_AFTER else self._merged(after))

    def side(self, kind: str, number: int) -> str:
        """A folder beside the rows, for what belongs to a write and is no row."""
        return f"{self.path}/{kind}/ver={number}"

    def remember(self, note: str) -> int:
        """Keep a note with a version of the same rows."""
        return self._publish(replace(self._writable(), note=note, did=Step()))

    def _folded(self, state: State) -> State:
        """The same rows without sets of deleted keys: buckets that hold rows with such
        keys are rewritten."""
        touched: set[int] = set()
        for d in state.deletes:
            old = self._files_of(state.held).select(*d.columns, self.bucket_name, "ver")
            same = [F.col(k) == F.col(f"_gone_{k}") for k in d.columns]
            hit = old.join(self._deleted(d), [*same, F.col("ver") < F.col("_at")], "left_semi")
            # At most one number per bucket comes back.
            touched.update(r[0] for r in hit.select(self.bucket_name).distinct().collect())
        if not touched:
            return replace(state, deletes=())
        some = {b: state.held[b] for b in touched}
        kept = self._rows(some, self.schema.names, state.deletes)
        written = self._write(kept, state.free)
        moved = {b: [state.free] if b in written else [] for b in touched}
        return replace(state, free=state.free + 1, held={**state.held, **moved}, deletes=())

    def _merged(self, state: State) -> State:
        """The same rows with full tiers merged, all buckets concerned in one write."""
        sizes = self._sizes(state)
        state = replace(state, sizes=sizes)
        full: dict[int, list[int]] = {}
        for bucket, writes in state.held.items():
            tiers: dict[int, list[int]] = {}
            for w in writes:
                tiers.setdefault(_tier(sizes[w]), []).append(w)
            some = [w for of in tiers.values() if len(of) >= FAN for w in of]
            if some:
                full[bucket] = some
        if not full:
            return state
        # Rows that are deleted by now are left out; later deletes have higher numbers.
        written = self._write(self._rows(full, self.schema.names, state.deletes), state.free)
        held = {
            b: [w for w in ws if w not in full.get(b, ())] + ([state.free] if b in full and b in written else [])
            for b, ws in state.held.items()
        }
        return replace(state, free=state.free + 1, held=held)

    def overwrite(self, rows: DataFrame) -> int:
        """Write the whole table anew; the version number."""
        return self.replace(self.put(rows))

    def replace(self, write: Write, note: str | None = None) -> int:
        """Publish a write as the whole table; the version number."""
        held = {b: [write.number] for b in write.buckets}
        return self._publish(State(write.number + 1, held, note=note, did=Step(write.number, whole=True)))

    def merge(
        self, rows: DataFrame, keys: Sequence[str] | None = None, delete: DataFrame | None = None
    ) -> int:
        """Upsert rows, unique on ``keys``, in one call; the version number. Without keys
        all rows are new."""
        write = self.put(rows)
        return self.show(write, keys, delete)

    def compact(self, files: int, buckets: int | None = None) -> int:
        """Rewrite the current version with at most ``files`` tasks, in another number of
        buckets if one is given."""
        state = self._state(self.version())
        rows = self._rows(state.held, self.schema.names, state.deletes)
        self.buckets = buckets or state.buckets or self.buckets
        written = self._write(rows, state.free, files)
        held = {b: [state.free] for b in written}
        return self._publish(State(state.free + 1, held, note=state.note))

    def expire(self, keep: int = 1) -> list[int]:
        """Delete all versions but the last ``keep`` and the writes that only those had;
        the numbers of the writes deleted. Nobody may be reading them."""
        names = sorted(n for n in self._files.names(f"{self.path}/versions") if n.endswith(".json"))
        if keep < 1:
            raise ValueError("keep must be at least 1")
        used: set[int] = set()
        for name in names[-keep:]:
            state = self._state(int(name.split(".")[0]))
            used.update(w for writes in state.held.values() for w in writes)
            used.update(d.ver for d in (*state.deletes, *state.did.deletes))
            used.update([state.did.write] if state.did.write else [])
        for name in names[:-keep]:
            self._files.delete(f"{self.path}/versions/{name}")
        free = self._state(self.version()).free
        dropped = set()
        for kind in ("data", "deletes"):
            for name in self._files.names(f"{self.path}/{kind}"):
                number = int(name.split("=")[1]) if name.startswith("ver=") else free
                if number < free and number not in used:
                    self._files.delete(f"{self.path}/{kind}/{name}")
                    dropped.add(number)
        return sorted(dropped)
