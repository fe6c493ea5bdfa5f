"""The managed table of chunks, which stores no suffixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docvec.operators.chunks import unfold_chunks
from docvec.sources.tables import SCHEMAS, Deletes, ManagedTable, Write

# Columns that all chunks of a document share, and that rows can go by.
SHARED = {"docId", "docHash"}


class ChunkTable(ManagedTable):
    """Chunks, of which the shrinking suffixes at the end of a text are most rows and are not
    stored: the piece before them says in ``tails`` how many follow.

    Readers get every chunk as a row; suffixes, their ids and their hashes are made where
    the table is read. :meth:`folded` and :meth:`folded_written` give the rows as stored. Rows
    without ``tails`` may be put as well, and stand for themselves. As a row may stand for
    many chunks, rows are replaced and deleted by document.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        stored = T.StructType([*SCHEMAS["chunks"].fields, T.StructField("tails", T.IntegerType())])
        super().__init__(spark, path, stored, "docId", buckets, sort_by=["docId", "offset"])

    def folded(self, *columns: str, within: DataFrame | None = None) -> DataFrame:
        """Rows of the current version as they are stored."""
        state = self._chosen(None, within)
        return self._stored(state.held, columns, state.deletes)

    def folded_written(self, write: Write, *columns: str) -> DataFrame:
        """Rows of a write that is not shown yet, as they are stored."""
        return self._stored({b: [write.number] for b in write.buckets}, columns)

    def _stored(
        self, held: dict[int, list[int]], columns: Sequence[str], deletes: Sequence[Deletes] = ()
    ) -> DataFrame:
        found = self._rows(held, [*self.schema.names, self.bucket_name], deletes)
        return found.withColumn("tails", F.coalesce("tails", F.lit(0))).select(*columns)

    def _visible(self) -> list[str]:
        return SCHEMAS["chunks"].names

    def _shown(
        self, held: dict[int, list[int]], columns: Sequence[str], deletes: Sequence[Deletes] = ()
    ) -> DataFrame:
        every = [*self.schema.names, self.bucket_name]
        return unfold_chunks(self._stored(held, every, deletes)).select(*columns)

    def _write(
        self, rows: DataFrame, write: int, files: int | None = None, placed: bool = False
    ) -> list[int]:
        whole = rows if "tails" in rows.columns else rows.withColumn("tails", F.lit(0))
        return super()._write(whole, write, files, placed)

    def show(
        self,
        write: Write | None,
        keys: Sequence[str] | None = None,
        delete: DataFrame | None = None,
        note: str | None = None,
    ) -> int:
        named = {*(keys or ()), *(delete.columns if delete is not None else ())}
        if not named <= SHARED:
            raise ValueError(f"chunks go by {sorted(SHARED)}, not {sorted(named)}")
        return super().show(write, keys, delete, note)
