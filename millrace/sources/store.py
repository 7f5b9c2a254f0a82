"""Tables as Parquet folders, written so that a failed or repeated job does no harm.

``<root>/<table>/v=<n>/load_batch=<id>/``: a new version replaces the whole table once it
is complete, a batch is one load. Writing a batch again replaces that batch, so a load
that is run again under the same id adds nothing twice.

A load writes rows and history under one batch id. From ``begin`` to ``commit`` a mark hides
that id in every table; taking the mark away publishes all of it at once, and a load that
stops before leaves nothing to be seen. Merged batches are written beside the old ones, as
``<id>~<generation>``: the mark of the generation hides them until all are complete, then the
newest generation of each batch counts and the older ones are removed.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace import session
from millrace.sources import schemas

BATCH = "load_batch"
_PENDING = "_pending"


class TableStore:
    def __init__(self, spark: SparkSession, root: str, stages: dict[str, str] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.stages = dict(stages or {})

    # --- folders ---------------------------------------------------------------------
    def _children(self, path: str) -> list[str]:
        fs, p = session.file_system(self.spark, path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def drop_folder(self, path: str) -> None:
        fs, p = session.file_system(self.spark, path)
        fs.delete(p, True)

    def _versions(self, name: str) -> list[int]:
        found = [int(c[2:]) for c in self._children(f"{self.root}/{name}") if c.startswith("v=")]
        return sorted(
            n
            for n in found
            if n == 0 or session.path_exists(self.spark, f"{self.root}/{name}/v={n}/_SUCCESS")
        )

    def path(self, name: str) -> str:
        """Folder of the table's current version."""
        versions = self._versions(name)
        return f"{self.root}/{name}/v={versions[-1] if versions else 0}"

    def _batch_folders(self, name: str) -> list[str]:
        return sorted(
            c.split("=", 1)[1] for c in self._children(self.path(name)) if c.startswith(BATCH + "=")
        )

    def _hidden(self, name: str) -> list[str]:
        """Batch folders that do not count: of unfinished loads and merges, and of older generations.

        Few at any time: finished jobs remove both.
        """
        pending = set(self._children(f"{self.root}/{_PENDING}"))
        hidden, newest = [], {}
        for folder in self._batch_folders(name):
            batch, _, generation = folder.partition("~")
            if batch in pending or f"{name}~{generation}" in pending:
                hidden.append(folder)
                continue
            order = int(generation or 0)
            if batch in newest:
                hidden.append(min(newest[batch], (order, folder))[1])
            newest[batch] = max(newest.get(batch, (order, folder)), (order, folder))
        return hidden

    def batches(self, name: str) -> list[str]:
        hidden = set(self._hidden(name))
        return sorted(f.partition("~")[0] for f in self._batch_folders(name) if f not in hidden)

    # --- publishing -------------------------------------------------------------------
    def _mark(self, name: str) -> tuple:
        return session.file_system(self.spark, f"{self.root}/{_PENDING}/{name}")

    def begin(self, name: str) -> None:
        """Hide a batch (or a table's generation) until ``commit``."""
        fs, p = self._mark(name)
        fs.create(p, True).close()

    def commit(self, name: str) -> None:
        fs, p = self._mark(name)
        fs.delete(p, False)

    # --- tables ----------------------------------------------------------------------
    def schema(self, name: str) -> T.StructType:
        return schemas.schema(self.layout(name))

    @staticmethod
    def layout(name: str) -> str:
        """Table whose columns ``name`` has; test copies share those of the original."""
        bare = name.removeprefix("TEST_")
        return name if schemas.known(name) or not schemas.known(bare) else bare

    def read(
        self, name: str, batches: Sequence[str] | None = None, with_batch: bool = False
    ) -> DataFrame:
        declared = self.schema(name)
        stored = T.StructType([*declared.fields, T.StructField(BATCH, T.StringType())])
        path = self.path(name)
        if not session.path_exists(self.spark, path):
            df = self.spark.createDataFrame([], stored)
        else:
            df = self.spark.read.schema(stored).parquet(path)
        hidden = self._hidden(name)
        if hidden:
            df = df.where(~F.col(BATCH).isin(hidden))
        batch = F.substring_index(BATCH, "~", 1)
        if batches is not None:
            df = df.where(batch.isin(list(batches)))
        return df.withColumn(BATCH, batch) if with_batch else df.drop(BATCH)

    def _declared(self, name: str, df: DataFrame, *extra: str) -> DataFrame:
        return df.select(
            *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema(name).fields],
            *extra,
        )

    def append(self, name: str, df: DataFrame, batch: str) -> None:
        """Write a batch of a table; seen at once, unless ``begin`` hides it."""
        session.save(self._declared(name, df), f"{self.path(name)}/{BATCH}={batch}", "overwrite")

    def replace(self, name: str, df: DataFrame, batch: str = "all") -> None:
        """New version of the whole table; the version before it stays for its readers."""
        versions = self._versions(name)
        following = versions[-1] + 1 if versions else 1
        folder = f"{self.root}/{name}"
        rows = self._declared(name, df.withColumn(BATCH, F.lit(batch)), BATCH)
        session.save(rows, f"{folder}/v={following}", "overwrite", [BATCH])
        for old in versions[:-1]:
            self.drop_folder(f"{folder}/v={old}")

    def merge_batches(self, name: str, df: DataFrame | Iterable[DataFrame], deal: bool = True) -> None:
        """Replace exactly the batches present in ``df``; others are not rewritten.

        Several frames, with batches of their own each, are written one after the other and seen together.

        The old batches stay readable until the new ones are complete, and if this stops
        half-way they stay for good. ``deal`` first brings the rows of a batch together, a
        large batch in several tasks, so that many batches do not end as one small file per
        task and batch.
        """
        path = self.path(name)
        generations = [int(f.partition("~")[2] or 0) for f in self._batch_folders(name)]
        mark = f"{name}~{max(generations, default=0) + 1}"
        self.begin(mark)
        for frame in [df] if isinstance(df, DataFrame) else df:
            rows = self._declared(name, frame, BATCH)
            if deal:
                rows = rows.hint("rebalance", BATCH)
            rows = rows.withColumn(BATCH, F.concat(F.col(BATCH), F.lit("~" + mark.partition("~")[2])))
            session.save(rows, path, "append", [BATCH])
        self.commit(mark)
        for folder in self._hidden(name):
            if f"{name}~{folder.partition('~')[2]}" not in self._children(f"{self.root}/{_PENDING}"):
                self.drop_folder(f"{path}/{BATCH}={folder}")
