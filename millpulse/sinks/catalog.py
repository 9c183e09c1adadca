"""The stored tables and staged views by name, for ``spark.sql``.

``register`` names the raw tables (``telemetry`` ...), the staged views (``stg_telemetry`` ...) and the
models as temporary views over the current snapshots.  A commit of the same application moves
the views to the new snapshot by itself; ``Views.refresh`` does so after commits of
others, at the price of listing the manifests.  A query that runs keeps the snapshot it
started with.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from millpulse.operators.staging import STAGERS
from millpulse.plans.pipeline import MODEL_LAYOUT, read_raw_tables
from millpulse.sinks.snapshots import Snapshot, SnapshotStore
from millpulse.sources.schemas import SOURCE_NAMES


class Views:
    def __init__(self, spark: SparkSession, raw_root: str, model_root: str | None, prefix: str):
        self.spark, self.prefix = spark, prefix
        self.raw_root, self.model_root = raw_root.rstrip("/"), model_root and model_root.rstrip("/")
        self.versions: dict[str, int] = {}
        SnapshotStore.listeners.append(self._committed)
        self.refresh()

    def refresh(self) -> dict[str, int]:
        """Move views of stores with a newer snapshot; returns the versions shown."""
        for root in (self.raw_root, self.model_root):
            if root is not None:
                store = SnapshotStore(self.spark, root)
                newest = (store.versions() or [0])[-1]
                if self.versions.get(root) != newest:
                    self._show(root, store.at(newest) if newest else Snapshot())
        return dict(self.versions)

    def close(self) -> None:
        """Drop the views."""
        if self._committed in SnapshotStore.listeners:
            SnapshotStore.listeners.remove(self._committed)
        for name in (*SOURCE_NAMES, *(f"stg_{n}" for n in SOURCE_NAMES), *MODEL_LAYOUT):
            self.spark.catalog.dropTempView(self.prefix + name)

    def _committed(self, root: str, snapshot: Snapshot) -> None:
        if root in (self.raw_root, self.model_root):
            self._show(root, snapshot)

    def _show(self, root: str, snapshot: Snapshot) -> None:
        tables = {}
        if root == self.raw_root:
            raw = read_raw_tables(self.spark, root, snapshot)
            tables = raw | {f"stg_{n}": STAGERS[n](df) for n, df in raw.items()}
        if root == self.model_root:
            store = SnapshotStore(self.spark, root)
            tables |= {n: store.read(n, snapshot) for n in MODEL_LAYOUT if n in snapshot.schemas}
        for name, df in tables.items():
            df.createOrReplaceTempView(self.prefix + name)
        self.versions[root] = snapshot.version


def register(spark: SparkSession, raw_root: str, model_root: str | None = None, prefix: str = "") -> Views:
    """Views named ``{prefix}{table}``; the models' ones appear with their first publication."""
    return Views(spark, raw_root, model_root, prefix)
