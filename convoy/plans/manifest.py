"""Versioned manifest of a warehouse folder.

``manifest/version=<n>`` lists what is in effect: the run of each batch, the live
fact files and the run that holds each day's totals. A version is written as one table;
it counts once its ``_SUCCESS`` marker is there, so a publication takes effect at
once and a reader that has opened a version keeps it. Versions are numbered
upwards and never overwritten: of two writers that publish the same number one fails.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from convoy.sources.sinks import list_names, path_exists

ROW = "kind string, batch int, run string, day string, dims string, file string, date_key int"


@dataclass(frozen=True)
class Batch:
    run: str        # attempt that landed its rows and snapshots
    day: str        # date of the batch
    dims: str       # attempt that folded the type-2 dimensions up to it


@dataclass(frozen=True)
class State:
    batches: dict[int, Batch] = field(default_factory=dict)
    files: tuple[str, ...] = ()
    totals: dict[int, str] = field(default_factory=dict)

    @property
    def newest(self) -> int | None:
        return max(self.batches, default=None)

    def live(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(f,) for f in self.files], "file string")


def _folder(out: str, version: int) -> str:
    return f"{out}/manifest/version={version:08d}"


def _versions(spark: SparkSession, out: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in list_names(spark, f"{out}/manifest") if n.startswith("version="))


def current(spark: SparkSession, out: str) -> State:
    """The newest published version (an empty state before the first)."""
    for v in reversed(_versions(spark, out)):
        if path_exists(spark, f"{_folder(out, v)}/_SUCCESS"):
            rows = spark.read.schema(ROW).json(_folder(out, v)).collect()
            return State({r.batch: Batch(r.run, r.day, r.dims) for r in rows if r.kind == "batch"},
                         tuple(sorted(r.file for r in rows if r.kind == "file")),
                         {r.date_key: r.run for r in rows if r.kind == "total"})
    return State()


def publish(spark: SparkSession, out: str, state: State) -> None:
    rows = [("batch", b, x.run, x.day, x.dims, None, None) for b, x in state.batches.items()]
    rows += [("file", None, None, None, None, f, None) for f in state.files]
    rows += [("total", None, run, None, None, None, day) for day, run in state.totals.items()]
    version = max(_versions(spark, out), default=0) + 1
    spark.createDataFrame(rows, ROW).coalesce(1).write.mode("errorifexists").json(_folder(out, version))
