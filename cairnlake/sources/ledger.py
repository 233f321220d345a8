"""Published versions of a set of tables, all of one age.

Every run writes the tables whose inputs changed beside the old ones, checks the new set as a whole and then commits one small
pointer file that names a version of every table. Readers follow the newest committed pointer, so they see the set before or
the set after, whatever step a run stops at. A pointer also keeps what each version was made from: a run with the same inputs
writes nothing."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.operators.checks import newer
from cairnlake.sources.folders import children, drop, exists

POINTER = "name string, version long, inputs string"


@dataclass
class Ledger:
    """One writer at a time below path; any number of readers."""

    spark: SparkSession
    path: str

    def _numbers(self, folder: str, mark: str) -> list[int]:
        return sorted(int(n[len(mark) :]) for n in children(self.spark, f"{self.path}/{folder}") if n.startswith(mark))

    def _pointer(self) -> tuple[int, dict[str, tuple[int, str]]]:
        """Number of the newest committed pointer, and version and inputs of each table; 0 and nothing before the first."""
        for n in reversed(self._numbers("pointers", "p=")):
            if exists(self.spark, f"{self.path}/pointers/p={n}/_SUCCESS"):
                rows = self.spark.read.schema(POINTER).parquet(f"{self.path}/pointers/p={n}").collect()
                return n, {r["name"]: (r["version"], r["inputs"]) for r in rows}
        return 0, {}

    def tables(self) -> dict[str, DataFrame]:
        """The published tables, all of the newest age."""
        return {name: self._version(name, version) for name, (version, _) in self._pointer()[1].items()}

    def _version(self, name: str, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/tables/{name}/v={version}")

    def create_views(self, prefix: str = "") -> None:
        """Temporary views of the published tables."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(f"{prefix}{name}")

    def publish(self, made: dict[str, tuple[str, Callable[[], DataFrame]]], checks: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] | None = None, gate: tuple[str, str, object] | None = None) -> str:
        """made: for each table the inputs it is made from, as text (times and commits), and what makes it. Tables that are not
        named stay as they are.

        "Unchanged": all inputs are those of the published versions, and nothing is written. "Failed: ...": a check, which returns
        the rows that break it, has some. "Older": the gate's table (name, column, default) is not newer than the published one.
        In these cases the old set stays. "Published": the new set is there, and versions older than the last set are gone."""
        number, now = self._pointer()
        changed = {name: build for name, (inputs, build) in made.items() if name not in now or now[name][1] != inputs}
        if not changed:
            return "Unchanged"
        self._clear(keep=2)  # what earlier runs have left
        version = 1 + max([0, *(v for v, _ in now.values())])
        for name, build in changed.items():
            build().write.mode("overwrite").parquet(f"{self.path}/tables/{name}/v={version}")
        fresh = {name: self._version(name, v) for name, (v, _) in now.items()} | {name: self._version(name, version) for name in changed}
        broken = [name for name, check in (checks or {}).items() if check(fresh).take(1)]
        state = f"Failed: {', '.join(sorted(broken))}" if broken else ""
        if not state and gate and gate[0] in now and gate[0] in fresh:
            name, column, default = gate
            if not newer(fresh[name], self._version(name, now[name][0]), column, default).first()["is_newer"]:
                state = "Older"
        if not state:
            rows = [(name, *own) for name, own in (now | {name: (version, made[name][0]) for name in changed}).items()]
            self.spark.createDataFrame(rows, POINTER).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/pointers/p={number + 1}")
        self._clear(keep=2)
        return state or "Published"

    def _clear(self, keep: int) -> None:
        """Drops pointers but the newest few, and versions that none of these names. A reader may still be at the last set."""
        number, _ = self._pointer()
        named: set[tuple[str, int]] = set()
        for n in self._numbers("pointers", "p="):
            if number - keep < n <= number:
                rows = self.spark.read.schema(POINTER).parquet(f"{self.path}/pointers/p={n}").collect()
                named |= {(r["name"], r["version"]) for r in rows}
            else:
                drop(self.spark, f"{self.path}/pointers/p={n}")
        for name in children(self.spark, f"{self.path}/tables"):
            for v in self._numbers(f"tables/{name}", "v="):
                if (name, v) not in named:
                    drop(self.spark, f"{self.path}/tables/{name}/v={v}")
