"""Named input tables, resolved when they are first used."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import Any, TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


T = TypeVar("T")

# writes a frame under a name and gives it back without its lineage
Keep = Callable[[DataFrame, str], DataFrame]


class Sources:
    """Lazily resolved input tables: ``sources.assets`` or ``sources["assets"]``.

    ``sources.block`` gives frames derived from them that many KPIs use. A plan of a few KPIs
    derives them in place; a job over all of them sets ``keep`` to have each written once.
    ``derived``: tables made from others of the same sources, so that these may be kept ones.
    """

    def __init__(
        self,
        spark: SparkSession,
        loaders: Mapping[str, Callable[[], DataFrame]],
        derived: Mapping[str, Callable[[Sources], DataFrame]] | None = None,
    ):
        self.spark = spark
        self._loaders = dict(loaders)
        self._derived = dict(derived or {})
        self._frames: dict[str, DataFrame] = {}
        self._keep: Keep | None = None
        self._blocks: dict[str, DataFrame] = {}
        self._known: dict[str, Any] = {}

    def known(self, name: str, measure: Callable[[], T]) -> T:
        """Something small that is measured on the tables once, such as which keys are frequent."""
        if name not in self._known:
            self._known[name] = measure()
        return self._known[name]

    def sharing(self, keep: Keep) -> Sources:
        """The same tables, with every block kept by ``keep`` when it is first used."""
        shared = Sources(self.spark, {n: (lambda n=n: self[n]) for n in self._loaders}, self._derived)
        shared._keep = keep
        shared._known = self._known
        return shared

    @property
    def keeps_blocks(self) -> bool:
        return self._keep is not None

    def block(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A derived frame under a name that tells its parameters."""
        if name not in self._blocks:
            frame = build()
            self._blocks[name] = frame if self._keep is None else self._keep(frame, name)
        return self._blocks[name]

    def keep_table(self, name: str) -> None:
        """Have a table that is derived from others, and that many KPIs read, kept like a block."""
        if self.keeps_blocks and name in self._derived and name not in self._frames:
            self._frames[name] = self.block(f"table_{name}", lambda: self._derived[name](self))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in self._derived:
                self._frames[name] = self._derived[name](self)
            elif name in self._loaders:
                self._frames[name] = self._loaders[name]()
            else:
                raise KeyError(f"no source table {name!r}")
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]

    @property
    def names(self) -> list[str]:
        return sorted({*self._loaders, *self._derived})

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, names: list[str]) -> Sources:
        return cls(spark, {n: (lambda n=n: spark.read.parquet(f"{root}/{n}")) for n in names})

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str, names: list[str]) -> Sources:
        return cls(spark, {n: (lambda n=n: spark.table(f"{database}.{n}")) for n in names})

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: Mapping[str, DataFrame]) -> Sources:
        return cls(spark, {n: (lambda f=f: f) for n, f in frames.items()})

    def prepare(self, blocks: list[Callable[[], DataFrame]]) -> None:
        """Have several blocks kept at once: their jobs run side by side."""
        if blocks:
            with ThreadPoolExecutor(len(blocks)) as pool:
                for result in [pool.submit(inheritable_thread_target(self.spark)(block)) for block in blocks]:
                    result.result()


def scan_table(sources: Sources, name: str) -> DataFrame:
    """Every row and column of one source table."""
    return sources[name]
