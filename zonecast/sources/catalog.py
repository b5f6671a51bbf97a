"""Catalog: load the driver's parquet tables and derive the role views (S-4, S-5).

Every role is a lazy DataFrame; Catalyst prunes the parquet scans to the
columns each product actually reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from zonecast.sources import roles as R


class Catalog:
    """name -> DataFrame over one sf folder; base tables and role views.

    Frames are kept per catalog only: a new catalog lists the files anew, so it
    sees what was added to a table meanwhile.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}
        self._overridden: set[str] = set()  # names whose frames were put in by hand

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in R.BASE_TABLES:
                self._frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            elif name in R.ROLES:
                self._frames[name] = self.derive(name)
            else:
                raise KeyError(f"unknown table or role: {name}")
        return self._frames[name]

    __getitem__ = table

    def derive(self, role: str, **frames: DataFrame) -> DataFrame:
        """The role over this catalog's tables, ``frames`` in place of those named."""
        deps = {d: frames.get(d) or self.table(d) for d in R.role_deps(role)}
        return self.spark.sql(R.role_sql(role, R.SPARK), **deps)

    def given(self, *names: str) -> bool:
        """Whether any of the names has a frame already, derived or put in by hand."""
        return not self._frames.keys().isdisjoint(names)

    def materialize(self, name: str, path: str) -> DataFrame:
        """Write ``name`` once as parquet at ``path`` (shared storage) and use
        the written copy from now on: a table several products read is then
        computed once, and a lost executor re-reads files, not the lineage."""
        self.table(name).write.mode("overwrite").parquet(path)
        df = self.spark.read.parquet(path)
        self.register(name, df)
        return df

    def register(self, name: str, df: DataFrame) -> None:
        """Override a table or role for this catalog only (tests pass hand-made
        frames this way)."""
        self._frames[name] = df
        self._overridden.add(name)


def load_catalog(spark: SparkSession, sf_dir: str, names) -> dict[str, DataFrame]:
    """Load a fixed list of parquet tables; a missing one fails before any work (S-5)."""
    out = {}
    for name in names:
        path = f"{sf_dir.rstrip('/')}/{name}.parquet"
        try:
            out[name] = spark.read.parquet(path)
        except AnalysisException as exc:  # path does not exist
            raise FileNotFoundError(f"expected source table is missing: {path}") from exc
    return out
