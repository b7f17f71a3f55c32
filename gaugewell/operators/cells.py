"""A table as cells: one row per (column, row), values kept in their own type.

A profile asks the same questions of every column.  Turned into cells, a table
of any width is answered by one plan of constant size: the unpivot is a single
``Expand`` in generated code, and each metric is written once instead of once
per column (a wide global aggregate outgrows generated code at a handful of
columns and was half as fast on an eleven-column table).

Values are not turned into strings.  Each distinct column type gets a lane;
a cell fills the lane of its type and leaves the others NULL, so grouping and
shuffling work on native values.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugewell.functions.readings import as_text

# Expand's generated method outgrows the JIT limit of the JVM near 100 columns;
# at 48 the throughput per cell is that of a narrow table.
COLUMNS_PER_UNPIVOT = 48

_OPAQUE = ("array", "map", "struct", "binary", "interval", "variant")


def _lane_type(dtype: str) -> str:
    return "opaque" if dtype.startswith(_OPAQUE) else dtype


@dataclass(frozen=True)
class Cells:
    """``frame`` has ``col_id`` and one column per lane."""

    frame: DataFrame
    names: list[str]
    dtypes: list[str]
    lanes: dict[str, str]  # lane type -> column name in frame
    datasets: list[str] | None = None  # dataset of each column, where there are several

    @property
    def keys(self) -> list[str]:
        return list(self.lanes.values())

    def present(self) -> Column:
        return reduce(lambda a, b: a | b, [F.col(k).isNotNull() for k in self.keys])

    def read(self, reading: Callable[[Column, str], Column]) -> Column:
        """Apply a reading to whichever lane a cell fills."""
        parts = [reading(F.col(name), lane) for lane, name in self.lanes.items()]
        return parts[0] if len(parts) == 1 else F.coalesce(*parts)

    def text(self) -> Column:
        return self.read(as_text)

    def text_lanes(self) -> list[str]:
        """Lanes that hold text: as it is, or printed."""
        return [name for lane, name in self.lanes.items() if lane in ("string", "opaque")]

    def string_lane(self) -> Column:
        """The cell if its column is text, else NULL."""
        name = self.lanes.get("string")
        return F.col(name) if name else F.lit(None).cast("string")

    def name_of(self, col_id: Column) -> Column:
        return F.element_at(F.array(*[F.lit(n) for n in self.names]), col_id + 1)

    def dataset_of(self, col_id: Column) -> Column:
        return F.element_at(F.array(*[F.lit(d) for d in self.datasets]), col_id + 1)

    def columns(self) -> DataFrame:
        """One row per column, cells or not: ``col_id``."""
        ids = self.frame.sparkSession.range(0, len(self.names), 1, 1)
        return ids.select(F.col("id").cast("int").alias("col_id"))


def _storage(lane: str) -> str:
    return "string" if lane == "opaque" else lane


def to_cells(df: DataFrame, skip_dotted: bool = False, batch: int = COLUMNS_PER_UNPIVOT) -> Cells:
    """Unpivot every column of ``df``.

    Columns are addressed by position, so dots and blanks in names are safe;
    ``skip_dotted`` leaves such columns out.  Wide tables are unpivoted in
    batches, each reading only its own columns of a columnar source.
    """
    columns = [(n, t) for n, t in df.dtypes if not (skip_dotted and "." in n)]
    if not columns:
        raise ValueError("no columns to profile")
    names = [n for n, _ in columns]
    dtypes = [t for _, t in columns]
    kinds = list(dict.fromkeys(_lane_type(t) for t in dtypes))
    lanes = {kind: f"lane_{i}" for i, kind in enumerate(kinds)}
    position = {n: i for i, n in enumerate(df.columns)}
    if len(position) != len(df.columns):
        raise ValueError("column names must be distinct")

    def unpivot(ids: list[int]) -> DataFrame:
        picked = []
        for i in ids:
            source = F.col("`" + names[i].replace("`", "``") + "`")
            if _lane_type(dtypes[i]) == "opaque":
                source = source.cast("string")
            picked.append(source.alias(f"c{i}"))
        blanks = [F.lit(None).cast(_storage(k)).alias(f"none_{j}") for j, k in enumerate(kinds)]
        rows = ", ".join(
            "("
            + ", ".join(f"c{i}" if _lane_type(dtypes[i]) == k else f"none_{j}" for j, k in enumerate(kinds))
            + f") AS `{i}`"
            for i in ids
        )
        values = ", ".join(lanes.values())
        return df.sparkSession.sql(
            f"SELECT CAST(col_id AS INT) AS col_id, {values} FROM {{base}} "
            f"UNPIVOT INCLUDE NULLS (({values}) FOR col_id IN ({rows}))",
            base=df.select(*picked, *blanks),
        )

    ids = range(len(names))
    batches = [unpivot(list(ids[i : i + batch])) for i in range(0, len(names), batch)]
    return Cells(reduce(DataFrame.unionAll, batches), names, dtypes, lanes)


def union_cells(datasets: dict[str, DataFrame], skip_dotted: bool = False) -> Cells:
    """The cells of several tables of any schemas in one frame.

    Columns are numbered through all tables and the lanes are those of any of them, so
    everything that groups by column answers all tables in the same few shuffles.
    """
    if not datasets:
        raise ValueError("no datasets to profile")
    parts = {key: to_cells(df, skip_dotted) for key, df in datasets.items()}
    kinds = list(dict.fromkeys(kind for cells in parts.values() for kind in cells.lanes))
    lanes = {kind: f"lane_{i}" for i, kind in enumerate(kinds)}
    frames, names, dtypes, owners = [], [], [], []
    for key, cells in parts.items():
        values = [
            (F.col(cells.lanes[kind]) if kind in cells.lanes else F.lit(None).cast(_storage(kind))).alias(lane)
            for kind, lane in lanes.items()
        ]
        frames.append(cells.frame.select((F.col("col_id") + len(names)).alias("col_id"), *values))
        names += cells.names
        dtypes += cells.dtypes
        owners += [key] * len(cells.names)
    return Cells(reduce(DataFrame.unionAll, frames), names, dtypes, lanes, owners)
