"""Counts of pipeline tables (A7) without a second job.

``DataFrame.observe`` attaches named aggregates to a DataFrame; they are
computed by whatever action runs it (a write, a checkpoint) and read back from
the ``Observation`` afterwards -- the reference's "Loaded N chunks" messages
cost no extra pass over the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row count attached; read it with ``obs.get[name]`` after
    an action on the returned DataFrame."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias(name)), obs


def counted(df: DataFrame, write) -> int:
    """Run ``write`` (a function of the DataFrame that writes it) and return
    the number of rows that passed, counted by that very action."""
    marked, obs = observed(df, "rows")
    write(marked)
    return int(obs.get["rows"])
