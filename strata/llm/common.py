"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable

import strata
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import work_path

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, so that tasks can
    import it wherever the session was started."""
    sc = spark.sparkContext
    if getattr(sc, "_strata_shipped", False):
        return
    home = os.path.dirname(os.path.dirname(os.path.abspath(strata.__file__)))
    made = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="strata-ship-"), "strata_package"), "zip", home, "strata")
    sc.addPyFile(made)
    sc._strata_shipped = True


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: evaluated once, lineage cut, and safe when executors are lost. Also
    gives the folder, for tasks that read it themselves."""
    spark = df.sparkSession
    path = work_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    return stored_at(df, name)[0]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once inside an expression. A lambda variable cannot be
    inlined by the optimiser, so an expensive array is built only once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text, in order (none for null)."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``name_1, name_2 ...`` that ``df`` lacks."""
    taken = {c.lower() for c in df.columns}
    n, k = name, 0
    while n.lower() in taken:
        k += 1
        n = f"{name}_{k}"
    return n


def quoted(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")
