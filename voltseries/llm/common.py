"""Helpers the operators share: stored intermediate tables and word patterns."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import voltseries
from voltseries.session import scratch_path

# Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
ARROW_ROWS = 500


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back.

    The copy cuts lineage: lost executors cost a re-read, not a recomputation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ready_python(spark: SparkSession) -> None:
    """Make Python tasks find this package, and give them small batches.

    The package is sent along with the session once, for workers that cannot import it
    from where they start. A batch has at most ARROW_ROWS texts, or fewer if so set: ten
    thousand, the default, may be any number of bytes, and both sides hold a whole batch.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    package, app = Path(voltseries.__file__).parent, spark.sparkContext.applicationId
    if app not in _shipped and package.is_dir():
        archive = Path(tempfile.mkdtemp(prefix="voltseries-code-")) / "voltseries.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _shipped.add(app)


def word_count(text: Column) -> Column:
    """Number of white-space separated words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def unit_hash(*parts: Column) -> Column:
    """A repeatable number in (0, 1) from the hash of some columns."""
    bits = F.shiftrightunsigned(F.xxhash64(*parts), 11)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(2**53))
