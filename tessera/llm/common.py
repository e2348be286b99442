"""Pieces that several of the operators share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import delete, shared_dir

#: The characters that separate words: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the input folder, by Spark's reader alone."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_shipped: set[str] = set()
#: Bytes of a batch of rows for a Python worker, unless the session names its own; Spark's default is 64 MB.
BATCH_BYTES, BATCH_SETTING = 4 * 1024 * 1024, "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, so that their Python workers can import it wherever they start.

    Also bounds the bytes of a batch, which the JVM and the worker hold in several copies.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="tessera-ship-")
        with zipfile.ZipFile(f"{folder}/{root.name}.zip", "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        spark.sparkContext.addPyFile(f"{folder}/{root.name}.zip")
        _shipped.add(app)


def written(df: DataFrame, name: str, scratch: list[str] | None = None) -> DataFrame:
    """`df`, computed once, written to the shared folder and read again: a cut of its lineage that outlives executors.

    The folder is added to `scratch`, for those that are done with it before the application ends.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    if scratch is not None:
        scratch.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, scratch: list[str]) -> None:
    """Deletes the folders, which no frame may read any more, and empties the list."""
    while scratch:
        delete(spark, scratch.pop())


def quoted(name: str) -> str:
    """A column's name as it is written in expressions, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def packed(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """All columns (or these) as one struct, so that no other name can clash with theirs; select("row.*") takes them out again."""
    return F.struct(*[F.col(quoted(c)) for c in (df.columns if columns is None else columns)]).alias("row")


def replaced(df: DataFrame, path: list[str]) -> DataFrame:
    """`df` written as by `written`; the folder in `path`, of the table that it takes the place of, is deleted after that."""
    new = shared_dir(df.sparkSession, "round")
    df.write.parquet(new)
    if path:
        delete(df.sparkSession, path.pop())
    path.append(new)
    return df.sparkSession.read.schema(df.schema).parquet(new)


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """`names`, each with as many underscores in front as it takes to differ from all of `taken`, whatever their case."""
    used = {t.lower() for t in taken}
    out = []
    for n in names:
        while n.lower() in used:
            n = "_" + n
        used.add(n.lower())
        out.append(n)
    return out


def first_by_hash(ids: DataFrame, column: str, most: int) -> DataFrame:
    """At most `most` rows of `ids`, whose values in `column` are distinct: those first by a hash of it.

    Hashes above a limit that keeps about four times as many are left where they are, so the task that sorts gets no more
    however large the table is.
    """
    spread = F.pmod(F.xxhash64(column), F.lit(1 << 31))
    limit = min(1 << 31, (4 * most << 31) // max(1, ids.count()))
    return ids.where(spread <= limit).orderBy(spread, column).limit(most)


def words(text: Column) -> Column:
    """The runs of characters other than the six blanks, in order; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def n_words(text: Column) -> Column:
    """How many runs `words` finds, as a long, without making the array."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def unit(*parts: Column | str) -> Column:
    """A number in (0, 1), evenly spread and fixed by the text of `parts`; other engines compute the same from md5."""
    text = F.concat_ws("/", *[F.coalesce(p.cast("string"), F.lit("null")) if isinstance(p, Column) else F.lit(p) for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def bin_of(order: list[str], bins: int) -> Column:
    return F.floor(unit(*[F.col(c) for c in order]) * bins).cast("int")


def ranked(df: DataFrame, key: str, order: list[str], into: str, bins: int = 4096) -> DataFrame:
    """Adds the rank (from 0, without gaps) of each row among those with an equal, never null `key`.

    No task gets all rows of a key. Rows go to `bins` bins by a hash of `order`; each bin counts, the counts are summed over
    the at most `bins` bins of a key, and only the rows of one bin are sorted together. The rank follows (bin, order); rows
    that are equal in `order` take neighbouring ranks in any order.
    """
    df = df.withColumn("_bin", bin_of(order, bins))
    sums = df.groupBy(F.col(key).alias("_key"), F.col("_bin").alias("_kb")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_key").orderBy("_kb").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_key", "_kb", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inner = Window.partitionBy(key, "_bin").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    out = df.join(sums, (F.col(key) == F.col("_key")) & (F.col("_bin") == F.col("_kb")))
    return out.withColumn(into, F.col("_before") + F.row_number().over(inner) - 1).drop("_bin", "_key", "_kb", "_before")
