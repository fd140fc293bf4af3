"""What the operators share: the cluster's shared folder, tables that cut lineage, files by range, word rules."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Field separators of the "visible words" rule: space and the five ASCII controls from tab to carriage return.
VISIBLE_SPLIT = r"[\x20\x09-\x0D]+"
#: Everything that ends a word of the "letters and digits" rule: all ASCII but 0-9, A-Z and a-z.
ALNUM_SPLIT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only a local session that has none gets one of its own (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="captureframe-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, group_bytes: int = 128 << 20) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, outlives executors, is computed once.

    Small row groups (``group_bytes``) let many tasks read what few have written.
    """
    path = new_path(df.sparkSession, name)
    df.write.option("parquet.block.size", group_bytes).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Remove a table made by ``written`` once nothing reads it any more."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for top in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(top)
        path.getFileSystem(conf).delete(path, True)


def quoted(name: str) -> str:
    """A column's name as a reference, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def columns_of(df: DataFrame) -> list:
    """All columns of ``df`` in order."""
    return [F.col(quoted(c)) for c in df.columns]


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


#: Tables up to this many bytes, by a sum over the table itself, are broadcast.
BROADCAST_BYTES = 32 << 20


def bounded(df: DataFrame, row_bytes) -> DataFrame:
    """``df`` (a written table), marked for broadcast where the sum of ``row_bytes`` over it is small."""
    size = df.agg(F.sum(row_bytes)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def ascii_lower(col):
    """A-Z to lower case and nothing else."""
    return F.translate(col, UPPER, LOWER)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions_for(spark: SparkSession, default: int = 12) -> int:
    return max(default, int(spark.conf.get("spark.sql.shuffle.partitions")))
