"""The folder that driver and executors share, and helpers around it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOCAL_CHECKPOINTS = "/tmp/checkpoints/voicecorpus"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.  Where it is unset, a folder of this machine for
    a local master, as in tests; on a cluster an error, as executors couldn't read that."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        named = LOCAL_CHECKPOINTS
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
    return named


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder on whatever file system it is; nothing there is no error."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it from there: lineage ends, executors may go."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 32 << 20
_FIXED = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "float": 4, "long": 8, "double": 8, "date": 4, "timestamp": 8}


def fits(df: DataFrame, rows: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``rows`` rows and about ``most`` bytes, both counted, up to one
    row past the limit.  For tables that are already written."""
    loose = [F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType.typeName() not in _FIXED]
    fixed = 16 + sum(_FIXED.get(f.dataType.typeName(), 8) for f in df.schema.fields)
    width = sum((F.coalesce(F.length(c.cast("string")), F.lit(0)) for c in loose), F.lit(fixed)).cast("long")
    n, size = df.limit(rows + 1).agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return n <= rows and size <= most


def sized(df: DataFrame, rows: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it ``fits``; else as it is, for a shuffled join."""
    return F.broadcast(df) if fits(df, rows, most) else df


HOT = 1000


def join_counted(big: DataFrame, small: DataFrame, key: str, n: str = "n") -> DataFrame:
    """``big`` joined to ``small``, which has one row for each key and in ``n`` how many rows of
    ``big`` have it.  All of ``small`` is broadcast if it fits; else only the keys of more than a
    thousandth of the rows (fewer than a thousand), and the others, none of them large, meet
    in a shuffle.  So no task gathers a hot key."""
    if fits(small):
        return big.join(F.broadcast(small), key)
    total = small.agg(F.sum(n)).first()[0] or 0
    hot, cold = small.where(F.col(n) * HOT > total), small.where(F.col(n) * HOT <= total)
    rest = big.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return rest.unionByName(big.join(F.broadcast(hot), key).select(rest.columns))


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds
