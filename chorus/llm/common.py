"""Small things several operators share: words, sentinels, written tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chorus.operators.scale import lookup, semi

WORD_GAP = r"[ \t\n\x0B\f\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_BYTES = 8 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that hands workers at most 8 MB of rows at a time, whatever a row's size."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def words(text: Column) -> Column:
    """Runs of anything but space and U+0009 to U+000D; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP, -1), "")


def held_out(key: Column, modulus: int, remainder: int) -> Column:
    """Whether the CRC-32 of the key's decimal text falls on ``remainder``; a null key never does."""
    code = F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return key.isNotNull() & (F.pmod(code, F.lit(modulus)) == remainder)


def repeats(docs: DataFrame, key: str) -> bool:
    """Whether some key is null or names several rows, so that a key alone does not tell rows apart."""
    total, known = docs.agg(F.count("*"), F.countDistinct(key)).first()
    return total != known


def with_text(key: str, text: str) -> Column:
    """The key and a digest of the text: one value for rows that agree in both."""
    return F.struct(F.col(key).alias("k"), F.xxhash64(text).alias("d"))


def rows_of(docs: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows whose key, null included, is wanted; they move only if the keys are too many to broadcast."""
    mark = fresh(docs.columns, "mark")[0]
    keyed = docs.withColumn(mark, F.struct(F.col(key)))
    return semi(keyed, wanted.select(F.struct(F.col(key)).alias(mark)), [mark]).drop(mark)


def rows_without(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Rows whose key, null included, is not in ``gone`` (distinct keys); columns stay as they are."""
    mark, hit = fresh(docs.columns, "mark", "hit")
    marked = docs.withColumn(mark, F.struct(F.col(key)))
    table = gone.select(F.struct(F.col(key)).alias(mark), F.lit(True).alias(hit))
    return lookup(marked, table, [mark], how="left").filter(F.col(hit).isNull()).select(*docs.columns)


def fresh(names: list[str], *wanted: str) -> list[str]:
    """Column names close to ``wanted`` that do not clash, whatever their case, with ``names``."""
    taken = {n.lower() for n in names}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
