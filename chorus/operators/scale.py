"""Building blocks that keep work even when one key holds a large share of the rows."""

import tempfile
from functools import reduce
from uuid import uuid4
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
#: A shuffle join builds a hash table of at most so much on average, uncompressed, in a task.
HASHED_BYTES = 32 * 1024 * 1024
TOP_SALTS = 32

_local_dirs: dict[str, str] = {}
#: Where ``pin`` wrote the tables it returned that are still in use.
_written: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def work_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _local_dirs:
            _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="chorus-")
        base = _local_dirs[context.applicationId]
    return f"{base.rstrip('/')}/chorus/{context.applicationId}"


def pin(df: DataFrame, label: str, by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the work folder and read it back, cutting lineage.

    Several passes over the result cost one computation, and a lost executor
    costs nothing because the rows live on shared storage. With ``by`` the table
    is laid out in one directory per key, so that filters on keys prune.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{label}-{uuid4().hex}"
    if by:
        gathered(df, by).write.partitionBy(*by).parquet(path)
    else:
        df.write.parquet(path)
    made = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    _written[made] = path
    return made


def unpin(df: DataFrame) -> None:
    """Delete the rows of a table that ``pin`` returned; nothing made of it may be read any more."""
    path = _written.pop(df, None)
    if path:
        files, place = _files(df.sparkSession, path)
        files.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _files(spark, path)
    return files.exists(place)


def _files(spark: SparkSession, path: str) -> tuple:
    """The file system that holds ``path``, and the path as it takes it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def gathered(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows of a key in few partitions; adaptive execution splits a key too large for one."""
    return df.hint("rebalance", *[F.col(c) for c in by])


def spread(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Place rows by their keys, by default over the session's shuffle partitions.

    The count is given so that adaptive execution does not merge partitions by
    byte size: the text work that follows is far heavier than its bytes suggest.
    """
    most = _shuffle_partitions(df)
    return df.repartition(most if partitions is None else max(1, min(partitions, most)), *keys)


def lies_even(scan: DataFrame) -> bool:
    """Whether a scan's rows lie evenly in enough tasks to keep all cores busy; no column is read for it."""
    each = scan.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"))
    parts, most, rows = each.agg(F.count("*"), F.max("n"), F.sum("n")).first()
    return parts >= 2 * scan.sparkSession.sparkContext.defaultParallelism and most * parts <= 2 * rows


def _row_bytes(df: DataFrame) -> Column:
    def width(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(field.name), F.lit(0)) + 16
        if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            return F.coalesce(F.octet_length(F.to_json(field.name)), F.lit(0)) + 16
        return F.lit(8)

    return reduce(lambda a, b: a + b, [width(f) for f in df.schema.fields], F.lit(16))


def measure(df: DataFrame) -> int:
    """Uncompressed size of a table in bytes, computed where the rows are."""
    return df.agg(F.sum(_row_bytes(df)).cast("bigint")).first()[0] or 0


def lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    load: str | None = None,
    how: str = "inner",
    limit: int | None = None,
    hot_keys: int | None = None,
    nulls: bool = False,
) -> DataFrame:
    """Join many ``rows`` to a ``table`` that holds one row per (non-null) key.

    ``table`` is read more than once: pass a written table unless it is cheap.
    Measured below ``limit`` bytes it is broadcast. Beyond it, each key gets a
    load, the number of rows it will meet: the column named by ``load``, or
    counted from ``rows``. A key is hot when it alone would fill a shuffle
    partition's fair share, 1/``hot_keys`` of all load (default: the session's
    shuffle partitions), so there are fewer hot keys than that by arithmetic.
    Hot keys are broadcast and their rows never shuffled; all others are light
    and take a shuffle join. Without a hot key it is a plain shuffle join. That
    join hashes the table, not sorting the many rows, when a partition's share of
    it is measured below ``HASHED_BYTES``. A row with a null key matches nothing,
    whatever the size; a left join keeps it. With ``nulls``, null is a key like
    any other.
    """
    if nulls:
        return _unpacked(lookup(_packed(rows, keys), _packed(table, keys), ["_keys"], load, how, limit, hot_keys), keys)
    if how not in ("inner", "left", "known"):  # known: a left join of rows without a null key
        raise ValueError(f"unsupported join type {how!r}")
    limit = BROADCAST_BYTES if limit is None else limit
    if hot_keys is None:
        hot_keys = _shuffle_partitions(rows)
    whole = None if how == "known" else measure(table)
    if whole is not None and whole <= limit:
        return rows.join(F.broadcast(table), keys, how)
    if how == "left":
        unkeyed = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in keys])
        keyed = lookup(rows.filter(~unkeyed), table, keys, None, "known", limit, hot_keys)
        return keyed.unionByName(rows.filter(unkeyed), allowMissingColumns=True)
    counted = load is None or how == "known"
    if counted:
        load, known = _unused("_load", rows, table), _unused("_known", rows, table)
        met = rows.groupBy(*keys).agg(F.count("*").alias(load))
        table = pin(met.join(table.withColumn(known, F.lit(True)), keys, "left"), "lookup")
    cut = (table.agg(F.sum(load)).first()[0] or 0) / hot_keys
    hot = table.filter(F.col(load) > cut)
    hashed = whole is not None and not counted and whole <= HASHED_BYTES * _shuffle_partitions(rows)
    while (size := measure(hot)) > limit and cut > 0:
        cut *= 2
        hot = table.filter(F.col(load) > cut)
    if size:
        light = _to_hash(table.filter(F.col(load) <= cut), hashed)
        rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
        joined = rows.join(F.broadcast(hot), keys).unionByName(rest.join(light, keys))
    else:
        joined = rows.join(_to_hash(table, hashed), keys)
    if not counted:
        return joined
    if how == "inner":
        joined = joined.filter(F.col(known))
    return joined.drop(load, known)


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _unused(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores in front until no frame has a column of that name, whatever its case."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _to_hash(table: DataFrame, small: bool) -> DataFrame:
    return table.hint("shuffle_hash") if small else table


def _packed(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with its keys in one struct, which is never null and equal where all its fields are, null or not."""
    return df.select(F.struct(*[F.col(c) for c in keys]).alias("_keys"), *_others(df, keys))


def _unpacked(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*[F.col("_keys").getField(c).alias(c) for c in keys], *_others(df, ["_keys"]))


def _others(df: DataFrame, taken: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns if c not in taken]


def join_keyed(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join by keys, null being a key like any other; keys come first, once, from either side."""
    return _unpacked(_packed(left, keys).join(_packed(right, keys), "_keys", how), keys)


def match_null_safe(rows: DataFrame, table: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join in which null keys match each other; the key columns of ``rows`` are kept."""
    others = [c for c in table.columns if c not in keys]
    right = table.select(*[F.col(c).alias(f"_r_{c}") for c in keys], *others)
    same = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys]
    return rows.join(right, same, how).drop(*[f"_r_{c}" for c in keys])


def semi(rows: DataFrame, table: DataFrame, keys: list[str], limit: int | None = None, nulls: bool = False) -> DataFrame:
    """Rows whose key occurs in ``table``; the key list is broadcast only when measured small."""
    if nulls:
        return _unpacked(semi(_packed(rows, keys), _packed(table, keys), ["_keys"], limit), keys)
    wanted = table.select(*keys).distinct()
    if measure(wanted) <= (BROADCAST_BYTES if limit is None else limit):
        wanted = F.broadcast(wanted)
    return rows.join(wanted, keys, "left_semi")


def top_n(df: DataFrame, by: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows of every ``by`` group, exactly, with a 1-based rank.

    Each input task keeps at most ``n`` rows per group, a first round spreads a
    hot group over several tasks by input partition, and the final round sees
    only those survivors. Spark prunes in the input tasks up to a number it is
    set to, so ``n`` beyond that raises the setting for the session.
    """
    prunes = "spark.sql.optimizer.windowGroupLimitThreshold"
    if int(df.sparkSession.conf.get(prunes, "1000")) < n:
        df.sparkSession.conf.set(prunes, str(n))

    def cut(frame: DataFrame, keys: list[str]) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return frame.withColumn(rank, place).filter(F.col(rank) <= n)

    salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(TOP_SALTS)))
    return cut(cut(salted, [*by, "_salt"]).drop("_salt", rank), by)


def first_copy(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by ``order``; copies collapse inside each input task first."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_copy", place).filter(F.col("_copy") == 1).drop("_copy")


def rank_all(df: DataFrame, by: list[str], order: list[Column], rank: str = "rank") -> DataFrame:
    """``row_number()`` per ``by`` group without gathering a group in one task.

    Rows are range-partitioned on (group, order), so even a hot group or a long
    run of ties spans many partitions; the rank is the position inside the
    partition plus the rows of that group in earlier partitions.
    """
    keys = [F.col(c) for c in by]
    laid = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    fixed = pin(laid.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    fixed = fixed.withColumn("_part", F.shiftright("_at", 33))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        fixed.groupBy(*by, "_part")
        .agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    )
    placed = lookup(fixed, pin(runs, "runs"), [*by, "_part"], load="_rows", nulls=True)
    return placed.withColumn(
        rank, (F.col("_at") - F.col("_first") + F.col("_before") + 1).cast("bigint")
    ).drop("_at", "_part", "_first", "_rows", "_before")
