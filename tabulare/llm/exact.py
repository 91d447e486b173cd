"""Exact copies by keyed streaming state on disk, with the full bytes compared where digests meet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabulare.llm.rows import id_and_text, packed
from tabulare.session import run_folder, work_table

STATE = "spark.sql.streaming.stateStore"
STATE_SETTINGS = {
    f"{STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Only what a batch changes is written to the shared folder, and no disk is set aside for what may come.
    f"{STATE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{STATE}.rocksdb.allowFAllocate": "false",
}
SALTS = 64


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def keyed_state(rows: DataFrame, state_folder: str) -> None:
    """Run a stream of (``_digest``, ``_id``, ``_locator``) into keyed state until its source is used up.

    The state lives in RocksDB with its changes in ``state_folder`` and has no
    expiry: per digest the largest identifier with the place of its content,
    and the number of rows. Called again with the same folder, it goes on with
    the files that came since, so a stopped run is resumed where it was.
    """
    spark = rows.sparkSession
    before = {name: spark.conf.get(name, None) for name in STATE_SETTINGS}
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        (
            rows.groupBy("_digest")
            .agg(F.max(F.struct("_id", "_locator")).alias("_keep"), F.count("*").alias("_rows"))
            .writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", state_folder)
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def read_state(spark: SparkSession, state_folder: str) -> DataFrame:
    """The groups in the state: ``_digest``, ``_keep_id``, ``_keep_locator`` and ``_rows``."""
    state = spark.read.format("statestore").load(state_folder)
    keep, count = (F.col("value").getField(name) for name in state.schema["value"].dataType.names)
    return state.select(
        F.col("key").getField(state.schema["key"].dataType.names[0]).alias("_digest"),
        keep.getField("_id").alias("_keep_id"),
        keep.getField("_locator").alias("_keep_locator"),
        count.alias("_rows"),
    )


def group_copies(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = sha256,
    files_per_trigger: int = 64,
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """The digest of every row, the groups of equal digests, and the digests that different texts share, if any.

    The digests land as files, which a stream takes in batches of
    ``files_per_trigger`` into the keyed state. A digest found more than once
    is a hit: the texts of its rows are compared in full, through the smallest
    and the largest of them, which are the same only if all are. Rows of one
    digest are salted for that, so a group of any size is spread over tasks.
    """
    spark = docs.sparkSession
    narrow = id_and_text(docs, key, text).withColumn("_digest", digest(F.col("_text")))
    # Where a row lies: its file, and a number that no other row has.
    place = F.concat_ws("#", F.input_file_name(), F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0"))
    landed = narrow.select("_digest", "_id", place.alias("_locator"))
    folder = run_folder(spark, "exact")
    landed.write.parquet(f"{folder}/digests")
    digests = spark.read.schema(landed.schema).parquet(f"{folder}/digests")
    stream = (
        spark.readStream.schema(landed.schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(f"{folder}/digests")
    )
    keyed_state(stream, f"{folder}/state")
    groups = work_table(read_state(spark, f"{folder}/state"), "groups")

    hits = groups.where("_rows > 1").select(F.col("_digest").alias("_hit"))
    salted = F.concat("_digest", F.encode(F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("string"), "UTF-8")).alias("_salted")
    compared = (
        narrow.join(hits, F.col("_digest") == F.col("_hit"))
        .select(salted, "_digest", "_text")
        .groupBy("_salted")
        .agg(F.first("_digest").alias("_digest"), F.min("_text").alias("_low"), F.max("_text").alias("_high"))
        .groupBy("_digest")
        .agg(F.min("_low").alias("_low"), F.max("_high").alias("_high"))
        .where(F.col("_low") != F.col("_high"))
        .select(F.col("_digest").alias("_shared"))
    )
    shared = work_table(compared, "shared")
    return digests, groups, None if shared.isEmpty() else shared


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row: ``doc_id``, ``keep_id``, ``keep_locator``, ``group_size``, ``kept`` and the ``digest`` of its text.

    Of equal texts the row with the largest key stays; a null key is smaller
    than any other, and of rows with the same key and text one stays. Null and
    empty texts are equal to each other. An empty table gives no rows.
    """
    digests, groups, shared = group_copies(docs, key, text, **options)
    by_digest = groups.withColumnRenamed("_digest", "_of")
    # Nothing that needs a group's rows together: a large one is split by Spark where it is joined.
    plain = digests.join(by_digest, F.col("_digest") == F.col("_of")).withColumn("_stays", F.col("_locator") == F.col("_keep_locator"))
    if shared is not None:
        rows = id_and_text(docs, key, text).withColumn("_digest", options["digest"](F.col("_text")))
        rows = rows.join(shared, F.col("_digest") == F.col("_shared")).drop("_shared")
        classes = rows.groupBy("_digest", "_text").agg(
            F.max("_id").alias("_keep_id"), F.lit("").alias("_keep_locator"), F.count("*").alias("_rows")
        )
        first = F.row_number().over(Window.partitionBy("_digest", "_text", "_id").orderBy("_keep_locator"))
        apart = rows.join(classes, ["_digest", "_text"]).withColumn("_stays", F.col("_id").eqNullSafe(F.col("_keep_id")) & (first == 1))
        alone = plain.join(shared, F.col("_digest") == F.col("_shared"), "left_anti")
        plain = alone.drop("_of", "_locator").unionByName(apart.drop("_text"))
    return plain.select(
        F.col("_id").alias("doc_id"),
        F.col("_keep_id").alias("keep_id"),
        F.col("_keep_locator").alias("keep_locator"),
        F.col("_rows").alias("group_size"),
        F.col("_stays").alias("kept"),
        F.col("_digest").alias("digest"),
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with the columns they came with.

    Null and empty texts are equal; a null key is smaller than any other; of
    rows with the same key and text one stays; columns may hold anything, maps
    too; an empty table stays empty.
    """
    _, groups, shared = group_copies(docs, key, text)
    if shared is not None:
        raise ValueError("two different texts have the same SHA-256")
    keepers = groups.select(F.col("_digest").alias("_of"), F.col("_keep_id").alias("_keep"))
    rows = packed(docs, _id=key, _text=text).withColumns(
        {"_id": F.col("_id").cast("bigint"), "_digest": sha256(F.coalesce("_text", F.lit(""))), "_tie": F.monotonically_increasing_id()}
    )
    one = Window.partitionBy("_digest", "_id").orderBy("_tie")
    return (
        rows.drop("_text")
        .join(keepers, (F.col("_digest") == F.col("_of")) & F.col("_id").eqNullSafe(F.col("_keep")))
        .withColumn("_n", F.row_number().over(one))
        .where("_n = 1")
        .select("_row.*")
    )
