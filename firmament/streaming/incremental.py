"""Pick up extraction documents that came in since the last run."""

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from firmament.sources.documents import document_path, literal_path, lower_listing_tasks, modified_since
from firmament.sources.extractions import damaged_documents, read_extraction_csvs, without_documents
from firmament.sources.sinks import overwrite

LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_new_extractions(spark: SparkSession, folder: str, target: str, checkpoint: str,
                           files_per_batch: int = 10_000) -> StreamingQuery:
    """Add the rows of documents not seen before to ``target``, then stop.

    What streams is the listing of files, without their contents; the checkpoint remembers it, so nothing is compared with the
    target. A batch is stored as listed, its files alone are scanned, and every document of it ends either in
    ``target`` or in ``target``-rejects: damaged, or without any row. ``target``-ledger has one row for each document of a
    batch: its bytes, its rows, and the reason if it was rejected. Rejected documents are to be landed again under another name.

    Each batch has a partition of its own in all three that it overwrites, so a batch that is run again leaves no repeats.
    ``checkpoint`` must be a folder all nodes can reach. The source lists with the session's settings while it runs, so the number of listing
    tasks stays lowered there. Files of no bytes do not show in Spark's listings.
    """
    lower_listing_tasks(spark)
    listing = (
        spark.readStream.format("binaryFile").schema(LISTING)
        .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("path", "modificationTime", "length")
    )
    target = target.rstrip("/")

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        at = {name: f"{target}-{name}/batch={batch_id}" for name in ("listing", "rejects", "ledger")}
        overwrite(batch.withColumn("source_file", document_path(F.col("path"))), at["listing"])
        files = session.read.parquet(at["listing"])
        # The files of a batch are named to the scans, at most ``files_per_batch`` of them: a listing of the folder would go over all batches' files in each.
        paths = [literal_path(r.path) for r in files.select("path").distinct().collect()]
        if not paths:  # no file in this batch
            return

        def scan(read: Callable[..., DataFrame]) -> DataFrame:
            try:
                return read(session, paths, files)
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
                return read(session, folder, files, **modified_since(files))  # a file is gone since: what is there is scanned

        staged = f"{target}-staged"
        overwrite(scan(read_extraction_csvs), staged)
        rows = session.read.parquet(staged)
        found = rows.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))
        documents = files.groupBy("source_file").agg(F.sum("length").alias("bytes")).join(found, "source_file", "left")
        checked = documents.join(scan(damaged_documents), "source_file", "left")
        checked = checked.withColumn("reason", F.coalesce("reason", F.when(F.col("rows").isNull(), "no rows")))
        overwrite(checked.select("source_file", "bytes", F.coalesce("rows", F.lit(0)).alias("rows"), "reason"), at["ledger"])
        ledger = session.read.parquet(at["ledger"])
        overwrite(ledger.where("reason IS NOT NULL").select("source_file", "reason"), at["rejects"])
        overwrite(without_documents(rows, session.read.parquet(at["rejects"])), f"{target}/batch={batch_id}")

    return (
        listing.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
