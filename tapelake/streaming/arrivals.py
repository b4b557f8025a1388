"""Load tape files and archives that arrived since the last run, each exactly once.

Tape files are appended: the transformation is stateless (canonical table, then four joins with the static price index), so no
watermark or state store is needed; the checkpoint remembers which files are done.

Archives go into the lake batch by batch. The stream is the list of archives, with Spark's own log of which batch has which; a
batch replaces, in bronze and silver, the partitions of the archives and quarters it has, and brings the later layers up to date.
A batch that failed anywhere is run again with the same archives and replaces the same partitions, so no row is lost or doubled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapelake.operators.canonical import canonical
from tapelake.operators.contract import FNM
from tapelake.operators.valuation import mark_to_market
from tapelake.plans import lakehouse
from tapelake.sources import archives, sinks
from tapelake.sources.tapes import FNM_WIDTH, layout_fields

_FILES = "path string, modificationTime timestamp, length long, content binary"
_LOADS = {"fnm": lakehouse.load_fnm, "fre": lakehouse.load_fre}


def fnm_arrivals(spark: SparkSession, folder: str, width: int = FNM_WIDTH, files_per_batch: int = 1000) -> DataFrame:
    """Single-file tapes under ``folder`` as a stream of positional string columns and ``beyond``, the fields past the layout."""
    return layout_fields(spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder), width)


def append_marked(arrivals: DataFrame, index: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the marked loan-months of everything available to Parquet at ``path``, then stop.

    There is no silver layer on this way, so the rows keep ``beyond``.
    """
    marked = mark_to_market(canonical(arrivals, FNM, keep=("beyond",) if "beyond" in arrivals.columns else ()), index)
    writer = marked.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start(path)


def archive_arrivals(spark: SparkSession, folder: str, archives_per_batch: int = 100) -> DataFrame:
    """The archives under ``folder`` as a stream of their paths; what is in them is not read here."""
    files = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true")
    return files.option("maxFilesPerTrigger", archives_per_batch).load(folder).select("path")


def load_archives(arrivals: DataFrame, layout: str, root: str, checkpoint: str) -> StreamingQuery:
    """Bring all available archives of a layout (``fnm`` or ``fre``) into the lake at ``root``, then stop.

    The lake's index layer has to be there. The status of every batch is kept under ``status/<layout>``, a partition per batch.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        status = _LOADS[layout](spark, archives.entries_of(batch), root)
        sinks.write_layer(status.withColumn("batch", F.lit(batch_id)), f"{root}/status/{layout}", partition_by=("batch",))
        lakehouse.Lake(spark, root).update()

    return arrivals.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
