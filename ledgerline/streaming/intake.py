"""Load report files as they arrive in a folder.

The file stream source remembers, in its checkpoint, which files were
already loaded; this replaces the "already loaded today?" prompt with exact
per-file tracking.  Each micro-batch (the files new since the last one) goes
through the same transforms and cut-off, is de-duplicated, and is written
to ``<target>/batch=<id>`` with overwrite, so a re-run batch after a failure
replaces its own output instead of appending twice.

Note the scope of de-duplication: within one micro-batch, as the original
de-duplicated within one run.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.sources.csv_text import (
    LINE_SEP_TOKEN, PAIRED, decode_line_per_line, opens_quote, parse_cells, read_report_csv, repair_line,
)
from ledgerline.sources.files import suffix_glob


def csv_report_stream(spark: SparkSession, folder: str, names: Sequence[str],
                      encoding: str = "UTF-8", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of named string cells from CSV report files in ``folder``.

    ``encoding`` is a charset, or ``'per-line'`` (UTF-8 where a line's bytes
    are valid UTF-8, else ISO-8859-1), since a stream has no profile pass.  A
    line that opens a quoted cell without ending it, or has more cells than
    names, ends the batch with an error that names the file: its cells cannot be
    told from single lines.  :func:`csv_file_stream` reads such files whole.
    """
    per_line = encoding == "per-line"
    reader = (spark.readStream.schema("line string").option("header", True).option("sep", LINE_SEP_TOKEN)
              .option("quote", "").option("encoding", "ISO-8859-1" if per_line else encoding)
              .option("pathGlobFilter", suffix_glob(("csv",))))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.csv(folder)
    line = F.rtrim(F.col("line"), F.lit("\r"))
    if per_line:
        line = decode_line_per_line(line)
    whole = repair_line(line)
    wider = [*(f"c{i}" for i in range(len(names))), "more"]
    cells = lines.select(F.col("_metadata.file_name").alias("source_file"), whole.alias("line"), parse_cells(whole, wider).alias("c"))
    fault = F.when(opens_quote(F.col("line")) | ~F.col("line").rlike(PAIRED) & F.col("line").startswith('"'), F.lit("a quoted cell goes on in the next line")) \
        .when(F.col("c")["more"].isNotNull(), F.lit(f"a line has more than {len(names)} cells"))
    refused = F.raise_error(F.concat(F.lit("CSV file "), "source_file", F.lit(": "), fault)).cast("string")
    first = F.when(fault.isNotNull(), refused).otherwise(F.col("c")[wider[0]])
    return cells.select("source_file", first.alias(names[0]), *[F.col("c")[w].alias(n) for w, n in zip(wider[1:], names[1:])])


def csv_file_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of the ``path`` of each CSV file in ``folder``; contents are not read.

    With :func:`read_batch`, each micro-batch goes through the batch reader and
    all of its checks: encodings by the bytes, header width, line breaks in cells.
    """
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary") \
        .option("pathGlobFilter", suffix_glob(("csv",)))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(folder).select("path")


def read_batch(batch: DataFrame, names: Sequence[str], encoding: str = "auto") -> DataFrame:
    """The cells of a micro-batch's files, by :func:`read_report_csv`; the paths of one batch are listed on the driver
    (``max_files_per_trigger`` bounds them)."""
    paths = [r.path for r in batch.select("path").collect()]
    if not paths:
        empty = ", ".join(f"`{n}` string" for n in ["source_file", *names])
        return batch.sparkSession.createDataFrame([], empty)
    return read_report_csv(batch.sparkSession, paths, names, encoding)[0]


def start_intake(stream: DataFrame, load: Callable[[DataFrame], DataFrame], target_path: str,
                 checkpoint: str, once: bool = True) -> StreamingQuery:
    """Run ``load`` (a batch ``DataFrame -> DataFrame`` report load) on every
    micro-batch and write the result idempotently per batch id."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        load(batch).write.mode("overwrite").parquet(f"{target_path.rstrip('/')}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    return writer.start()


def start_report_intake(stream: DataFrame, spec, parse: Callable, ctx, target_path: str, checkpoint: str,
                        once: bool = True) -> StreamingQuery:
    """Report load per micro-batch, with its audit.

    ``parse`` is a report transform such as ``sd_text_parsed`` (raw cells ->
    parsed rows).  Each batch writes its rows to ``<target>/batch=<id>`` and a
    one-row audit (the same checked metrics as ``publish``) to ``<target>/_audit/batch=<id>``, which readers of the
    target skip; both are overwritten if the batch is replayed.
    """
    from pyspark.sql import Observation

    from ledgerline.operators.cutoff import post_dedupe_metrics
    from ledgerline.plans.reports import finish
    from ledgerline.sinks.publish import AUDIT_DDL, _observed, checked_metrics

    base = target_path.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        obs_in = Observation(f"{spec.name.lower()}_in_{batch_id}")
        obs_out = Observation(f"{spec.name.lower()}_out_{batch_id}")
        parsed = parse(batch, ctx)
        loaded = finish(parsed, spec, ctx, observation=obs_in)
        path = f"{base}/batch={batch_id}"
        loaded.observe(obs_out, *post_dedupe_metrics(spec.date_column)).write.mode("overwrite").parquet(path)
        written = batch.sparkSession.read.schema(loaded.schema).parquet(path)
        audit = {"report": spec.name, "read_mode": "stream", "status": "loaded", "elapsed_s": 0} \
            | checked_metrics(parsed, written, spec, ctx, _observed(obs_in), _observed(obs_out))
        (batch.sparkSession.createDataFrame([audit], AUDIT_DDL).withColumn("batch_id", F.lit(batch_id))
             .write.mode("overwrite").parquet(f"{base}/_audit/batch={batch_id}"))

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    return writer.start()
