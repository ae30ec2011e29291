"""Optional: screens of alignments that land in a folder, batch by batch. The batch pipeline has no unbounded input;
this runs its summaries by foreachBatch over each batch's own rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import mismatch_count
from ..operators import assign
from ..sources.tables import GENOME_ALIGNMENTS


def assigned_stream(spark: SparkSession, folder: str, expected: DataFrame, controls: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Calls sink(assigned alignments, batch id) for each new set of alignment files. A read's alignments must land in
    one batch."""
    schema = ", ".join(f"`{c}` {t}" for c, t in GENOME_ALIGNMENTS.items())
    rows = spark.readStream.schema(schema).option("header", True).option("sep", "\t").option("quote", "").csv(folder)

    def each(batch: DataFrame, number: int) -> None:
        df = batch.withColumns({"mismatches": mismatch_count(F.col("mismatches")), "length": F.length("sequence")})
        best = assign.best_alignments(assign.annotate(df, expected, controls))
        sink(assign.assign(best, ["genome", "chromosome", "position", "strand"]).filter("assigned"), number)

    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
