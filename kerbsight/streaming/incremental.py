"""Extension: candidates of search pages as they arrive, by Structured Streaming.

The batch operators are stateless from feature to candidate, so they run on a
stream as they are.  What a batch survey dedupes by page order is deduped here by id
among the pages of the watermark's span; limits and sorts belong to batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import survey


def candidates(pages: DataFrame, target: survey.Target, *, arrived: str = "arrived_at", late: str = "1 hour") -> DataFrame:
    """pages: a stream of (page_no, body, arrival time).  Append mode.  A page without a feature list
    stops the stream, as it fails a batch."""
    rows = survey.shredded(pages.withWatermark(arrived, late), carry=(arrived,))
    keyed = rows.withColumn("dedupe_key", survey.dedupe_key(F.col("id"))).where("dedupe_key is not null")
    first = keyed.dropDuplicatesWithinWatermark(["dedupe_key"])
    return survey.candidates(survey.items(first), target)
