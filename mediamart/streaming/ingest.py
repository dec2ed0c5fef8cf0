"""New playlist extracts into the raw table, as files land.

The source remembers which files it has read, so a run handles only what is new.  A batch that
is repeated after a failure adds nothing twice, because videos already stored are left out.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mediamart.operators.ingest import flatten_playlists, new_raw_rows
from mediamart.schemas import PLAYLISTS
from mediamart.session import shared_folder
from mediamart.sources.tables import Tables


def follow_playlists(
    tables: Tables, landing: str, now: Column | None = None, checkpoint: str | None = None
) -> StreamingQuery:
    """Append the unseen videos of all playlist files landed since the last run, then stop."""
    spark = tables.spark
    stamp = F.current_timestamp() if now is None else now

    def add(batch: DataFrame, _: int) -> None:
        rows = new_raw_rows(tables.read("process_video"), flatten_playlists(batch), stamp)
        tables.append("process_video", rows)

    return (
        spark.readStream.schema(PLAYLISTS)
        .json(landing)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint or f"{shared_folder(spark)}/follow_playlists")
        .trigger(availableNow=True)
        .start()
    )
