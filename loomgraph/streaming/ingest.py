"""An extension: new documents as a stream.

Chunking per document is a window over its rows, which a stream cannot order on its own, so each micro-batch of whole
documents is chunked, linked and embedded as a batch plan and appended in one write per batch id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from loomgraph.operators import chunking, embedding, linking


def ingest(documents: DataFrame, keys: DataFrame, out: str, checkpoint: str, provider: str = "hashed", options: dict | None = None) -> StreamingQuery:
    """Starts a query over streaming documents (slug, text); chunks and vectors go to folders below ``out``, by batch, so
    that a batch that runs again replaces its own output."""

    def write(batch: DataFrame, number: int) -> None:
        chunks = linking.with_entities(chunking.chunk(batch, "slug"), keys).persist()
        chunks.write.mode("overwrite").parquet(f"{out}/chunks/batch={number}")
        embedding.embed(chunks.select("id", "text"), provider, options).write.mode("overwrite").parquet(f"{out}/vectors/batch={number}")
        chunks.unpersist()

    return documents.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
