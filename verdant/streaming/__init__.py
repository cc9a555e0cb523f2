"""Structured Streaming jobs built from the batch operators."""

from verdant.streaming.bronze import bronze_stream, start_bronze
from verdant.streaming.ingest import start_ingest
from verdant.streaming.live import live_batch, start_live
from verdant.streaming.windowed import streaming_band_join, streaming_climate

__all__ = ["bronze_stream", "start_bronze", "start_ingest", "live_batch", "start_live", "streaming_band_join",
           "streaming_climate"]
