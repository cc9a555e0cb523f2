"""Readers: fixture readings, topic envelopes, poll payloads, table roots."""

from verdant.sources.fixture import load_readings, readings_from_events
from verdant.sources.messages import envelopes_from_readings, read_messages
from verdant.sources.payloads import payloads_from_readings, read_payloads
from verdant.sources.tables import read_table, select_run

__all__ = [
    "load_readings", "readings_from_events", "envelopes_from_readings", "read_messages",
    "payloads_from_readings", "read_payloads", "read_table", "select_run",
]
