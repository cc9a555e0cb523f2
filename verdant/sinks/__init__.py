"""Writers: partitioned tables, topic sinks, keyed merges."""

from verdant.sinks.tables import merge_into_table, write_partitions, write_topics

__all__ = ["merge_into_table", "write_partitions", "write_topics"]
