"""Tables and topics: reading, writing, compaction."""
