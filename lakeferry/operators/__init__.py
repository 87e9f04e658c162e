"""DataFrame operators: message transforms, statistics, compaction, vacuum."""
