"""Sources and sinks: exports, the records fixture, checkpoints, written tables."""
