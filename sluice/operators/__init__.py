"""DataFrame operators: partitions, dedup, counts, sinks, watermark,
config, audit and restart.  Import the submodules directly."""
