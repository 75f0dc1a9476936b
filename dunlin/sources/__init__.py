from dunlin.sources import checkpoints, scans, sinks  # noqa: F401
