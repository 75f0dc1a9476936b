from dunlin.streaming import streams  # noqa: F401
