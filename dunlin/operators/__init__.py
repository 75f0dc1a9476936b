from dunlin.operators import (  # noqa: F401
    aggregates, joins, measures, percentiles, ranking, sets, slices, windows,
)
