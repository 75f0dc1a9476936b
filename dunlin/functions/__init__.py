from dunlin.functions import dates, labels, text  # noqa: F401
