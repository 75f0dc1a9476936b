from dunlin.plans import (  # noqa: F401
    compliance, messages, payments, scorecard, scoring, speech,
)
