"""Every query outside the llm subpackage, with its SQL where SQL can express it."""

from offerloom.plans import base, catalogue, evaluations, logs, more, offers, reports  # noqa: F401  the modules register their queries

FLAGSHIP = "business_metrics"
QUERIES = base.QUERIES
ORACLES = base.ORACLES
