"""All registered queries: importing the query modules fills the registry."""

from menumix.plans import cost_queries, report_queries, rule_queries, run_queries, source_queries  # noqa: F401
from menumix.plans.catalogue import QUERIES, SQL  # noqa: F401
