"""One runnable query per operator, with the SQL that must give the same rows."""

from ferryline.checks import (  # noqa: F401  (imports register the checks)
    feed_checks,
    inventory_checks,
    load_checks,
    relational_checks,
    runlog_checks,
    scalar_checks,
    skew_checks,
)
from ferryline.checks.registry import CHECKS  # noqa: F401
