"""From failures and failure percentage to PASS, WARN or FAIL."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"


@dataclass(frozen=True)
class RuleSet:
    """No failures pass. Then, in this order: ``always_pass``, ``always_fail``, the tolerance of the
    check's group (WARN up to that percentage, inclusive), and FAIL for the rest.

    The group of a check is its type, or its severity when ``by_severity`` is set. ``always_pass`` maps
    a group to a LIKE pattern of check names.
    """

    warn_up_to: dict[str, float] = field(default_factory=dict)
    always_fail: tuple[str, ...] = ()
    always_pass: dict[str, str] = field(default_factory=dict)
    by_severity: bool = False

    def status(self, name: Column, check_type: Column, severity: Column, failures: Column, pct: Column) -> Column:
        group = severity if self.by_severity else check_type
        status = F.when(failures == 0, PASS)
        for value, pattern in self.always_pass.items():
            status = status.when((group == value) & name.like(pattern), PASS)
        if self.always_fail:
            status = status.when(name.isin(*self.always_fail), FAIL)
        for value, limit in self.warn_up_to.items():
            status = status.when((group == value) & (pct <= limit), WARN)
        return status.otherwise(FAIL)


# The rule sets of the suites.
STRICT = RuleSet()
SOURCE_RULES = RuleSet(
    warn_up_to={"COMPOSITE_KEY": 1.0, "OTHER_DQ": 2.0},
    always_pass={"MONTHLY_COUNT": "%"},
    by_severity=True,
)
SILVER_ZONE_RULES = RuleSet(
    warn_up_to={"UNIQUE": 1.0, "NULL": 1.0, "VOLUME": 2.0, "STANDARDIZATION": 1.0, "LINEAGE": 1.0, "VALIDITY": 1.0},
    always_fail=("Missing location_id",),
)
LOCATION_RULES = RuleSet(
    warn_up_to={"UNIQUE": 1.0, "RANGE": 1.0, "ACCEPTED_VALUE": 1.0, "BUSINESS_RULE": 1.0,
                "REFERENTIAL_INTEGRITY": 1.0, "VOLUME": 2.0, "NULL": 1.0},
    always_fail=("Missing location_key", "Missing location_id", "Missing borough", "Missing zone",
                 "Missing service_zone"),
)
FACT_RULES = RuleSet(
    warn_up_to={"UNIQUE": 1.0, "RANGE": 1.0, "ACCEPTED_VALUE": 1.0, "REFERENTIAL_INTEGRITY": 1.0, "VOLUME": 2.0,
                "NULL": 1.0},
    always_fail=("Missing trip_key", "Missing surrogate FK columns"),
    always_pass={"REFERENTIAL_INTEGRITY": "%weather%"},
)
