"""Credit-portfolio analytics as Spark DataFrame transformations."""

GRAIN = ["facility_id", "tranche_id", "branch_id"]
