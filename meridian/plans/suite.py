"""Registered queries (Spark) and their SQL oracles, keyed by the same names.

Every query reads the driver tables at ``sf_dir`` (or data Spark derives from them)
and runs over whole tables. The queries live in ``meridian.plans.queries`` by area.
"""

from meridian.plans.queries import ORACLES, QUERIES, flagship  # noqa: F401
