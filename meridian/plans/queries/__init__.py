"""Registered queries by area; importing this package registers all of them."""

from meridian.plans.queries import staging  # noqa: F401  (registration order = bench order)
from meridian.plans.queries import paging  # noqa: F401
from meridian.plans.queries import catalog  # noqa: F401
from meridian.plans.queries import specs  # noqa: F401
from meridian.plans.queries import providers  # noqa: F401
from meridian.plans.queries import records  # noqa: F401
from meridian.plans.queries import landing  # noqa: F401
from meridian.plans.queries.staging import flagship  # noqa: F401
from meridian.plans.registry import ORACLES, QUERIES  # noqa: F401
