"""All registered queries."""

from clearplate.registry import star, business, monitoring, geo, corpus, facts  # noqa: F401, I001
from clearplate.registry.base import ORACLES, QUERIES  # noqa: F401
