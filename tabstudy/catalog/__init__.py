"""Every operator bound to the given tables, with the SQL that states its result."""

from tabstudy.catalog import basics, experiments, figures, modelling, profiles, sampling, scoring  # noqa: F401
from tabstudy.catalog.registry import ORACLES, QUERIES  # noqa: F401
