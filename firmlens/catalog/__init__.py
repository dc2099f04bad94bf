from firmlens.catalog import analysis, inputs, models, panels  # noqa: F401
from firmlens.catalog.registry import QUERIES, SQL_TEXTS  # noqa: F401
