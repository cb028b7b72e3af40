
from forgeline.catalog import ingest, models, quality, runs, scoring  # noqa: F401  (registration side effects)
from forgeline.catalog.base import ORACLE, QUERIES  # noqa: F401
