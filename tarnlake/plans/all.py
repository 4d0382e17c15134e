"""All queries over the library's own operators, and their SQL: importing this module registers them."""

from tarnlake.plans import basics, measures, models, privacy, publishing, quality, questions, retraining, stays, storage, texts  # noqa: F401
from tarnlake.plans.registry import ORACLE_SQL, QUERIES  # noqa: F401
