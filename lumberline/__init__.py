"""Log analytics on Spark: raw text lines to tables, counts, trends and read-only SQL."""

from lumberline import operators, plans, sources, streaming
from lumberline.operators import *  # noqa: F403
from lumberline.plans import *  # noqa: F403
from lumberline.schema import CLEAN_SCHEMA, LOG_SCHEMA, RAW_SCHEMA
from lumberline.sources import *  # noqa: F403
from lumberline.streaming import *  # noqa: F403

__all__ = [
    "CLEAN_SCHEMA",
    "LOG_SCHEMA",
    "RAW_SCHEMA",
    *operators.__all__,
    *plans.__all__,
    *sources.__all__,
    *streaming.__all__,
]
