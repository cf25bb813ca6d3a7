"""Named queries over the sample tables, each with its check in SQL where SQL can say it."""

from tillwork.suite import (  # noqa: F401
    basics,
    experiments,
    functions,
    joins_aggs,
    loads,
    quality,
    reports,
    streams,
    warehouse,
)
from tillwork.suite.registry import ORACLES, QUERIES  # noqa: F401
