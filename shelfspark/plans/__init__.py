"""Every registered query, by area; importing the package fills the registry."""

from shelfspark.plans import exports, intake, offers, pages, paths, ranking, reviews, scalars, streams, variants  # noqa: F401
from shelfspark.plans.registry import ORACLES, QUERIES  # noqa: F401
