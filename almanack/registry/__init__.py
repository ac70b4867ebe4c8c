"""Every query of the library with its SQL twin."""

from almanack.registry import abnormal, history, models, preparation, weather  # noqa: F401
from almanack.registry.base import ORACLES, QUERIES  # noqa: F401
