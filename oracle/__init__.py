from oracle import base, models  # noqa: F401  (registers the CTEs in order)
from oracle.base import with_models

__all__ = ["with_models"]
