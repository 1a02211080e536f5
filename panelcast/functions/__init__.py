"""Column-level functions (built-in Spark expressions only)."""

from panelcast.functions.scalars import *  # noqa: F401,F403
from panelcast.functions.scalars import __all__  # noqa: F401
