"""Column-level helpers: built-in Spark expressions only (stay inside codegen)."""

from voltaic.functions.columns import *  # noqa: F401,F403
from voltaic.functions.scoring import *  # noqa: F401,F403
