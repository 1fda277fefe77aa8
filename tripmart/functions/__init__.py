"""Column expressions (all built-in Spark functions, codegen friendly)."""

from tripmart.functions.columns import *  # noqa: F401,F403
