"""Column-level building blocks (projections and scalar functions)."""

from tillroll.functions.columns import *  # noqa: F401,F403
