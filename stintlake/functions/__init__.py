"""Column builders: plain functions that return a ``Column``."""

from stintlake.functions.columns import *  # noqa: F401,F403
