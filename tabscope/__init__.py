"""tabscope: profiling, auditing and feature analytics for Spark DataFrames.

Every operator takes DataFrames (plus column lists / a target name) and
returns a DataFrame whose plan Catalyst optimises.  Shared one-pass
building blocks live in :mod:`tabscope.plans.frames`.
"""

from tabscope.config import Config

__all__ = ["Config"]
__version__ = "0.1.0"
