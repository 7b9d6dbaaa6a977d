"""Binds the library operators to the driver tables.

Each entry: key -> (callable(spark, sf_dir) -> DataFrame, oracle SQL or None).
Floating columns are rounded to 8 significant digits on both sides with the
same CASE chain (see functions.exprs.sig_round) so the value hash is stable
under different summation orders.
"""

from __future__ import annotations

from tabscope.registry.base import REGISTRY

# import for side effects (registration)
from tabscope.registry import q_profile  # noqa: F401,E402
from tabscope.registry import q_overlap  # noqa: F401,E402
from tabscope.registry import q_stats  # noqa: F401,E402
from tabscope.registry import q_features  # noqa: F401,E402
from tabscope.registry import q_models  # noqa: F401,E402

__all__ = ["REGISTRY"]
