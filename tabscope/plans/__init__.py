from tabscope.plans.frames import (per_feature, long_values, value_counts, quantiles, bounded,
                                   class_moments)

__all__ = ["per_feature", "long_values", "value_counts", "quantiles", "bounded", "class_moments"]
