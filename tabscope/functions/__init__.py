from tabscope.functions.exprs import (col, safe_div, sig_round, sig_round_sql, skew_corrected,
                                      kurt_corrected, nan_to_null)

__all__ = ["col", "safe_div", "sig_round", "sig_round_sql", "skew_corrected", "kurt_corrected",
           "nan_to_null"]
