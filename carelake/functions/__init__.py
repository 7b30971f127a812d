from carelake.functions.columns import (exact_sum, flag, lenient_cast, month_of,
                                        pearson, request_url, rounded)

__all__ = ["exact_sum", "flag", "lenient_cast", "month_of", "pearson",
           "request_url", "rounded"]
