from .numeric import mean_amount, pearson, percent, ratio, round_half_up, share
from .labels import level_rank

__all__ = ["level_rank", "mean_amount", "pearson", "percent", "ratio", "round_half_up", "share"]
