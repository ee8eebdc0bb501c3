from hitlist.functions.numeric import avg2, avg2_money
from hitlist.functions import artist

__all__ = ["avg2", "avg2_money", "artist"]
