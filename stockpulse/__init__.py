"""stockpulse — retail demand, inventory-risk and customer analytics on Spark.

Every stage is a lazy DataFrame transformation; see README.md for the map
from business operators to Spark primitives.
"""

from stockpulse.params import Params

__all__ = ["Params"]
