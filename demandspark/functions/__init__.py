"""Pure ``Column`` builders; every function here compiles to built-in Catalyst expressions."""

from demandspark.functions import category, metrics, numeric, time
from demandspark.functions.space import prefix

__all__ = ["category", "metrics", "numeric", "time", "prefix"]
