"""Ready-made queries. Importing the package fills the registry."""

from . import graph, layout, nested, profiling, qa, relational, shop, text  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401
