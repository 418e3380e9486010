"""The retail medallion model built from the operators: silver and gold
builders, business reports, the rule set, the data dictionary, the layer
wiring (``Medallion``) and the end-to-end job (``run_medallion``)."""

from .medallion import Medallion
from .medallion_job import run_medallion

__all__ = ["Medallion", "run_medallion"]
