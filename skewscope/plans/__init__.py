"""Physical-plan helpers shared by the operators (materialisation, prefix sums)."""

from skewscope.plans.materialize import materialize
from skewscope.plans.prefix import running_totals

__all__ = ["materialize", "running_totals"]
