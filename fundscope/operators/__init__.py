"""DataFrame -> DataFrame operators."""

from .credit import credited_dollars, effective_goal, goal_level, role_dollars
from .ranking import first_two, household_label, owner_label, top_n
from .relational import align_union, role_join, unpivot_non_null

__all__ = ["credited_dollars", "effective_goal", "goal_level", "role_dollars", "first_two",
           "household_label", "owner_label", "top_n", "align_union", "role_join",
           "unpivot_non_null"]
