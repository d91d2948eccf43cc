"""Monthly sales forecasting and branch plan allocation as Spark DataFrame jobs."""

from salesloom.context import AllocationLevel, PlanContext

__all__ = ["AllocationLevel", "PlanContext"]
