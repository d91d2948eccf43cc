from salesloom.plans.entire import PlanResult, entire_plan
from salesloom.plans.own_brand import own_brand_plan
from salesloom.plans.panels import load_panel

__all__ = ["PlanResult", "entire_plan", "load_panel", "own_brand_plan"]
