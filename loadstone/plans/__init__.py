"""The table loads and the runner that puts them in order."""

from loadstone.plans.runner import all_loads, run_loads

__all__ = ["all_loads", "run_loads"]
