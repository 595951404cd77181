"""Batch analytics over taxi trips, as plain Spark DataFrame code."""

from tripmill.plans.marts import finance, mart_sums, marts_from_sums, routes, traffic_dynamics
from tripmill.plans.runs import build_marts, run_elt, run_etl
from tripmill.plans.staging import stage_trips
from tripmill.scenario import SCENARIOS, Scenario
from tripmill.sources.trips import load_trips, read_trips, trips_table
from tripmill.sources.zones import chicago_zones, read_zones

__all__ = [
    "SCENARIOS",
    "Scenario",
    "build_marts",
    "chicago_zones",
    "finance",
    "load_trips",
    "mart_sums",
    "marts_from_sums",
    "read_trips",
    "read_zones",
    "routes",
    "run_elt",
    "run_etl",
    "stage_trips",
    "traffic_dynamics",
    "trips_table",
]
