"""Batch plans: sources, operators and sinks composed per dataset."""

from armorica.plans.conversion import convert_tree, convert_yearly
from armorica.plans.elections import score_elections
from armorica.plans.everything import run_all
from armorica.plans.indicators import average_poverty, average_social_index, pivot_crime, share_diplomas
from armorica.plans.warehouse import (
    check_warehouse,
    export_facts,
    load_dimensions,
    load_facts,
    metric_tables,
    publish,
    unplaced_regions,
)

__all__ = [
    "average_poverty",
    "average_social_index",
    "check_warehouse",
    "convert_tree",
    "convert_yearly",
    "export_facts",
    "load_dimensions",
    "load_facts",
    "metric_tables",
    "pivot_crime",
    "publish",
    "run_all",
    "score_elections",
    "share_diplomas",
    "unplaced_regions",
]
