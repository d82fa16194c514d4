"""Whole jobs: preparation, training, comparison, ingestion and reconciliation."""

from prepmill.plans.exploring import Exploration, explore
from prepmill.plans.flights import prepare_flights, train_delay
from prepmill.plans.loans import compare_classifiers, prepare_loans
from prepmill.plans.movement import ingest, ingest_and_train, load_and_reconcile

__all__ = [
    "Exploration",
    "compare_classifiers",
    "explore",
    "ingest",
    "ingest_and_train",
    "load_and_reconcile",
    "prepare_flights",
    "prepare_loans",
    "train_delay",
]
