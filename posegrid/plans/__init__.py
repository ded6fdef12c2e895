"""Relational plans: importing this package registers all of them."""

from ..functions import blocks, scenes  # noqa: F401
from ..operators import spatial  # noqa: F401
from . import aggregates, bindings, filters, geometry, joins, questions, templates, text, windows  # noqa: F401
from .registry import PLANS, run, twin


def queries():
    return {name: run(name) for name in PLANS}


def oracle_sql():
    return {name: twin(name) for name in PLANS}
