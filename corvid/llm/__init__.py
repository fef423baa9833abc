"""Operators for preparing language-model training data.

Each module holds one operator with its general interface; ``queries``
holds the thin registered queries. Nothing outside this package imports it
except the guarded registration in ``__spark_entry__`` and
``corpus_pipeline``.
"""

from __future__ import annotations

import os
import sys


def _ship_code() -> None:
    """Functions that run in tasks are pickled by reference when the workers
    can import this package (it is on ``PYTHONPATH``); otherwise they are
    shipped by value, so that a session started elsewhere still runs them."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    on_path = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in on_path:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules["corvid"])


_ship_code()
