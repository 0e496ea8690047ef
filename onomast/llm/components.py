"""Components of links between documents: the library's own rounds (``onomast.operators.links``), some or all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from onomast.llm.common import stored
from onomast.operators.links import components, edges_of, one_round

__all__ = ["components", "shortened"]


def shortened(pairs: DataFrame, a: str, b: str, rounds: int = 2) -> DataFrame:
    """Edges (u, v) with the components of the given ones after some rounds, as a stored table: most nodes lead to their root."""
    now = stored(edges_of(pairs, a, b), "edges")
    for _ in range(rounds):
        now = one_round(now)
    return now
