"""Figures for the derived inputs published with the blueprint (sf0.001)."""

import pytest

from tessera import set_similarity_join
from tessera.sources import tables as V

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("t,pairs", [(0.85, 31), (0.5, 346)])
def test_sets_orders_pairs(spark, t, pairs):
    assert set_similarity_join(V.sets_orders(spark, SF), t, ordered=False).count() == pairs


@pytest.mark.parametrize("t,pairs", [(0.85, 25), (0.5, 27)])
def test_sets_docs_pairs(spark, t, pairs):
    assert set_similarity_join(V.sets_docs(spark, SF), t, ordered=False).count() == pairs


def test_lines_docs(spark):
    assert V.lines_docs(spark, SF).count() == 1829
