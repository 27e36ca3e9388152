"""No query bears the name of a reference operator that the README lists as not covered."""

from __future__ import annotations

from pairloom.plans.catalog import QUERIES


def test_the_pixel_loss_has_its_own_name():
    assert "ContextualLoss" not in QUERIES and "PixelContextualLoss" in QUERIES
