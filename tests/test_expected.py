"""Known figures of the test tables, for the clean and the dirty adapter."""

from __future__ import annotations

import os

import pytest
from frames import bad_rows
from pyspark.sql import functions as F

from punctual import registry
from punctual.contracts import DIM_SELLER, FACT
from punctual.plans import bi, gates, reports

# Fixed values, computed with another engine: fact rows, on-time rate, mean delivery days,
# mean slack, mean freight, sellers, sellers on the leaderboard, their orders, months,
# calendar days.
FIGURES = {
    ("sf0.001", False): (476, 0.794118, 15.6071, 7.5378, 11008.4618, 10, 9, 458, 80, 2435),
    ("sf0.01", False): (4804, 0.804330, 15.2862, 7.6844, 10802.6643, 100, 61, 4329, 79, 2404),
    ("sf0.1", False): (48257, 0.800630, 15.5163, 7.4744, 10779.8785, 1000, 582, 44348, 80, 2435),
    ("sf0.001", True): (484, 0.196281, 742.6860, -719.5062, 11064.3329, 10, 9, 466, 80, 2435),
    ("sf0.01", True): (4859, 0.223709, 697.3978, -674.4318, 10790.4853, 100, 62, 4400, 79, 2404),
    ("sf0.1", True): (48735, 0.211696, 722.3353, -699.3453, 10779.5694, 1000, 583, 44804, 80, 2435),
}
# bad rows of delivered_before_purchase and implausible_delivery_days, dirty adapter
DIRTY = {"sf0.001": (92, 412), "sf0.01": (1040, 4155), "sf0.1": (9880, 41496)}


@pytest.mark.parametrize("dirty", [False, True])
def test_figures(spark, sf_dir, dirty):
    expected = FIGURES[os.path.basename(sf_dir), dirty]
    warehouse = registry.built(spark, sf_dir, dirty)
    fact, dim = warehouse.read(FACT), warehouse.read(DIM_SELLER)
    head = reports.headline(fact).first()
    board = bi.bi_seller_leaderboard(dim).agg(
        F.count(F.lit(1)).alias("sellers"), F.sum("delivered_orders").alias("orders")
    )
    found = (
        head.delivered_orders,
        head.on_time_rate,
        head.avg_delivery_days,
        head.avg_slack_days,
        float(fact.agg(F.avg("freight_value")).first()[0]),
        dim.count(),
        *board.first(),
        bi.bi_monthly(fact).count(),
        bi.bi_calendar(fact).count(),
    )
    assert found == pytest.approx(expected, abs=6e-5)


def test_dirty_dates_fire_two_checks(spark, sf_dir):
    early, implausible = DIRTY[os.path.basename(sf_dir)]
    assert bad_rows(gates.warehouse_mart_checks(registry.built(spark, sf_dir, dirty=True))) == {
        "delivered_before_purchase": early,
        "implausible_delivery_days": implausible,
    }
