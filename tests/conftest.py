from __future__ import annotations

import pytest

from tests.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session()


@pytest.fixture
def debit(spark):
    """Make labelled debits from (customer, date, amount, category[, merchant]) rows."""

    def make(*rows):
        full = [(*row, "shop")[:5] for row in rows]
        return spark.createDataFrame(
            full,
            "customer_id int, txn_date string, amount double, category string, merchant string",
        ).selectExpr(
            "customer_id", "cast(txn_date AS date) AS txn_date", "amount", "'debit' AS txn_type",
            "merchant", "'pos' AS channel", "5000 AS mcc_code", "category",
        )

    return make
