import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerwatch.operators.cleaning import derive_features  # noqa: E402
from ledgerwatch.schema import FACT  # noqa: E402
from ledgerwatch.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=4)


@pytest.fixture(scope="session")
def make_fact(spark):
    """Fact rows from short dicts; everything left out gets a harmless default."""
    names = [f for f in FACT.fieldNames() if f not in ("transaction_hour", "transaction_day", "balance_change", "amount_to_balance_ratio")]
    schema = type(FACT)([f for f in FACT.fields if f.name in names])

    def build(rows):
        out = []
        for i, r in enumerate(rows, 1):
            full = dict(
                transaction_id=i, step=0, transaction_type="PAYMENT", amount=1, customer_id="C1", old_balance_orig=0, new_balance_orig=0,
                recipient_id="M1", old_balance_dest=0, new_balance_dest=0, is_fraud=0, is_flagged_fraud=0,
            )
            full.update(r)
            for money in ("amount", "old_balance_orig", "new_balance_orig", "old_balance_dest", "new_balance_dest"):
                if full[money] is not None:
                    full[money] = Decimal(str(full[money]))
            out.append(tuple(full[n] for n in names))
        return derive_features(spark.createDataFrame(out, schema)).select(FACT.fieldNames())

    return build


@pytest.fixture(scope="session")
def small_fact(spark):
    from ledgerwatch.plans.registry import loaded_fact

    return loaded_fact(spark, SMALL)


@pytest.fixture
def as_of():
    return dt.datetime(2024, 3, 1, 12, 0, 0)
