import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from weeklens.session import get_spark
    s = get_spark("local[4]", 8, extra={"spark.driver.memory": "4g"})
    yield s


def ts(y, m, d):
    return dt.datetime(y, m, d)


TX_SCHEMA = "order_id long, customer_id long, product_id long, purchase_date timestamp"
CUST_SCHEMA = ("customer_id long, customer_type string, region_id int, zone_id int, Y double, "
               "X double, num_deliver_per_week int, num_visit_per_week int")
PROD_SCHEMA = ("product_id long, brand string, category string, sub_category string, "
               "segment string, package string, size double")
