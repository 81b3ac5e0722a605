from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from helpers import at, day  # noqa: E402
from shopmart.session import build_session  # noqa: E402
from shopmart.sources.bronze import SCHEMAS, Bronze  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(folder / "shared"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


class Shop:
    """A few hand-made raw rows; `bronze()` gives the tables."""

    def __init__(self, spark):
        self.spark = spark
        self.rows = {name: [] for name in SCHEMAS}

    def order(self, oid, bought, person="u1", state="SP", status="delivered", city="sao paulo", **dates):
        arrived = dates.get("arrived", at(bought).replace(hour=12) if status == "delivered" else None)
        promised = dates.get("promised", day("2018-12-31"))
        self.rows["orders"].append(
            (oid, f"c-{oid}", status, at(bought), dates.get("approved"), dates.get("shipped"), arrived, promised)
        )
        self.rows["customers"].append((f"c-{oid}", person, 1000, city, state))
        return self

    def item(self, oid, number, price, product="p1", seller="s1", freight=0.0):
        self.rows["order_items"].append((oid, number, product, seller, at("2018-01-01"), price, freight))
        return self

    def payment(self, oid, number, value, kind="credit_card", installments=1):
        self.rows["order_payments"].append((oid, number, kind, installments, value))
        return self

    def review(self, rid, oid, score, created, answered="1/9/2018 1:05"):
        self.rows["order_reviews"].append((rid, oid, score, None, None, created, answered))
        return self

    def product(self, pid, category):
        self.rows["products"].append((pid, category, 1, 1, 1, 1, 1, 1, 1))
        return self

    def seller(self, sid, state="SP", city="mogi-guacu"):
        self.rows["sellers"].append((sid, 2000, city, state))
        return self

    def translation(self, name, english):
        self.rows["product_category_name_translation"].append((name, english))
        return self

    def bronze(self) -> Bronze:
        return Bronze.from_tables(
            {name: self.spark.createDataFrame(rows, SCHEMAS[name]) for name, rows in self.rows.items()}
        )


@pytest.fixture
def shop(spark):
    return Shop(spark).product("p1", "toys").product("p2", "health_beauty").seller("s1").seller("s2", "RJ")
