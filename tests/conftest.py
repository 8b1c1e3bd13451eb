import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from helpers import frame  # noqa: E402

from tallyframe.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Scratch tables of a session go where pytest keeps, and later removes, its own folders.
    scratch = tmp_path_factory.mktemp("scratch")
    session = build_session(
        "tallyframe-tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": f"file://{scratch}",
            "spark.sql.warehouse.dir": f"file://{scratch}/warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def star(spark):
    """Hand-made dimensions: customers 1 to 3 (the third without a last name), stores, sellers."""
    customer = frame(
        spark,
        [
            (1, "Pavo", "K", "Delhi", "110001", "91-1"),
            (2, "Orla", "S", "Agra", "282001", "91-2"),
            (3, "Quill", None, "Pune", "411001", "91-3"),
        ],
        "customer_id long, first_name string, last_name string, address string, pincode string, phone_number string",
    )
    store = frame(
        spark,
        [(121, "Main road", "110001", "Anil"), (122, "Mall", "110002", "Bina")],
        "id long, address string, store_pincode string, store_manager_name string",
    )
    team = frame(
        spark,
        [(i, f"Seller{i}", f"N{i}", 10, "N", "Delhi", "1100", None) for i in range(1, 5)],
        "id long, first_name string, last_name string, manager_id int, is_manager string, "
        "address string, pincode string, joining_date date",
    )
    return customer, store, team
