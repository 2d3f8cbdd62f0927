import os
import tempfile

import pytest
from pyspark.sql import SparkSession

from payments_lake.schema import RAW_COLUMNS
from payments_lake.session import configure

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "America/Los_Angeles")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="/tmp/run-")


ROW = {
    "Fiscal Year": "2019",
    "Related Govt Units": "NO",
    "Organization Group Code": "2",
    "Organization Group": "Public Works",
    "Department Code": "PUC",
    "Department": "PUC Utilities",
    "Program Code": "OPR",
    "Program": "Operating",
    "Character Code": "MTL_SUPP",
    "Character": "Materials & Supplies",
    "Object Code": "BLDG",
    "Object": "Building Supplies",
    "Sub-object Code": "542990",
    "Sub-object": "Other",
    "Fund Type Code": "ENT",
    "Fund Type": "Enterprise Funds",
    "Fund Code": "ENT~OP",
    "Fund": "Operating Fund",
    "Fund Category Code": "2",
    "Fund Category": "Annual",
    "Purchase Order": "0001",
    "Supplier & Other Non-Supplier Payees": "GRAINGER",
    "Vouchers Paid": "2,890.00",
    "Vouchers Pending": "0.0",
    "Encumbrance Balance": "0.0",
    "Vouchers Pending Retainage": "0.0",
    "data_as_of": "2019/06/26 02:32:12 PM",
    "data_loaded_at": "2026/05/25 03:01:24 AM",
    "Non-Profit Indicator": None,
    "Contract Number": "1000001664.0",
    "Contract Title": "Industrial Supplies",
    "Purchase Order Date": "2018/08/07",
    "Purchasing Authority Description": "Term Contract",
}


@pytest.fixture
def ledger(spark):
    """Build a raw frame from rows that differ from a standard row in the given cells."""

    def build(*changes):
        rows = [tuple({**ROW, **change}[c] for c in RAW_COLUMNS) for change in changes]
        return spark.createDataFrame(
            rows, ", ".join(f"`{c}` string" for c in RAW_COLUMNS)
        )

    return build
