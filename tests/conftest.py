import json
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("recordlake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def lines(spark):
    """Bodies or raw lines to a DataFrame (i, value)."""

    def build(values):
        texts = [v if isinstance(v, str) else json.dumps(v, ensure_ascii=False) for v in values]
        return spark.createDataFrame(list(enumerate(texts)), "i int, value string")

    return build


FULL_RECORD = {
    "accountBfoId": "K-77", "id": 9081, "idGroup": "north", "country": "Norge",
    "companyName": "Fjord Elektro AS", "address1": "Kaigata 12", "address2": None,
    "zipCode": "0150", "city": "Oslo", "webSite": "https://fjord.example", "webSite2": None,
    "countryId": "NO", "latitude": 59.9139, "longitude": 10.7522,
    "administrativeRegion": "Viken", "stateId": None, "emailExists": False, "phoneExists": True,
    "openingHoursType": "weekdays", "eshop": True, "productCount": 3, "logoUrl": None,
    "partnerDetails": {
        "about": "Switchgear since 1981",
        "firstName": "Kari", "lastName": "Nordmann",
        "partnerContact": {"phone": "+47 22 00 00 00", "email": "post@fjord.example"},
        "descriptions": [
            {"isDefault": False, "description": "Short text"},
            {"isDefault": True, "description": "Panels and drives"},
            {"isDefault": True, "description": "Never shown"},
        ],
    },
    "businessType": [
        {"name": "Panel builder", "code": "PB"},
        {"name": "Wholesale", "code": "WS"},
        {"name": "Service", "code": None},
    ],
    "programLevels": [
        {"globalProgramLevelId": "TIER2", "displayRank": 4, "b2cAvailable": False,
         "logoUrl": "https://fjord.example/t2.svg"},
        {"globalProgramLevelId": "TIER3", "displayRank": 5},
    ],
    "competence": [], "areaOfFocus": [], "openingHours": [], "customReference": [],
    "preferredMarketServe": [],
}


@pytest.fixture(scope="session")
def full_record():
    return FULL_RECORD
