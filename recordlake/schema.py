"""Column lists and record schema shared by every operator.

The values in this module are fixed: output files, fingerprints and reports are
only comparable between runs when these names, orders and numbers stay as they are.
"""

from __future__ import annotations

# --- fixed values: output columns, left to right -------------------------------
OUTPUT_COLUMNS = [
    "id", "accountBfoId", "idGroup",
    "companyName",
    "address1", "address2", "city", "zipCode", "administrativeRegion", "stateId",
    "country", "countryId",
    "latitude", "longitude",
    "webSite", "webSite2", "logoUrl",
    "contact_email", "contact_phone",
    "firstName", "lastName", "about", "description",
    "emailExists", "phoneExists", "eshop", "openingHoursType", "productCount",
    "businessType_codes", "businessType_names",
    "programLevel_logoUrl", "programLevel_globalId",
    "programLevel_displayRank", "programLevel_b2cAvailable",
    "openingHours", "preferredMarketServe", "competence", "areaOfFocus", "customReference",
]

# --- fixed values: fields copied from the top level of a raw record --------------
SCALAR_FIELDS = [
    "accountBfoId", "id", "idGroup", "country", "companyName",
    "address1", "address2", "zipCode", "city", "webSite", "webSite2", "countryId",
    "latitude", "longitude", "administrativeRegion", "stateId",
    "emailExists", "phoneExists", "openingHoursType", "eshop", "productCount", "logoUrl",
]

# --- fixed values: array fields kept as JSON text --------------------------------
FREE_FORM_FIELDS = [
    "openingHours", "preferredMarketServe", "competence", "areaOfFocus", "customReference",
]

# --- fixed values: output column -> field of the first program level -------------
PROGRAM_LEVEL_FIELDS = {
    "programLevel_logoUrl": "logoUrl",
    "programLevel_globalId": "globalProgramLevelId",
    "programLevel_displayRank": "displayRank",
    "programLevel_b2cAvailable": "b2cAvailable",
}

# --- fixed values: where a response body may hide its record list, in order ------
LIST_KEYS = [
    "items", "results", "data", "partners", "distributors",
    "dealers", "content", "hits", "records", "list",
]

# --- fixed values: any of these keys marks an object as a single record ----------
SINGLE_KEYS = ["id", "companyName", "partnerName", "name"]

# --- fixed values: identity of a record, personal columns, sample columns --------
FINGERPRINT_COLUMNS = ["id", "companyName", "city", "country"]
PII_COLUMNS = ["firstName", "lastName", "contact_email", "contact_phone"]
SAMPLE_COLUMNS = [
    "companyName", "city", "country", "contact_email", "contact_phone", "businessType_names",
]

# --- fixed values: batching and retry schedule -----------------------------------
BATCH_SIZE = 50
CONCURRENCY = 6
MAX_RETRIES = 3
RETRY_BACKOFF = 2.0

# Records are read from typed text (functions/typed.py), where every scalar is a string.
# Lists that may hold anything stay JSON text and are opened in flatten.py.
RECORD_DDL = "struct<{scalars},{details},{types},{levels},{free}>".format(
    scalars=",".join(f"{f}:string" for f in SCALAR_FIELDS),
    details=(
        "partnerDetails:struct<firstName:string,lastName:string,about:string,"
        "partnerContact:struct<email:string,phone:string>,descriptions:string>"
    ),
    types="businessType:string",
    levels="programLevels:array<struct<{}>>".format(
        ",".join(f"{f}:string" for f in PROGRAM_LEVEL_FIELDS.values())
    ),
    free=",".join(f"{f}:string" for f in FREE_FORM_FIELDS),
)
