"""Fixed values of the data contract.

Column names, types, labels, bin edges, field maps and limits below must equal
what existing listing lakes store, so they are written out as plain data in
their natural order.  Everything else in the package takes them as parameter
defaults.
"""

# --- silver contract: column -> Spark SQL type, in storage order -------------
SILVER_COLUMNS = {
    "vin": "string", "listing_id": "string", "stock_number": "string",
    "vehicle_condition": "string",
    "year": "bigint", "make": "string", "model": "string", "trim": "string",
    "sub_trim": "string", "bodytype": "string", "engine": "string",
    "displacement": "string", "drivetype": "string", "transmission": "string",
    "fuel": "string", "exterior_color": "string", "interior_color": "string",
    "bed_length": "string", "cab_type": "string", "mileage": "bigint",
    "list_price": "double", "current_price": "double", "one_price": "double",
    "monthly_price": "double", "monthly_down_pct": "double",
    "monthly_interest_rate": "double", "monthly_term_months": "bigint",
    "monthly_loan_amount": "double", "monthly_down_amount": "double",
    "monthly_payment": "double",
    "mpg_city": "double", "mpg_highway": "double", "mpg_combined": "double",
    "accident_history": "string", "owner_history": "string",
    "service_history": "string", "service_records": "bigint",
    "vehicle_use_history": "string", "record_type": "string",
    "dealer_carfax_id": "string", "dealer_name": "string",
    "dealer_address": "string", "dealer_city": "string",
    "dealer_state": "string", "dealer_zip": "string", "dealer_phone": "string",
    "dealer_latitude": "double", "dealer_longitude": "double",
    "dealer_avg_rating": "double", "dealer_review_count": "bigint",
    "dealer_type": "string", "dealer_inventory_url": "string",
    "image_count": "bigint", "follow_count": "bigint",
    "distance_to_dealer": "double", "tp_retention_score": "double",
    "chiclet_badge": "string", "vdp_url": "string",
    "top_options": "string", "images": "string", "one_price_arrows": "string",
    "first_seen": "string",
    "_source_system": "string", "_source_file": "string",
    "_ingestion_ts": "string", "_processing_ts": "string",
    "_pipeline_run_id": "string",
}
REJECTION_COLUMN = "_rejection_reason"
BUSINESS_KEY = "vin"
SOURCE_SYSTEM = "carfax"

# --- raw (bronze) record -----------------------------------------------------
RAW_SCALARS = [
    "vin", "id", "stockNumber", "vehicleCondition", "year", "make", "model",
    "trim", "subTrim", "bodytype", "engine", "displacement", "drivetype",
    "transmission", "fuel", "exteriorColor", "interiorColor", "bedLength",
    "cabType", "mileage", "listPrice", "currentPrice", "onePrice", "mpgCity",
    "mpgHighway", "mpgCombined", "accidentHistory", "ownerHistory",
    "serviceHistory", "serviceRecords", "vehicleUseHistory", "recordType",
    "imageCount", "followCount", "distanceToDealer", "tpRetentionScore",
    "chicletBadge", "vdpUrl", "topOptions", "images", "onePriceArrows",
    "firstSeen",
]
DEALER_FIELDS = {
    "carfaxId": "dealer_carfax_id", "name": "dealer_name",
    "address": "dealer_address", "city": "dealer_city",
    "state": "dealer_state", "zip": "dealer_zip", "phone": "dealer_phone",
    "latitude": "dealer_latitude", "longitude": "dealer_longitude",
    "dealerAverageRating": "dealer_avg_rating",
    "dealerReviewCount": "dealer_review_count", "dealerType": "dealer_type",
    "dealerInventoryUrl": "dealer_inventory_url",
}
MONTHLY_FIELDS = {
    "price": "monthly_price", "downPaymentPercent": "monthly_down_pct",
    "interestRate": "monthly_interest_rate",
    "termInMonths": "monthly_term_months", "loanAmount": "monthly_loan_amount",
    "downPaymentAmount": "monthly_down_amount",
    "monthlyPayment": "monthly_payment",
}
RAW_STRUCTS = {"dealer": DEALER_FIELDS, "monthlyPaymentEstimate": MONTHLY_FIELDS}
RAW_RENAMES = {"id": "listing_id"}
RAW_UNWANTED = [
    "atomMake", "atomModel", "atomTrim", "atomTopOptions", "atomOtherOptions",
    "mediaScores", "baseScore", "sortScore", "sortTPScore", "showHbvChange",
    "advantage", "dealerBadgingExperience",
]

# --- silver rules ------------------------------------------------------------
SILVER_UPPER_TRIMMED = [
    "make", "model", "trim", "sub_trim", "exterior_color", "interior_color",
    "bodytype", "fuel", "drivetype", "transmission", "dealer_state",
    "dealer_city",
]
YEAR_RANGE = (1900, 2030)

# --- gold rules --------------------------------------------------------------
CURRENT_YEAR = 2026
FIRST_MODEL_YEAR = 1980
MAX_CURVE_AGE = 25
GOLD_UPPER_TRIMMED = [
    "make", "model", "trim", "bodytype", "fuel", "vehicle_condition",
    "dealer_type", "drivetype", "transmission", "exterior_color",
]
NULL_TEXT = "<NA>"
PRICE_EDGES = [0, 10_000, 20_000, 35_000, 60_000, 100_000]
PRICE_LABELS = ["Budget", "Economy", "Mid-Range", "Premium", "Luxury", "Ultra-Luxury"]
MILEAGE_EDGES = [0, 20_000, 50_000, 100_000, 150_000]
MILEAGE_LABELS = ["Very Low (<20k)", "Low (20-50k)", "Mid (50-100k)",
                  "High (100-150k)", "Very High (150k+)"]
TIER_EDGES = [0, 10, 50, 150]
TIER_LABELS = ["Small (<10)", "Mid (10-50)", "Large (50-150)", "Super (150+)"]
MARKET_BAND = (0.90, 1.10)
MARKET_LABELS = ("Below Market", "Above Market", "At Market")
ENRICHED_DROPS = [
    "accident_history", "owner_history", "service_history",
    "vehicle_use_history", "one_price_arrows", "images", "_source_system",
    "_source_file", "_ingestion_ts", "_processing_ts", "_pipeline_run_id",
    "top_options",
]
DEALER_KEYS = [
    "dealer_carfax_id", "dealer_name", "dealer_city", "dealer_state",
    "dealer_type", "dealer_avg_rating", "dealer_review_count",
]
MARKET_KEYS = ["make", "model", "year", "bodytype"]
# weight and full-scale value of the listing quality score's parts
QUALITY_WEIGHTS = {"age": 0.25, "miles": 0.35, "accident": 0.25, "service": 0.15}
QUALITY_SCALES = {"age": 20, "miles": 200_000, "service": 20}

# --- profiles and reports ----------------------------------------------------
CATEGORY_FIELDS = [
    "make", "model", "bodytype", "fuel", "drivetype", "transmission",
    "vehicle_condition", "dealer_state", "accident_history", "owner_history",
]
NULL_LABEL = "<null>"
PREVIEW_CHARS = 120

# --- storage and work list ---------------------------------------------------
PART_BYTES = 512 * 1024 * 1024
QUARANTINE_DIR = "_quarantine"
META_DIR = "_meta"
GRID_FIRST_YEAR = 1982
GRID_LAST_YEAR = 2026
GRID_BATCH_YEAR_END = 2010
