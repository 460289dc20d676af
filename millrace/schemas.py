"""Column names and types of every input. All names and formats here are fixed values."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

BID_COUNTRIES = ["US", "MX", "CA"]

RAW_BIDS = [
    "MotelID", "BidDate", "HU", "UK", "NL", "US", "MX", "AU", "CA", "CN", "KR", "BE", "I", "JP", "IN",
    "HN", "GY", "DE",
]
EXCHANGE_RATES = ["ValidFrom", "CurrencyName", "CurrencyCode", "ExchangeRate"]
MOTELS = ["MotelID", "MotelName"]

CARRIERS = {"code": "string", "description": "string"}
AIRPORTS = {
    "iata": "string", "airport": "string", "city": "string", "state": "string", "country": "string",
    "lat": "double", "lon": "double",
}
FLIGHTS = {
    "Year": "int", "Month": "int", "DayofMonth": "int", "DayOfWeek": "int",
    "DepTime": "int", "CRSDepTime": "int", "ArrTime": "int", "CRSArrTime": "int",
    "UniqueCarrier": "string", "FlightNum": "int", "TailNum": "string",
    "ActualElapsedTime": "int", "CRSElapsedTime": "int", "AirTime": "int",
    "ArrDelay": "int", "DepDelay": "int", "Origin": "string", "Dest": "string",
    "Distance": "int", "TaxiIn": "int", "TaxiOut": "int",
    "Cancelled": "int", "CancellationCode": "string", "Diverted": "int",
    "CarrierDelay": "int", "WeatherDelay": "int", "NASDelay": "int", "SecurityDelay": "int",
    "LateAircraftDelay": "int",
}

AD_LOGS = {
    "bid_id": "string", "timestamp_": "string", "log_type": "int", "ipinyouid": "string",
    "user_agent": "string", "ip": "string", "region_id": "int", "city_id": "int",
    "ad_exchange": "string", "domain": "string", "url": "string", "anonim_url": "string",
    "ad_slot_id": "string", "ad_slot_width": "int", "ad_slot_heigth": "int",
    "ad_slot_visibility": "string", "ad_slot_format": "string", "ad_slot_floor_price": "int",
    "creative_id": "string", "bidding_price": "int", "pauing_price": "int",
    "landing_page_url": "string", "advertiser_id": "int", "user_profile_ids": "string",
}

WEATHER = {
    "stationid": "string", "date": "date", "tmin": "int", "tmax": "int", "snow": "int", "snwd": "int",
    "prcp": "int",
}

READING_FIELDS = [
    "stateCode", "countryCode", "siteNum", "parameterCode", "poc", "latitude", "longitude", "datum",
    "parameterName", "dateLocal", "timeLocal", "dateGMT", "timeGMT", "sampleMeasurement",
    "unitsOfMeasure", "mdl", "uncertainty", "qualifier", "methodType", "methodCode", "methodName",
    "stateName", "countyName", "dateOfLastChange",
]
SCORE_FIELDS = ["prediction", "error", "anomaly", "predictionNext"]
DEVICE_KEY_FIELDS = READING_FIELDS[:5]

READING_MESSAGE = ", ".join(
    [f"{name} string" for name in READING_FIELDS] + [f"{name} double" for name in SCORE_FIELDS]
)


def strings(names) -> StructType:
    """An all-string schema with the given column names."""
    return StructType([StructField(name, StringType()) for name in names])
