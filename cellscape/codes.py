"""Closed vocabularies. Results carry them."""

NO_ERROR, NULL_VALUE, OUT_OF_RANGE, UNSUPPORTED_TYPE, CANNOT_PARSE, NO_MNO_INFO, NO_LOCATION_INFO, DUPLICATED = range(8)
INITIAL_ROWS, FINAL_ROWS = 100, 101
CELL_UNKNOWN, CELL_NOT_VALID, INCORRECT_LOCATION, SUSPICIOUS_LOCATION, DIFFERENT_LOCATION_DUPLICATE = 1, 2, 3, 4, 5
SEMANTIC_CODES = (0, 1, 2, 3, 4, 5)
STAY, MOVE, UNDETERMINED, UNKNOWN, ABROAD = 1, 2, 3, 4, 5
UNKNOWN_CELL = "-99"
OBSERVATION_GRID = -1
ID_UNKNOWN, ID_OBSERVATION, ID_GRID, ID_ABROAD = "unknown", "device_observation", "grid", "abroad"
DOMESTIC, INBOUND, OUTBOUND = "domestic", "inbound", "outbound"
WEEKDAYS = ("mondays", "tuesdays", "wednesdays", "thursdays", "fridays", "saturdays", "sundays")
DAY_TYPES = ("all", "workdays", "holidays", "weekends", *WEEKDAYS)
TIME_INTERVALS = ("all", "night_time", "working_hours", "evening_time")
SEASONS = ("all", "winter", "spring", "summer", "autumn")
INSPIRE_100M, INSPIRE_1KM, ABROAD_ZONING = "INSPIRE_100m", "INSPIRE_1km", "ABROAD"
