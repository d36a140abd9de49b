"""Column names that are recognised.

Fixed values: these lists and their order must be as they are for right results.
"""

# Hourly feature building.
HOURLY_TIMES = ["date_heure", "Date_Heure", "Date", "DATE", "date"]
HOURLY_VALUES = ["valeur", "Valeur", "concentration", "Concentration"]
HOURLY_COLUMNS = ["datetime", "station_id", "station_name", "pollutant", "value"]

# Daily feature building.
DAILY_TIMES = [
    "datetime",
    "date",
    "Date",
    "DATE",
    "date_heure",
    "Date_Heure",
    "jour",
    "Jour",
    "JOUR",
]
DAILY_VALUES = [
    "value",
    "iqa",
    "IQA",
    "indice",
    "Indice",
    "iqa_value",
    "valeur_iqa",
    "Valeur",
    "valeur",
]
DAILY_VALUE_PATTERN = r"(iqa|indice)"

STATION_KEYS = [
    "station_name",
    "station",
    "nom_station",
    "Nom_station",
    "Station",
    "NomStation",
    "station_id",
    "code_station",
    "Code_Station",
    "no_station",
    "No_Station",
]
SINGLE_SERIES = ("_series_id", "ALL")

# Training table.
TRAINING_TIMES = ["date", "timestamp", "Date"]
TRAINING_VALUES = ["iqa", "Indice", "aqi", "valeur"]

# Daily table to forecast from.
FORECAST_DAILY_TIMES = ["datetime", "date", "timestamp"]
FORECAST_DAILY_VALUES = ["value", "iqa", "Indice", "aqi", "valeur"]
FORECAST_DAILY_VALUE_PARTS = ["iqa", "indice", "value", "valeur", "aqi"]

# Hourly table to forecast from.
FORECAST_HOURLY_TIMES = ["datetime", "date_time", "timestamp"]
FORECAST_STATIONS = [
    "station_name",
    "station",
    "nom_station",
    "id_station",
    "station_id",
    "code_station",
]
FORECAST_HOURLY_VALUES = ["value", "valeur", "concentration", "result", "measurement"]
FORECAST_HOURLY_VALUE_PARTS = ["value", "val", "conc", "result", "measure"]
TIME_PARTS = ["date", "time"]
STATION_PARTS = ["station"]
NEVER_MEASURES = [
    "no_poste",
    "poste",
    "site",
    "station",
    "nom_station",
    "id_station",
    "station_id",
    "code_station",
]

# Predictions to monitor.
FORECAST_NAMES = ["forecast", "pred", "prediction", "yhat"]

# Scoring requests.
NEVER_FEATURES = ["datetime", "pollutant"]
