"""Keyword lists, code tables and limits of the open-data feeds.

Everything here must equal the feeds' own vocabulary for results to be right,
so the values are spelled out plainly and kept in their natural order.
"""

# --- column-name keywords (substring match, case-blind) --------------------
DATETIME_KEYS = ["fecha_hora", "fechahora", "datetime", "timestamp"]
DATE_KEYS = ["fecha", "date"]
TIMESTAMP_KEYS_NARROW = DATETIME_KEYS + DATE_KEYS
TIMESTAMP_KEYS_WIDE = TIMESTAMP_KEYS_NARROW + ["hora", "time"]
BUILD_DATE_KEYS = ["fecha", "date", "dia"]
HOUR_KEYS_RANGES = ["hora", "time", "franja", "tramo"]
HOUR_KEYS_ACCIDENTS = ["hora", "time", "tiempo", "h_acc", "acc_hora"]

# exact names, lower case
YEAR_NAMES = ["año", "ano", "year", "anio"]
MONTH_NAMES = ["mes", "month"]
DAY_NAMES = ["dia", "día", "day"]

STREET_KEYS = [
    "calle", "via", "vía", "direccion", "dirección", "ubicacion", "ubicación",
    "localizacion", "localización", "lugar", "punto", "domicilio", "via_publica",
    "carretera", "tramo", "pk", "interseccion", "intersección", "cruce",
    "kilometro", "kilómetro", "street", "road", "address", "addr",
]
PLACE_KEYS = [
    "calle", "vía", "via", "direccion", "dirección", "ubicacion", "ubicación",
    "lugar", "punto", "domicilio", "via_publica", "carretera", "tramo", "cruce",
    "street", "road", "address", "addr", "localizacion", "localización",
    "distrito", "barrio", "municipio", "localidad", "seccion", "sección", "zona",
]
STATION_KEYS = PLACE_KEYS + ["estacion", "estación", "station", "punto_muestreo", "site"]
ROAD_POINT_KEYS = PLACE_KEYS + [
    "pk", "p.k", "punto_km", "kilometro", "kilómetro", "coordenada", "coordenadas",
]
LATITUDE_KEYS = ["latitud", "latitude", "coordenada-y"]
LONGITUDE_KEYS = ["longitud", "longitude", "coordenada-x"]
NAME_KEYS = ["nombre", "denominacion", "title"]
ADDRESS_KEYS = ["direccion", "via", "calle"]
SORT_DATE_NAMES = ["fecha_hora", "FechaHora", "FECHA_HORA", "fecha", "FECHA", "date", "DATE"]

# --- air quality ------------------------------------------------------------
POLLUTANT_CODES = {1: "so2", 6: "co", 7: "no", 8: "no2", 9: "o3", 10: "pm10", 12: "pm25"}
POLLUTANT_UNITS = {
    "so2": "µg/m³", "co": "mg/m³", "no": "µg/m³", "no2": "µg/m³",
    "o3": "µg/m³", "pm10": "µg/m³", "pm25": "µg/m³",
}
# text spellings in priority order: the first one found in a row decides
POLLUTANT_SPELLINGS = [
    ("pm2.5", "pm25"), ("pm 2.5", "pm25"), ("pm 2,5", "pm25"), ("pm25", "pm25"),
    ("pm10", "pm10"), ("pm 10", "pm10"),
    ("ozono", "o3"), ("o3", "o3"),
    ("no2", "no2"), ("dióxido de nitrógeno", "no2"), ("dioxido de nitrogeno", "no2"),
    ("so2", "so2"), ("dióxido de azufre", "so2"), ("dioxido de azufre", "so2"),
    ("co", "co"), ("monoxido de carbono", "co"), ("monóxido de carbono", "co"),
]
POLLUTANT_CODE_COLUMNS = ["MAGNITUD", "magnitud", "cod_magnitud", "codigo_magnitud"]
VALUE_COLUMNS = ["VALOR", "valor", "concentracion", "concentración", "value", "median", "media"]
HOURLY_COLUMN_PATTERNS = ["H{:02d}", "h{:02d}", "hora_{:02d}", "hora{:02d}", "V{:02d}"]
SNAPSHOT_POLLUTANTS = ["pm25", "pm10", "o3", "no2", "so2", "co"]
# spellings on the snapshot page; when two spellings of one pollutant occur the later entry wins
SNAPSHOT_SPELLINGS = [
    ("PM 2.5", "pm25"), ("PM 2,5", "pm25"), ("PM2.5", "pm25"),
    ("PM 10", "pm10"), ("PM10", "pm10"),
    ("O3", "o3"), ("O 3", "o3"),
    ("NO2", "no2"), ("NO 2", "no2"),
    ("SO2", "so2"), ("SO 2", "so2"),
    ("CO", "co"),
]
AQI_BANDS = [
    (0, 50, "Buena"),
    (51, 100, "Moderada"),
    (101, 150, "Perjudicial para grupos sensibles"),
    (151, 200, "Mala"),
    (201, 300, "Muy mala"),
    (301, 500, "Peligrosa"),
]
COMPARISON_COLUMNS = [
    "fecha", "pollutant", "open_value", "open_unit", "acc_value_ugm3", "acc_raw",
    "acc_unit", "aqi", "aqi_category", "delta_ugm3_acc_minus_open",
]
OPEN_AIR_ORIGIN = "DatosAbiertosMadrid"

# --- climate ----------------------------------------------------------------
MONTH_LABELS = {
    "1": "Enero", "2": "Febrero", "3": "Marzo", "4": "Abril", "5": "Mayo", "6": "Junio",
    "7": "Julio", "8": "Agosto", "9": "Septiembre", "10": "Octubre", "11": "Noviembre",
    "12": "Diciembre", "13": "Promedio Anual",
}
# output column -> key in the daily feed
CLIMATE_DAILY_FIELDS = {
    "Fecha": "fecha", "Estacion": "nombre", "Indicativo": "indicativo",
    "Temp_Media_°C": "tmed", "Temp_Max_°C": "tmax", "Temp_Min_°C": "tmin",
    "Hora_Temp_Max": "horatmax", "Hora_Temp_Min": "horatmin", "Precipitacion_mm": "prec",
    "Vel_Viento_Media_m/s": "velmedia", "Racha_Max_m/s": "racha", "Direccion_Racha": "dir",
    "Hora_Racha": "horaracha", "Presion_Max_hPa": "presMax", "Presion_Min_hPa": "presMin",
    "Insolacion_h": "sol",
}
# output column -> key in the monthly feed (year, month and month name are derived)
CLIMATE_MONTHLY_FIELDS = {
    "Temp_Media_°C": "tm_mes", "Temp_Max_Media_°C": "tm_max", "Temp_Min_Media_°C": "tm_min",
    "Temp_Max_Absoluta_°C": "ta_max", "Temp_Min_Absoluta_°C": "ta_min",
    "Humedad_Media_%": "hr", "Precipitacion_Total_mm": "p_mes", "Horas_Sol": "n_sol",
}

# --- links ------------------------------------------------------------------
LINK_EXCLUDED = [
    "wms", "wmts", "ogc", "service", "arcgis", "esri",
    ".zip", ".shp", ".dbf", ".prj", ".kml", ".kmz",
    ".pdf", ".rdf", ".xml", "sparql", "mailto:", "javascript:", "#",
]
LINK_EXCLUDED_WITH_ZIP = [p for p in LINK_EXCLUDED if p != ".zip"]
LINK_HINTS = ["download", "descarg", "csv", "json"]
LINK_HINTS_WITH_ZIP = LINK_HINTS + ["zip"]

# --- result files -----------------------------------------------------------
# path fragment -> dataset label, in priority order
DATASET_LABELS = [
    ("trafico", "trafico_historico"), ("traffic", "trafico_historico"),
    ("vehiculos", "vehiculos_por_distrito"), ("parking", "vehiculos_por_distrito"),
    ("transporte", "transporte_publico"), ("bus", "transporte_publico"),
    ("metro", "transporte_publico"), ("emergenc", "emergencias"), ("clima", "clima"),
    ("aemet", "clima"), ("radar", "radares"), ("camara", "radares"),
    ("calidad_aire", "calidad_aire"), ("accidente", "accidentes"),
]

# --- patterns of cells, paths and headers (fixed values) ----------------------
RANGE_FORM = r"^\s*(\d{1,2}):(\d{2})\s*-\s*(\d{1,2}):(\d{2})\s*$"
HHMM_FORM = r"^\s*(\d{1,2})[:hH]([0-5]?\d)\s*$"
CELL_FORM = r"^(\d{1,2})\s*[:hH]?\s*(\d{1,2})?$"
CSV_PATH = r'(?i)((?:[A-Za-z]:\\|/)?[^\s"<>|]+?\.csv)'
FILENAME = r'(?i)filename\s*=\s*"?([^";]+)"?'

# --- limits and places --------------------------------------------------------
SEPARATORS = [";", ",", "\t", "|"]
MONTHS_BACK_ACCIDENTS = 3
MONTHS_BACK = 2
HOUR_MARGIN_MINUTES = 60
CENTRE_LAT = 40.4168
CENTRE_LON = -3.7038
RADIUS_KM = 1.5
EARTH_RADIUS_KM = 6371.0
DISTANCE_BANDS_KM = [0.5, 1.0, 1.5, 2.0]
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]

TRANSIT_COLUMNS = [
    "tipo_transporte", "trip_id", "route_id", "service_id", "direction_id", "trip_headsign",
    "stop_sequence", "stop_id", "stop_name", "arrival_time", "departure_time",
    "stop_lat", "stop_lon",
]
GTFS_SCHEMAS = {
    "trips": "route_id string, service_id string, trip_id string, trip_headsign string, "
             "direction_id int",
    "calendar": "service_id string, monday int, tuesday int, wednesday int, thursday int, "
                "friday int, saturday int, sunday int, start_date int, end_date int",
    "calendar_dates": "service_id string, date int, exception_type int",
    "stop_times": "trip_id string, arrival_time string, departure_time string, "
                  "stop_id string, stop_sequence int",
    "stops": "stop_id string, stop_name string, stop_lat string, stop_lon string",
}
