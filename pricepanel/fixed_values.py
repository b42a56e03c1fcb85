"""Names, lookup tables and model settings that results depend on.

These are plain data.  Every function that uses one takes it as an argument, so a
panel with other columns, models or thresholds only passes its own.
"""

# The forecast targets, in table order.
TARGETS = ["oro", "plata", "cobre", "petroleo_brent", "gas_natural"]

# Model labels.  The first two are forecast directly, the other two are derived.
BASE_MODELS = ["sarimax", "autogluon"]
MIXED_MODEL = "model_mixto"
ENSEMBLE_MODEL = "ensamblado"
LOGGED_MODELS = ["sarimax", "autogluon", "model_mixto"]
# Order of the report legend: actuals are 1, unknown models 99.
REPORT_ORDER = {"sarimax": 2, "autogluon": 3, "ensamblado": 4, "model_mixto": 5}
UNKNOWN_REPORT_ORDER = 99
# Stage names of the run log that are not simply the upper-cased label.
STAGE_NAMES = {"sarimax": "SARIMAX", "autogluon": "AUTOGLUON", "model_mixto": "MODELO_MIXTO"}

HORIZON = 10

# Columns of the cleaned panel, in table order (the date column comes last).
PANEL_COLUMNS = [
    "petroleo_brent", "oro", "gas_natural", "cobre", "plata",
    "vix", "sp500", "shanghai", "emergentes", "Nikkei", "DAX", "FTSE",
    "AAPL", "NVDA", "MSFT", "AMZN", "GOOGL", "BRK_B", "JPM", "UNH", "TSM", "AMD",
    "SPY", "QQQ", "DIA",
    "NEM", "KGC", "AEM", "PAAS", "WPM", "AG", "FCX", "SCCO", "BHP", "EQT", "CTRA", "LNG",
    "XOM", "CVX", "SHEL",
    "dolar_index", "tasa_10y", "tasa_2y", "tasa_5y",
    "PIB_USA", "PIB_JPN", "PIB_DEU", "PIB_GBR", "PIB_FRA", "PIB_ITA", "PIB_CAN",
    "DESEMPLEO_USA", "DESEMPLEO_ALE", "DESEMPLEO_FRA", "DESEMPLEO_INGL",
    "DESEMPLEO_JPN", "DESEMPLEO_CAN", "DESEMPLEO_ITA", "DESEMPLEO_MEX",
    "produccion_petroleo_usa", "produccion_gas_usa",
    "DINERO_CIRCULANTE_EEUU_M2_APROX_LCU", "DINERO_CIRCULANTE_CHINA_M2_APROX_LCU",
    "DINERO_CIRCULANTE_JAPON_M2_APROX_LCU", "DINERO_CIRCULANTE_REINO_UNIDO_M2_APROX_LCU",
    "DINERO_CIRCULANTE_CANADA_M2_APROX_LCU", "DINERO_CIRCULANTE_INDIA_M2_APROX_LCU",
    "DINERO_CIRCULANTE_BRASIL_M2_APROX_LCU", "DINERO_CIRCULANTE_MEXICO_M2_APROX_LCU",
]
PANEL_DATE = "Date"
ALTERNATE_NAMES = {"BRK_B": "BRK-B"}
# Quality checks watch markets, shares and rates; macro columns are not watched.
WATCHED_COLUMNS = [
    "petroleo_brent", "oro", "gas_natural", "cobre", "plata", "vix", "sp500", "shanghai", "emergentes",
    "Nikkei", "DAX", "FTSE", "AAPL", "NVDA", "MSFT", "AMZN", "GOOGL", "BRK_B", "JPM", "UNH", "TSM", "AMD",
    "SPY", "QQQ", "DIA", "NEM", "KGC", "AEM", "PAAS", "WPM", "AG", "FCX", "SCCO", "BHP", "EQT", "CTRA", "LNG",
    "XOM", "CVX", "SHEL", "dolar_index", "tasa_10y", "tasa_2y", "tasa_5y",
]

# Ticker -> column, by source group.
TARGET_SYMBOLS = {
    "BZ=F": "petroleo_brent", "GC=F": "oro", "NG=F": "gas_natural", "HG=F": "cobre", "SI=F": "plata",
}
INDEX_SYMBOLS = {
    "^VIX": "vix", "^GSPC": "sp500", "000001.SS": "shanghai", "EEM": "emergentes",
    "^N225": "Nikkei", "^GDAXI": "DAX", "^FTSE": "FTSE", "DX=F": "dxy_fut",
}
SHARE_SYMBOLS = [
    "AAPL", "NVDA", "MSFT", "AMZN", "GOOGL", "BRK-B", "JPM", "UNH", "TSM", "AMD", "SPY", "QQQ", "DIA",
]
PRODUCER_SYMBOLS = [
    "NEM", "KGC", "AEM", "PAAS", "WPM", "AG", "FCX", "SCCO", "BHP", "EQT", "CTRA", "LNG",
    "XOM", "CVX", "SHEL",
]
LOOKBACK_DAYS = 10

# Macro series code -> column.
RATE_CODES = {"DTWEXBGS": "dolar_index", "DGS10": "tasa_10y", "DGS2": "tasa_2y", "DGS5": "tasa_5y"}
GDP_CODES = {
    "GDP": "PIB_USA", "JPNRGDPEXP": "PIB_JPN", "CLVMNACSCAB1GQDE": "PIB_DEU",
    "CLVMNACSCAB1GQUK": "PIB_GBR", "CLVMNACSCAB1GQFR": "PIB_FRA",
    "CLVMNACSCAB1GQIT": "PIB_ITA", "NGDPRSAXDCCAQ": "PIB_CAN",
}
UNEMPLOYMENT_CODES = {
    "UNRATE": "DESEMPLEO_USA", "LRHUTTTTDEM156S": "DESEMPLEO_ALE",
    "LRHUTTTTFRM156S": "DESEMPLEO_FRA", "LRHUTTTTGBM156S": "DESEMPLEO_INGL",
    "LRHUTTTTJPM156S": "DESEMPLEO_JPN", "LRHUTTTTCAM156S": "DESEMPLEO_CAN",
    "LRHUTTTTITM156S": "DESEMPLEO_ITA", "LRHUTTTTMXM156S": "DESEMPLEO_MEX",
}
ENERGY_SERIES = {"PET.WCRFPUS2.W": "produccion_petroleo_usa", "NG.N9070US2.M": "produccion_gas_usa"}
MONEY_COUNTRIES = {
    "USA": "DINERO_CIRCULANTE_EEUU_M2_APROX_LCU",
    "CHN": "DINERO_CIRCULANTE_CHINA_M2_APROX_LCU",
    "JPN": "DINERO_CIRCULANTE_JAPON_M2_APROX_LCU",
    "DEU": "DINERO_CIRCULANTE_ALEMANIA_M2_APROX_LCU",
    "FRA": "DINERO_CIRCULANTE_FRANCIA_M2_APROX_LCU",
    "ITA": "DINERO_CIRCULANTE_ITALIA_M2_APROX_LCU",
    "GBR": "DINERO_CIRCULANTE_REINO_UNIDO_M2_APROX_LCU",
    "CAN": "DINERO_CIRCULANTE_CANADA_M2_APROX_LCU",
    "IND": "DINERO_CIRCULANTE_INDIA_M2_APROX_LCU",
    "BRA": "DINERO_CIRCULANTE_BRASIL_M2_APROX_LCU",
    "MEX": "DINERO_CIRCULANTE_MEXICO_M2_APROX_LCU",
    "WLD": "DINERO_CIRCULANTE_MUNDO_M2_APROX_LCU",
}

# (p, d, q), (P, D, Q, s) and transform of each target's daily model.
MODEL_ORDERS = {
    "oro": ((2, 1, 0), (2, 0, 1, 5), "yeojohnson"),
    "plata": ((1, 1, 2), (1, 0, 1, 5), "yeojohnson"),
    "cobre": ((3, 1, 2), (0, 0, 0, 0), "yeojohnson"),
    "gas_natural": ((1, 1, 0), (0, 0, 0, 0), "yeojohnson"),
    "petroleo_brent": ((1, 1, 2), (0, 0, 1, 5), "yeojohnson"),
}
# Values tried per target in the grid search.
GRID = {
    "oro": {"p": [0], "d": [1], "q": [0], "P": [1, 2], "D": [0], "Q": [1, 2], "s": [5]},
    "plata": {"p": [1], "d": [1], "q": [1, 2], "P": [1, 2], "D": [0], "Q": [0, 1], "s": [5]},
    "cobre": {"p": [2, 3], "d": [1], "q": [1, 2], "P": [0], "D": [0], "Q": [0], "s": [0]},
    "gas_natural": {"p": [0, 1], "d": [1], "q": [0], "P": [0], "D": [0], "Q": [0], "s": [0]},
    "petroleo_brent": {"p": [1], "d": [1], "q": [0, 1, 2], "P": [0], "D": [0], "Q": [0, 1], "s": [5]},
}

# Column names of the published tables, for readers that expect them.
PUBLISHED_FORECAST_NAMES = {
    "forecast_date": "fecha_prediccion", "model": "modelo", "run_date": "data_date_part",
}
PUBLISHED_ERROR_NAMES = {
    "run_date": "data_date_part", "forecast_date": "fecha_prediccion", "model": "modelo",
    "target": "commodity", "previous_actual": "actual_previo", "actual": "actual_real",
    "predicted": "predicted_value", "abs_error": "abs_error", "ape": "ape",
    "predicted_direction": "direccion_predicha", "actual_direction": "direccion_real",
    "direction_hit": "direccion_ok",
}
PUBLISHED_QUALITY_NAMES = {
    "review_date": "fecha_revision", "review_ts": "ts_revision", "table_name": "tabla_monitoreada",
    "metric_group": "metric_group", "metric": "metric_name", "series": "variable",
    "data_date": "data_date", "value": "valor", "threshold": "umbral", "status": "estado",
    "detail": "detalle",
}
PUBLISHED_LOG_NAMES = {
    "run_date": "fecha_ejecucion", "run_ts": "ts_evento", "stage": "etapa", "status": "estado",
    "table_name": "tabla_objetivo", "n_rows": "registros", "min_date": "data_min",
    "max_date": "data_max", "expected_rows": "umbral_esperado", "detail": "detalle",
}
PUBLISHED_REPORT_NAMES = {
    "date": "date", "target": "commodity", "value": "valor", "source": "tipo_dato",
    "source_order": "orden_tipo_dato", "kind": "RESUMEN",
}
