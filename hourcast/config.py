"""Fixed values of the forecasting engine.

Everything in this module is a *fixed value*: names, lists and thresholds that
must equal the published pipeline's for results to match (feature lists,
horizons, split ratios, AQI breakpoints and labels). Logic lives elsewhere.
"""
from __future__ import annotations

# --- fixed values: series keys, target, horizons -----------------------------
KEY = "station_id"
TIME = "datetime"
TARGET = "pm2_5"
HORIZONS = [1, 24, 48, 72]
LOCAL_TZ = "Asia/Ho_Chi_Minh"

# --- fixed values: measures of the merged hourly table -----------------------
AQ_COLUMNS = ["pm2_5", "pm10"]
WEATHER_COLUMNS = [
    "temperature_2m",
    "relative_humidity_2m",
    "wind_speed_10m",
    "pressure_msl",
    "precipitation",
]
MEASURES = AQ_COLUMNS + WEATHER_COLUMNS
# columns whose values outside [0, 1000] are nulled (when present)
POLLUTION_COLUMNS = ["pm2_5", "pm10", "co", "no2", "so2", "ozone", "value", "us_aqi"]
OUTLIER_LOW = 0.0
OUTLIER_HIGH = 1000.0
INTERPOLATION_LIMIT = 3

# --- fixed values: feature engineering ---------------------------------------
LAGS = [1, 2, 3, 6, 12, 24, 48, 168]
ROLL_MEANS = [6, 24, 72]
ROLL_STD = 24
ROLL_MAX = 24
DIFFS = [1, 24]
WINTER_MONTHS = [11, 12, 1, 2]
SUMMER_MONTHS = [6, 7, 8]
RATIO_EPS = 1e-6
WINDOW_LAGS = 168

HISTORICAL_FEATURES = [
    "pm2_5_missing_flag",
    "pm2_5",
    "pm10",
    "pm2_5_lag_1",
    "pm2_5_lag_2",
    "pm2_5_lag_3",
    "pm2_5_lag_6",
    "pm2_5_lag_12",
    "pm2_5_lag_24",
    "pm2_5_lag_48",
    "pm2_5_lag_168",
    "pm2_5_roll6_mean",
    "pm2_5_roll24_mean",
    "pm2_5_roll72_mean",
    "pm2_5_roll24_std",
    "pm2_5_roll24_max",
    "hour_sin",
    "hour_cos",
    "dow_sin",
    "dow_cos",
    "month_sin",
    "month_cos",
    "is_weekend",
    "pm2_5_diff_1h",
    "pm2_5_diff_24h",
    "is_winter",
    "is_summer",
    "season",
    "pm25_pm10_ratio",
]
WEATHER_FEATURES = list(WEATHER_COLUMNS)
FEATURES = HISTORICAL_FEATURES + WEATHER_FEATURES

# --- fixed values: splits and folds ------------------------------------------
TRAIN_RATIO = 0.7
VALID_RATIO = 0.1
TEST_RATIO = 0.2
CV_N_SPLITS = 5
RANDOM_SEED = 42
FORECAST_MODES = ["operational", "oracle_weather"]

# --- fixed values: model selection -------------------------------------------
CHAMPION_TOLERANCE = 1.01
DEPLOYABLE_GROUPS = ["tabular_linear", "tabular_tree", "tabular_boosting", "tabular_foundation"]
GROUP_ORDER = {
    "corrected_baseline": 0,
    "statistical": 1,
    "tabular_linear": 2,
    "tabular_tree": 3,
    "tabular_boosting": 4,
    "tabular_foundation": 5,
    "sequential_window": 6,
    "neuralforecast": 7,
}
UNKNOWN_GROUP_ORDER = 99

# --- fixed values: staleness / incremental state -----------------------------
STALE_AFTER_HOURS = 6
DEFAULT_WATERMARK = "2024-01-01T00:00:00"
CHUNK_DAYS = 30

# --- fixed values: US EPA PM2.5 -> AQI breakpoints ---------------------------
# (concentration low, concentration high, index low, index high)
PM25_BREAKPOINTS = [
    (0.0, 12.0, 0, 50),
    (12.1, 35.4, 51, 100),
    (35.5, 55.4, 101, 150),
    (55.5, 150.4, 151, 200),
    (150.5, 250.4, 201, 300),
    (250.5, 350.4, 301, 400),
    (350.5, 500.4, 401, 500),
]
# (upper AQI of the level, label, colour)
AQI_LEVELS = [
    (50, "Good", "#00E400"),
    (100, "Moderate", "#FFFF00"),
    (150, "Unhealthy for Sensitive", "#FF7E00"),
    (200, "Unhealthy", "#FF0000"),
    (300, "Very Unhealthy", "#8F3F97"),
    (500, "Hazardous", "#7E0023"),
]
AQI_BREAKPOINTS = [0, 50, 100, 150, 200, 300, 500]
AQI_LEVELS_US = [
    "Good",
    "Moderate",
    "Unhealthy for Sensitive Groups",
    "Unhealthy",
    "Very Unhealthy",
    "Hazardous",
]
AQI_LEVELS_VN = ["Tốt", "Trung bình", "Kém", "Xấu", "Rất xấu", "Nguy hại"]
AQI_COLORS = ["#00e400", "#ffff00", "#ff7e00", "#ff0000", "#8f3f97", "#7e0023"]
UNHEALTHY_LEVELS = ["Unhealthy for Sensitive", "Unhealthy", "Very Unhealthy", "Hazardous"]
# level -> health advice shown next to a forecast
AQI_ADVICE = {
    "Good": "Chất lượng không khí tuyệt vời và an toàn cho mọi người. Bạn nên tham gia các hoạt động thể dục thể thao ngoài trời.",
    "Moderate": "Chất lượng không khí ở mức chấp nhận được. Tuy nhiên, người cực kỳ nhạy cảm với ô nhiễm (hen suyễn, hô hấp yếu) nên hạn chế hoạt động ngoài trời kéo dài nếu cảm thấy mệt mỏi.",
    "Unhealthy for Sensitive": "Nhóm nhạy cảm (trẻ em, người già, phụ nữ mang thai và người có bệnh tim mạch/hô hấp) nên hạn chế hoạt động mạnh ngoài trời kéo dài. Nên đeo khẩu trang lọc bụi khi đi ra đường.",
    "Unhealthy": "Mức độ ô nhiễm có hại cho sức khỏe cộng đồng. Tất cả mọi người nên hạn chế hoạt động thể lực ngoài trời quá lâu. Bắt buộc đeo khẩu trang N95 khi di chuyển bên ngoài.",
    "Very Unhealthy": "Cảnh báo nghiêm trọng về sức khỏe. Tất cả mọi người nên tránh hoạt động ngoài trời hoàn toàn. Đóng các cửa sổ trong phòng và sử dụng máy lọc không khí trong nhà.",
    "Hazardous": "Tình trạng khẩn cấp toàn diện. Tránh ra ngoài tuyệt đối. Mọi người nên ở trong nhà kín, bật máy lọc không khí và chuẩn bị các biện pháp y tế hỗ trợ nếu cần thiết.",
}
AQI_ADVICE_DEFAULT = "Không có khuyến nghị cụ thể cho mức này."

# --- fixed values: backtest scenarios and EDA --------------------------------
BACKTEST_HORIZONS = [1, 24, 72]
K5_WINTER = [12, 1, 2]
K5_SUMMER = [6, 7, 8]
SEASONS = {"DJF": [12, 1, 2], "MAM": [3, 4, 5], "JJA": [6, 7, 8], "SON": [9, 10, 11]}
EDA_THRESHOLDS = [35.5, 55.5]
ACF_MAX_LAG = 72
DECOMPOSE_PERIOD = 24
TAIL_ROWS = 200
SHAP_MAX_SAMPLES = 1000
TOP_N_FEATURES = 15
PERMUTATION_REPEATS = 10
NOWCAST_VALIDATION_HOURS = 72

# --- fixed values: models the published run leaves out, and its reasons -------
_NO_NEURAL = "neuralforecast>=3.1.0/torch stack is not installed, not compatible with this Python env, or not requested for this run"
SKIPPED_MODELS = [
    ("CatBoost", "catboost is not installed or optional models disabled"),
    ("TabPFNRegressor_v2", "tabpfn is not installed or optional models disabled"),
    ("DLinear", _NO_NEURAL),
    ("NLinear", _NO_NEURAL),
    ("LSTM", _NO_NEURAL),
    ("GRU", _NO_NEURAL),
    ("TCN", _NO_NEURAL),
    ("NHITS", _NO_NEURAL),
    ("NBEATSx", _NO_NEURAL),
    ("TFT", _NO_NEURAL),
]

# --- fixed values: published sizes of the tree models, and the defaults of their trainers -----
TREE_PRESETS = {
    "RandomForest": dict(trees=300, depth=12, min_leaf=2, bootstrap=True, parts=4),
    "ExtraTrees": dict(trees=300, depth=12, min_leaf=2, random_cuts=True, parts=4),
    "XGBoost": dict(trees=500, depth=6, rate=0.03, rows=0.8, columns=0.8, l2=1.0, min_leaf=1),
    "LightGBM": dict(trees=500, depth=6, rate=0.03, columns=0.8, growth="leaf", leaves=31, min_leaf=20),
    "CatBoost": dict(trees=500, depth=6, rate=0.03, l2=3.0, growth="oblivious"),
}
ELASTIC_NET_MAX_ITER = 10_000
