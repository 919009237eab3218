"""Column roles and fixed values of the daily air-quality model.

Everything here is data: names, units, thresholds and texts. Operators take
what they need as arguments, so a different network of sensors only needs a
different catalog.
"""

from __future__ import annotations

# --- fixed values: series files -------------------------------------------------
# file-name token -> (feature, resolution)
SERIES = {
    "MOD08_D3_6_1_AOD_550": ("AOD_550", "daily"),
    "M2T1NXAER_5_12_4_TOTSMASS25": ("PM2_5", "hourly"),
    "OMNO2d_003_ColumnAmountNO2TropCloudScreened": ("NO2_trop", "daily"),
    "OMNO2d_003_ColumnAmountNO2CloudScreened": ("NO2_total", "daily"),
    "OMSO2e_003_ColumnAmountSO2": ("SO2_column", "daily"),
    "M2T1NXAER_5_12_4_SO2SMASS": ("SO2_surface", "hourly"),
    "OMTO3e_003_ColumnAmountO3": ("O3", "daily"),
    "AIRS3STD_7_0_CO_VMR_A": ("CO", "daily"),
    "M2SDNXSLV_5_12_4_T2MMAX": ("temperature_max", "daily"),
    "M2SDNXSLV_5_12_4_T2MMEAN": ("temperature_mean", "daily"),
    "M2SDNXSLV_5_12_4_T2MMIN": ("temperature_min", "daily"),
    "M2T1NXSLV_5_12_4_TS": ("skin_temperature", "hourly"),
    "M2TMNXSLV_5_12_4_T2MDEW": ("dew_point", "monthly"),
    "M2T1NXSLV_5_12_4_U10M": ("wind_u10m", "hourly"),
    "M2T1NXSLV_5_12_4_V10M": ("wind_v10m", "hourly"),
}
# Tokens that mark a rainfall file; its cadence follows from its time stamps.
PRECIPITATION_TOKENS = ("precipitation", "PRECIP", "PRCP")

RESOLUTION = {feature: resolution for feature, resolution in SERIES.values()}

START_DATE = "2004-10-01"
END_DATE = "2025-09-30"

# Why a series may begin late.
MISSING_REASONS = {
    "NO2_trop": "Vệ tinh OMI bắt đầu hoạt động từ 2004-10-01",
    "NO2_total": "Vệ tinh OMI bắt đầu hoạt động từ 2004-10-01",
    "SO2_column": "Vệ tinh OMI bắt đầu hoạt động từ 2004-10-01",
    "O3": "Vệ tinh OMI bắt đầu hoạt động từ 2004-10-01",
    "CO": "Vệ tinh AIRS bắt đầu hoạt động từ 2002-08-31",
    "AOD_550": "MODIS có thể có missing do mây che phủ",
    "PM2_5": "MERRA-2 reanalysis, có thể có missing do điều kiện thời tiết",
    "SO2_surface": "MERRA-2 reanalysis, có thể có missing",
    "precipitation": "Có thể có missing nếu chưa download",
}

# --- fixed values: column roles -------------------------------------------------
POLLUTANTS = (
    "PM2_5", "PM10", "NO2_trop", "NO2_total", "SO2_column",
    "SO2_surface", "O3", "CO", "AOD_550",
)
WEATHER = (
    "temperature_max", "temperature_mean", "temperature_min",
    "skin_temperature", "dew_point", "wind_u10m", "wind_v10m",
)
DERIVED = ("humidity", "wind_speed", "wind_direction", "PM10")
CALENDAR = ("year", "month", "day", "weekday", "day_of_year", "is_weekend", "season")
LAGGED = ("PM2_5", "PM10", "NO2_trop", "NO2_total", "SO2_column", "O3", "CO", "AOD_550")
LAGS = (1, 7)
ROLLING_WINDOWS = (7, 14)
ROLLING_STATS = ("mean", "std")
DAILY_COLUMNS = (
    "date", "year", "month", "day", "weekday", "day_of_year", "is_weekend", "season",
    "AOD_550", "PM2_5", "PM10", "NO2_trop", "NO2_total", "SO2_column", "SO2_surface",
    "O3", "CO", "temperature_max", "temperature_mean", "temperature_min",
    "skin_temperature", "dew_point", "humidity", "wind_u10m", "wind_v10m",
    "wind_speed", "wind_direction", "precipitation",
)
WEATHER_DRIVERS = ("temperature_mean", "humidity", "wind_speed", "precipitation")
PM_GROUP = ("PM2_5", "PM10", "AOD_550")
GAS_GROUP = ("NO2_trop", "NO2_total", "SO2_column", "SO2_surface", "CO")

# --- fixed values: plausible ranges ---------------------------------------------
RANGES = {
    "PM2_5": (0.0, 1000.0),
    "PM10": (0.0, 2000.0),
    "NO2_trop": (0.0, 1e16),
    "NO2_total": (0.0, 1e16),
    "SO2_column": (0.0, 1.0),
    "SO2_surface": (0.0, 1e-3),
    "O3": (0.0, 500.0),
    "CO": (0.0, 500.0),
    "AOD_550": (0.0, 5.0),
}

# --- fixed values: air-quality index --------------------------------------------
INDEX_LEVELS = (0, 50, 100, 150, 200, 300, 400, 500)
# Components in the order that decides ties, each with the concentration at
# which every index level is reached.
BREAKPOINTS = {
    "PM2_5": (0.0, 12.0, 35.4, 55.4, 150.4, 250.4, 350.4, 500.4),
    "PM10": (0.0, 54.0, 154.0, 254.0, 354.0, 424.0, 504.0, 604.0),
    "NO2_trop": (0.0, 53.0, 100.0, 360.0, 649.0, 1249.0, 1649.0, 2049.0),
    "SO2_column": (0.0, 35.0, 75.0, 185.0, 304.0, 604.0, 804.0, 1004.0),
    "CO": (0.0, 4.4, 9.4, 12.4, 15.4, 30.4, 40.4, 50.4),
    "O3": (0.0, 54.0, 70.0, 85.0, 105.0, 200.0, 300.0, 400.0),
}
COMPONENTS = tuple(BREAKPOINTS)
NO2_TO_PPB = 2.67e-16
SO2_TO_PPB = 100.0
O3_TO_PPB = 0.2
CATEGORY_TOPS = (
    (50, "Good"),
    (100, "Moderate"),
    (150, "Unhealthy for Sensitive"),
    (200, "Unhealthy"),
    (300, "Very Unhealthy"),
)
CATEGORY_ABOVE = "Hazardous"
CATEGORIES = tuple(name for _, name in CATEGORY_TOPS) + (CATEGORY_ABOVE,)
UNKNOWN = "Unknown"
LEVEL_TOPS = ((50, "Low"), (100, "Moderate"), (150, "High"))
LEVEL_ABOVE = "Very High"
STATUS_NORMAL = "Bình thường"
STATUS_POLLUTED = "Ô nhiễm"

# --- fixed values: labels ---------------------------------------------------------
SEASON_NAMES = {0: "Winter", 1: "Spring", 2: "Summer", 3: "Autumn", 4: "Fall"}
SEASON_CODES = {"Winter": 0, "Spring": 1, "Summer": 2, "Fall": 3, "Autumn": 3}
STRENGTH_TOPS = (
    (0.1, "Không đáng kể"),
    (0.3, "Yếu"),
    (0.5, "Trung bình"),
    (0.7, "Mạnh"),
)
STRENGTH_ABOVE = "Rất mạnh"
DIRECTION_UP = "Tăng"
DIRECTION_DOWN = "Giảm"
TREND_IMPROVED = "CẢI THIỆN"
TREND_WORSE = "XẤU ĐI"
TREND_STABLE = "ỔN ĐỊNH"
NO2_DISPLAY_SCALE = 1e-15

# --- fixed values: advice texts ---------------------------------------------------
ADVICE = {
    "Good": ("✅ Không khí trong lành, an toàn", "Không có rủi ro sức khỏe"),
    "Moderate": ("⚠️ Không khí bình thường", "Rủi ro thấp cho người nhạy cảm"),
    "Unhealthy for Sensitive": (
        "⚠️ Không tốt cho người nhạy cảm",
        "Rủi ro trung bình cho người nhạy cảm",
    ),
    "Unhealthy": ("🔴 Không tốt cho mọi người", "Rủi ro cao cho sức khỏe"),
    "Very Unhealthy": ("🔴 Rất không tốt", "Rủi ro rất cao cho sức khỏe"),
    "Hazardous": ("🔴 Nguy hiểm", "Rủi ro cực kỳ cao - Khẩn cấp"),
}
ADVICE_DEFAULT = "Moderate"
ACTIONS_GOOD = (
    "Có thể hoạt động ngoài trời bình thường",
    "Tập thể dục ngoài trời an toàn",
    "Mở cửa sổ để thông gió",
)
ACTIONS_MODERATE = (
    "Người nhạy cảm nên hạn chế hoạt động ngoài trời",
    "Có thể đeo khẩu trang khi ra ngoài",
    "Tránh tập thể dục cường độ cao ngoài trời",
)
ACTIONS_UNHEALTHY = (
    "Nên đeo khẩu trang khi ra ngoài",
    "Hạn chế hoạt động ngoài trời",
    "Đóng cửa sổ khi ở nhà",
    "Sử dụng máy lọc không khí",
)
ACTION_MASK = "Bắt buộc đeo khẩu trang N95 khi ra ngoài"
ACTION_COLD = "🌨️ Mùa đông lạnh - Nên mặc áo khoác, giữ ấm cơ thể"
ACTION_HOT = "☀️ Thời tiết nắng nóng - Nên uống đủ nước, tránh ánh nắng trực tiếp"
ACTION_FLOWER = (
    "🌸 Mùa hoa sữa (",
    " - 15/11) - Người bị dị ứng phấn hoa nên hạn chế ra ngoài, đeo khẩu trang",
)

# --- fixed values: forecasting ----------------------------------------------------
TARGETS = (
    "aqi", "temperature_max", "temperature_min", "temperature_mean", "PM2_5", "PM10",
    "NO2_trop", "CO", "O3", "SO2_column", "humidity", "wind_speed",
)
TARGET_WEIGHTS = {
    "aqi": 3.0, "PM2_5": 2.0, "PM10": 2.0,
    "temperature_max": 1.5, "temperature_min": 1.5, "temperature_mean": 1.5,
    "CO": 1.5, "O3": 1.5, "NO2_trop": 1.0, "SO2_column": 1.0,
    "humidity": 1.0, "wind_speed": 1.0,
}
HORIZONS = (1, 7, 30, 365)
NOT_FEATURES = ("date", "aqi_category", "pollution_level")
TEST_SHARE = 0.2
FIXED_BASE = "2025-11-05"
FIXED_BASE_LAST = "2025-12-31"
