"""Domain parameters. Every function takes these as keyword arguments; these are the defaults.

Fixed values (must equal the original pipeline's for identical results):
  bad-weather conditions, exact match: RAIN, SNOW, FOG, SLEET
  night lighting conditions, exact match: DARKNESS, DUSK, DAWN
  risk weights (accidents, bad weather, night): 0.5, 0.3, 0.2
  map bounding box, inclusive: latitude 41.6 to 42.1, longitude -87.9 to -87.5
  risk levels on a 0-100 score: >= 70 High, >= 40 Medium, otherwise Low
  top-k sizes: weather 8, crash type 8, road surface 6, lighting all, hotspots 10,
               riskiest locations 10, risk distribution 20, preview 100, live snapshot 5000
  month abbreviations: Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec
  audit batch id of the silver jobs: batch_001
"""

BAD_WEATHER = ("RAIN", "SNOW", "FOG", "SLEET")
NIGHT_LIGHTING = ("DARKNESS", "DUSK", "DAWN")
RISK_WEIGHTS = (0.5, 0.3, 0.2)
MAP_BOX = (41.6, 42.1, -87.9, -87.5)  # lat_lo, lat_hi, lon_lo, lon_hi
LEVEL_HIGH = 70.0
LEVEL_MEDIUM = 40.0
LEVEL_NAMES = ("High", "Medium", "Low")
MONTH_ABBR = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

TOP_WEATHER = 8
TOP_CRASH_TYPE = 8
TOP_SURFACE = 6
TOP_HOTSPOTS = 10
TOP_RISK = 10
TOP_RISK_LABELS = 20
PREVIEW_ROWS = 100
LIVE_SNAPSHOT_ROWS = 5000

SILVER_BATCH_ID = "batch_001"
SOURCE_SILVER_CRASH = "crash_api_silver"
SOURCE_SILVER_VIDEO = "video_api_silver"
SOURCE_GOLD_MONTHLY = "gold_monthly_pipeline"
SOURCE_BRONZE_CRASH = "crash_api"
SOURCE_BRONZE_VIDEO = "video_api"
