"""Bucket edges, labels, thresholds, split dates and model settings."""

from __future__ import annotations

INF = float("inf")

TARGET = "posted_rate"
PREDICTION = "predicted_rate"
KEY = "load_id"

HIGH_RATE = 7500
EXTREME_RATES = [5000, 7500, 10000, 12500, 15000]

DISTANCE_EDGES_8 = [-INF, 100, 250, 500, 750, 1000, 1500, 2500, INF]
DISTANCE_LABELS_8 = ["0-100", "100-250", "250-500", "500-750", "750-1000", "1000-1500", "1500-2500", "2500+"]

DISTANCE_EDGES_10 = [-INF, 100, 250, 500, 750, 1000, 1500, 2000, 2500, 3000, INF]
DISTANCE_LABELS_10 = [
    "0-100", "100-250", "250-500", "500-750", "750-1000",
    "1000-1500", "1500-2000", "2000-2500", "2500-3000", "3000+",
]

DISTANCE_EDGES_7 = [-INF, 500, 1000, 1500, 2000, 2500, 3000, INF]
DISTANCE_LABELS_7 = ["<500", "500-1000", "1000-1500", "1500-2000", "2000-2500", "2500-3000", "3000+"]

RATE_EDGES = [-INF, 1000, 2000, 3000, 5000, 7500, 10000, 15000, INF]
RATE_LABELS = [
    "<1000", "1000-2000", "2000-3000", "3000-5000", "5000-7500", "7500-10000", "10000-15000", "15000+",
]

PREDICTION_EDGES = [0, 500, 1000, 2000, 3000, 5000, 7500, 10000, INF]
PREDICTION_LABELS = [
    "<$500", "$500-$1k", "$1k-$2k", "$2k-$3k", "$3k-$5k", "$5k-$7.5k", "$7.5k-$10k", "$10k+",
]

AUDIT_PERCENTILES = [0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99]

STRATEGY_THRESHOLDS = [0.30, 0.40, 0.50, 0.60, 0.70, 0.80, 0.90]
STRATEGY_BOOSTS = [0.05, 0.10, 0.15, 0.20, 0.25, 0.30]
TWO_STAGE_FACTOR = 1.5

WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

LONG_HAUL_MILES = [500, 1000, 1500, 2000, 2500]
HEAVY_LB, VERY_HEAVY_LB = 35000, 40000
INDEX_HIGH, INDEX_VERY_HIGH = 1.2, 1.3
SIGNAL_LOW, SIGNAL_HIGH = 1.735, 2.403

LEAKAGE_PATTERNS = ["posted_rate", "rate_per_mile"]

# fixed December lane
LANE = {"pickup": "Lexington", "delivery": "Fort Wayne", "distance": 360.0, "equipment": "Dry Van", "weight": 32000.0}
LANE_START, LANE_END = "2025-12-01", "2025-12-31"
SCENARIO_COLUMNS = ["pickup", "delivery", "distance", "equipment", "weight", "date", "predicted_rate"]

SPLIT_DATE = "2025-09-01"
# name, last training day, first and last validation day
ROLLING_WINDOWS = [
    ("July", "2025-06-30", "2025-07-01", "2025-07-31"),
    ("August", "2025-07-31", "2025-08-01", "2025-08-31"),
    ("September", "2025-08-31", "2025-09-01", "2025-09-30"),
    ("October", "2025-09-30", "2025-10-01", "2025-10-31"),
]

# trees, learning rate, depth, smallest leaf, row share, column share
CHAMPION = (700, 0.05, 6, 5, 0.85, 0.85)
TUNING_CONFIGS = [
    (700, 0.05, 8, 5, 0.85, 0.85),
    (700, 0.05, 6, 5, 0.85, 0.85),
    (700, 0.05, 7, 5, 0.85, 0.85),
    (700, 0.05, 9, 5, 0.85, 0.85),
    (700, 0.05, 10, 5, 0.85, 0.85),
    (1000, 0.03, 7, 5, 0.85, 0.85),
    (1000, 0.03, 8, 5, 0.85, 0.85),
    (500, 0.07, 7, 5, 0.85, 0.85),
    (500, 0.07, 8, 5, 0.85, 0.85),
    (700, 0.05, 8, 3, 0.85, 0.85),
    (700, 0.05, 8, 8, 0.85, 0.85),
    (700, 0.05, 8, 5, 0.75, 0.85),
    (700, 0.05, 8, 5, 0.95, 0.85),
    (700, 0.05, 8, 5, 0.85, 0.70),
    (700, 0.05, 8, 5, 0.85, 1.00),
]

# columns of the correlations among high-rate loads
HIGH_RATE_FEATURES = [
    "distance", "weight", "market_index", "quote_signal",
    "pickup_lat", "pickup_lon", "delivery_lat", "delivery_lon", "rate_per_mile", TARGET,
]
